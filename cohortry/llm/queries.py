"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import bpe_words, containment, conversations, cross_align, graph_search, jaccard, language, licenses, mixing, shards, suffix_dedup, token_counts, token_files
from cohortry.storage import new_path, table


@lru_cache(maxsize=4)
def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_tokens(spark.read.parquet(path))


def op4_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.minimax_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_bytes")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return graph_search.search(graph_search.build_index(vectors), vectors.filter(F.col("vec_id") % 20 == 0))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    found = language.predict(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(table(spark, sf_dir, "documents")).taken()


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.licensed(table(spark, sf_dir, "documents"), licenses.TEMPLATES)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align.count_links(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    found = bpe_words.decode(bpe_words.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256")
    )


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_token_counts, op3_bit_planes, op4_minimax_shards, op5_decontamination, op6_graph_search, op7_jaccard_join, op8_language_id, op9_source_mix, op10_license_scan, op11_conversation_repair, op12_cross_align, op13_bpe_words)}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_GRAMS = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))"
_TEMPLATES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES)

ORACLES = {
    "op5_decontamination": f"""
        WITH item AS (SELECT item_id, unnest(list_distinct({_GRAMS})) AS g FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
        sized AS (SELECT item_id, count(*) AS item_shingles FROM item GROUP BY item_id),
        doc AS (SELECT doc_id, unnest(list_distinct({_GRAMS})) AS g FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
        both_of AS (SELECT doc_id, item_id, count(*) AS shared FROM doc JOIN item USING (g) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
        FROM both_of JOIN sized USING (item_id) WHERE shared >= 0.8 * item_shingles""",
}
