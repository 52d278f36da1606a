"""A corpus pipeline of five stages; each works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm import containment, jaccard, language, mixing, token_files
from cohortry.llm.queries import tokenizer_path
from cohortry.storage import materialize, new_path, table

#: No SQL expresses the stages that compress, permute or tokenize; tests compare the operators with brute force, and run the whole.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is rejected; the others keep all their columns.

    Null and empty texts, and texts without a letter, are rejected. Ids play no part; repeated rows are judged alike; no rows give none.
    """
    model = language.fit(docs)
    own = {c: f"_own{k}" for k, c in enumerate(docs.columns)}
    judged = language.predict(docs.select(F.col("text"), *[F.col(f"`{c}`").alias(n) for c, n in own.items()]), model)
    return judged.filter("accepted").select(*[F.col(n).alias(c) for c, n in own.items()])


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[Column]]:
    """The documents as doc_id, text and ``row``, the keys of repeated rows, and what gives the input's own columns back.

    ``row`` is a hash of all columns that no two different rows share. The input's columns go by other names meanwhile, so theirs may be any.
    """
    own = {c: f"_own{k}" for k, c in enumerate(docs.columns)}
    back = [F.col(n).alias(c) for c, n in own.items()]
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    # hashes pass over nulls, so which columns are null is hashed as well
    columns = [F.col(n) for n in own.values()]
    parts = [*[c.isNull() for c in columns], *columns]
    for seed in range(8):
        keyed = named.select("*", F.col(own["doc_id"]).alias("doc_id"), F.col(own["text"]).alias("text"), F.xxhash64(F.lit(seed), *parts).alias("row"))
        other = keyed.select("row", F.xxhash64(F.lit(-1 - seed), *parts).alias("h"))
        repeated = materialize(other.groupBy("row").agg(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).filter("n > 1"), "repeated")
        if repeated.filter("lo <> hi").isEmpty():
            return keyed, repeated.select("row"), back
    raise RuntimeError("rows share hashes under every seed")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every component, that of the smallest id (null ids last); rows are told apart by all their columns.

    Rows that are equal in all columns are one group if they have words, and one stays. Texts without words form no group and all stay. No rows give none.
    """
    keyed, repeated, back = _keyed(docs)
    found = materialize(jaccard.jaccard_components(keyed, key="row").select(F.col("doc_id").alias("row"), "n_shingles", "component_id").distinct(), "components")
    several = found.filter("component_id <> row").select("component_id").distinct()
    grouped = found.join(several, "component_id", "left_semi").join(keyed.select("row", F.col("doc_id").alias("id")).distinct(), "row")
    kept = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))["row"].alias("kept"))
    dropped = materialize(grouped.join(kept, "component_id").filter("row <> kept").select("row"), "dropped")
    if repeated.isEmpty():
        return keyed.join(dropped, "row", "left_anti").select(back)
    # rows equal in all columns are one group as well, if they have words
    again = repeated.join(found.filter("n_shingles > 0"), "row", "left_semi").join(dropped, "row", "left_anti")
    once = keyed.join(again, "row", "left_semi").dropDuplicates(["row"])
    return keyed.join(dropped.union(again), "row", "left_anti").select(back).union(once.select(back))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that hold a benchmark item, whatever their ids, null ones and those of other texts included.

    Null and empty texts hold none and stay. Without items, or without rows, nothing changes.
    """
    keyed, _, back = _keyed(docs)
    found = materialize(containment.contaminated(keyed, table(spark, sf_dir, "benchmark"), key="row").select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return keyed.join(found, "row", "left_anti").select(back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources as documents, a row per pass that takes words of one.

    Texts without words are never taken. Null sources are one source; null ids and repeated rows are kept, each on its own. No rows give none.
    """
    return mixing.Mixture(docs).documents()


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the mixture, write it in bit planes, and read back where every document stands.

    Null ids stand first; rows of one id stand one after another. No rows give none.
    """
    path = new_path(spark, "tokens")
    token_files.write_tokens(docs, path, tokenizer_path())
    return token_files.read_tokens(spark.read.parquet(path))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
