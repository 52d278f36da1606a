"""Language ID by compression (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.llm.tables import small_batches

#: Bounds of the training sample: documents a language, and bytes of its dictionary.
SAMPLE_DOCS = 200
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 2048
#: A document is rejected when its best and second language differ by less than this share of the size.
MARGIN = 0.01
UNKNOWN = "und"


@dataclass(frozen=True)
class Dictionaries:
    """Raw-content dictionaries by language; at most ``DICTIONARY_BYTES`` each."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY_BYTES) -> Dictionaries:
    """Build a dictionary a language from a bounded sample of the rows with text and language.

    The sample is the first ``sample_docs`` rows of each language by a hash of the text, and nothing but text and language
    steers it; copies among them count once. Each gives ``size / 64`` characters at most, in that order, until the dictionary is full, so
    that of long texts 64 are used and of short ones up to ``sample_docs``. Rows without a letter or with blank language take no part.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    piece = max(256, size // 64)
    # the share of a text is cut before rows are ranked; ranks are limited before they are shuffled
    rows = labelled.select("lang", "h", F.lower(F.substring("text", 1, piece)).alias("part"))
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("rank") <= sample_docs)
    found: dict[str, list[tuple[int, str]]] = {}
    for r in best.select("lang", "rank", "part").collect():
        found.setdefault(r["lang"], []).append((r["rank"], r["part"]))
    names = tuple(sorted(found))
    return Dictionaries(names, tuple(" ".join(dict.fromkeys(p for _, p in sorted(found[n]))).encode()[:size] for n in names))


def _settings() -> zstandard.ZstdCompressionParameters:
    """Greedy matches of four bytes and more with a search of eight places: short words of the dictionary count."""
    return zstandard.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=15, search_log=3, min_match=4, target_length=8, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)


class _Classifier:
    def __init__(self, model: Dictionaries):
        self.languages = model.languages
        self.packers = []
        for content in model.contents:
            words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=_settings())
            self.packers.append(zstandard.ZstdCompressor(compression_params=_settings(), dict_data=words))

    def sizes(self, text: bytes) -> np.ndarray:
        """Compressed bytes by language; every block of the text is packed on its own."""
        blocks = [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
        return np.array([sum(len(p.compress(b)) for b in blocks) for p in self.packers], float)


def predict(docs: DataFrame, model: Dictionaries, margin: float = MARGIN) -> DataFrame:
    """The rows of ``docs`` (columns doc_id and text, and any others) with lang_pred, score and accepted.

    Every whole text, lower-cased, is packed in blocks with each language's dictionary, and the smallest total wins; ties go to the
    first language by name. score is the margin to the second language as a share of the second's
    size, times ten, at most 1; with a single language it is 1. ``accepted`` is false when the margin is
    narrow, or when the text is null or has no letter: then lang_pred is ``und`` and score 0. Without any
    learned language everything is ``und``. Repeated rows are judged alike; other columns are untouched.
    """
    docs = docs.drop("lang_pred", "score", "accepted", "_letter")  # columns of these names are replaced
    extra = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType()), ("_letter", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in extra)])
    ready = docs.withColumn("_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge_text = _Classifier(model)
        for batch in batches:
            names, scores, sure = [], [], []
            for letter, text in zip(batch.column("_letter"), batch.column("text"), strict=True):
                if not letter.as_py() or not judge_text.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    sure.append(False)
                    continue
                sizes = judge_text.sizes(text.as_py().lower().encode())
                order = np.argsort(sizes, kind="stable")
                share = 1.0 if len(order) == 1 else (sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]
                names.append(judge_text.languages[order[0]])
                scores.append(float(min(1.0, 10 * share)))
                sure.append(bool(share >= margin))
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_()), batch.columns[-1]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "lang_pred", "score", "accepted", "_letter"])

    return small_batches(ready).mapInArrow(judge, schema).drop("_letter")
