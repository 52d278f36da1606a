"""Helpers on DataFrames that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The word pattern of the contracts, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of texts that are handed to Python at a time.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands at most ``BATCH_BYTES`` (a row at least) to Python at a time.

    Rows hold whole texts, so a batch that is bounded by its number of rows only may be of any size. A smaller setting stays.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(conf.get(key, "64m")).strip().lower()
    units = {"k": 10, "m": 20, "g": 30}
    digits, unit = now.rstrip("kmgb"), now[len(now.rstrip("kmgb")) :][:1]
    if int(digits) << units.get(unit, 0) > BATCH_BYTES:
        conf.set(key, f"{BATCH_BYTES}b")
    return df


def word_count(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def running_total(df: DataFrame, within: Sequence[str], value: str, order: Sequence[str], out: str, buckets: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``within`` that stand before the row.

    Rows are dealt into ``buckets`` (the session's shuffle partitions, 128 at least) by a hash of ``order``; totals of the buckets give each bucket its
    base, and a window inside one bucket adds the rest. No task holds more than a bucket of a group,
    however large the group. ``within`` must not be null. Rows that are equal in ``order`` stand in any order.
    """
    if buckets is None:
        buckets = max(128, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    dealt = df.withColumn("_bucket", bucket)
    sums = dealt.groupBy(*within, "_bucket").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*within, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*within, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(base, [*within, "_bucket"])
    return joined.withColumn(out, (F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long")).drop("_bucket", "_base")
