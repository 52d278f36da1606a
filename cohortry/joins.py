"""Joins that keep a heavy key from one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold over one in ``SHARE`` of all rows, and more than ``FLOOR``, are dealt to ``SALTS`` tasks.
SHARE, FLOOR, SALTS = 1000, 10_000, 256


def spread_join(rows: DataFrame, keys: DataFrame, on: str | Sequence[str], count: str, how: str = "inner", sizes: DataFrame | None = None) -> DataFrame:
    """``rows.join(keys, on, how)`` for ``keys`` with one row a key and the number of its rows, ``count``: rows of a heavy key go to many tasks.

    Heavy are at most ``SHARE`` keys, whatever the input, so their list may be broadcast; only they are repeated for the salts. The numbers are read from ``sizes``
    (``keys`` itself unless given) once or twice, so that should be a written table. ``count`` does not get into the result.
    """
    on = [on] if isinstance(on, str) else list(on)
    sizes, keys = keys if sizes is None else sizes, keys.drop(count)
    total, most = sizes.agg(F.sum(count), F.max(count)).first()
    least = max(FLOOR, (total or 0) / SHARE)
    if (most or 0) <= least:
        return rows.join(keys, on, how)
    flag = F.broadcast(sizes.filter(F.col(count) > least).select(*on, F.lit(True).alias("_heavy")))
    salted = rows.join(flag, on, "left").withColumn("_salt", F.when(F.col("_heavy"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_heavy")
    salts = F.explode(F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    return salted.join(keys.join(flag, on, "left").withColumn("_salt", salts).drop("_heavy"), [*on, "_salt"], how).drop("_salt")
