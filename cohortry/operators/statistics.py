"""Exact tests, intervals and false-discovery control."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.joins import spread_join
from cohortry.storage import materialize

Z95 = 1.959963984540054
#: Tables whose log probability exceeds the observed one by less than this count as equally likely.
LOG_TOLERANCE = 1e-9
#: Terms of a tail below this part of its first one are left out.
NEGLIGIBLE = 1e-22
#: Logarithms of the factorials below this number are a table, in extended precision; a series gives the others to the same precision.
TABLE = 256
_LOG_FACTORIALS = np.concatenate([[np.longdouble(0)], np.cumsum(np.log(np.arange(1, TABLE, dtype=np.longdouble)))])


def log_factorial(n: np.ndarray) -> np.ndarray:
    """Logarithms of factorials of whole numbers from 0 up, in extended precision."""
    x = np.maximum(n, 1).astype(np.longdouble)
    square = 1 / (x * x)
    tail = (np.longdouble(1) / 12 - square * (np.longdouble(1) / 360 - square * (np.longdouble(1) / 1260 - square / 1680))) / x
    series = (x + np.longdouble(0.5)) * np.log(x) - x + np.log(2 * np.arctan2(np.longdouble(0), np.longdouble(-1))) / 2 + tail
    return np.where(n < TABLE, _LOG_FACTORIALS[np.clip(n, 0, TABLE - 1)], series)


def _tail(x: np.ndarray, end: np.ndarray, step: int, row: np.ndarray, column: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Sums of the weights from corner count ``x`` on to ``end`` (in steps of 1 or -1), as a part of the first; they fall all the way."""
    total, term, live = np.ones(len(x)), np.ones(len(x)), np.flatnonzero(x != end)
    at = x.copy()
    while len(live):
        k = at[live].astype(float)
        if step > 0:
            term[live] *= (row[live] - k) * (column[live] - k) / ((k + 1) * (rest[live] + k + 1))
        else:
            term[live] *= k * (rest[live] + k) / ((row[live] - k + 1) * (column[live] - k + 1))
        at[live] += step
        total[live] += term[live]
        live = live[(at[live] != end[live]) & (term[live] > NEGLIGIBLE * total[live])]
    return total


def fisher_p(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Two-sided p-values of the tables [[a, b], [c, d]]: the probability of all tables with the same margins that are at most as likely.

    Weights fall on both sides of the most likely corner count, so both tails and the whole are sums of ratios that end where terms no longer count.
    """
    row, column, rest = a + b, a + c, d - a
    low, high = np.maximum(0, -rest), np.minimum(row, column)

    def weight(x: np.ndarray) -> np.ndarray:
        return -(log_factorial(x) + log_factorial(row - x) + log_factorial(column - x) + log_factorial(rest + x))

    mode = np.clip((row + 1) * (column + 1) // (row + column + rest + 2), low, high)
    own = weight(a)
    limit = own + LOG_TOLERANCE
    # the innermost counts on both sides that are at most as likely as the observed one; a side without any gets one outside
    left_a, left_b = low - 1, mode - 1
    while (left_a < left_b).any():
        middle = -((-left_a - left_b) // 2)
        good = weight(np.maximum(middle, low)) <= limit
        left_a, left_b = np.where((left_a < left_b) & good, middle, left_a), np.where((left_a < left_b) & ~good, middle - 1, left_b)
    right_a, right_b = mode, high + 1
    while (right_a < right_b).any():
        middle = (right_a + right_b) // 2
        good = weight(np.minimum(middle, high)) <= limit
        right_a, right_b = np.where((right_a < right_b) & ~good, middle + 1, right_a), np.where((right_a < right_b) & good, middle, right_b)
    sides = np.zeros(len(a))
    for at, end, step, there in ((left_a, low, -1, left_a >= low), (right_a, high, 1, right_a <= high)):
        k = np.flatnonzero(there)
        sides[k] += np.exp((weight(at.clip(low, high)) - own)[k]).astype(float) * _tail(at[k], end[k], step, row[k], column[k], rest[k])
    whole = _tail(mode, low, -1, row, column, rest) + _tail(mode, high, 1, row, column, rest) - 1
    return np.minimum(1.0, np.exp(own - weight(mode)).astype(float) * sides / whole)


def fisher_exact(df: DataFrame, a: str = "a", b: str = "b", c: str = "c", d: str = "d") -> DataFrame:
    """Add p_value (two-sided) and odds_ratio of the 2x2 tables [[a, b], [c, d]].

    Tables are evaluated in Arrow batches, different ones once, with nothing shuffled and no row per possible table. An empty table has p 1; the
    odds ratio is infinite if only bc is 0 and null if ad is 0 too. Null counts give nulls.
    """
    schema = T.StructType([*df.schema, T.StructField("p_value", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [pc.cast(batch.column(k), pa.int64()) for k in (a, b, c, d)]
            known = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in cells])
            tables = np.stack([x.fill_null(0).to_numpy() for x in cells], axis=1)[known]
            p = np.full(batch.num_rows, np.nan)
            if len(tables):
                different, at = np.unique(tables, axis=0, return_inverse=True)
                p[known] = fisher_p(*different.T)[at.ravel()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, mask=~known)], names=schema.fieldNames())

    ad, bc = F.col(a).cast("long") * F.col(d).cast("long"), F.col(b).cast("long") * F.col(c).cast("long")
    odds = F.when(bc > 0, ad / bc).when(ad > 0, F.lit(float("inf")))
    return df.mapInArrow(run, schema).withColumn("odds_ratio", odds)


def wilson(successes: Column, trials: Column, z: float = Z95) -> tuple[Column, Column]:
    """Lower and upper bound of a proportion; null without trials."""
    n = F.when(trials > 0, trials.cast("double"))
    p, scale = successes / n, 1 + z * z / n
    centre, half = (p + z * z / (2 * n)) / scale, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / scale
    return F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)


def benjamini_hochberg(df: DataFrame, by: Sequence[str], p: str = "p_value", out: str = "q_value") -> DataFrame:
    """Add the adjusted p-values of each family, the rows that agree in ``by``; see ``adjusted``."""
    return adjusted(df, {out: by}, p)


def adjusted(df: DataFrame, scopes: dict[str, Sequence[str]], p: str = "p_value") -> DataFrame:
    """Add a column of adjusted p-values (Benjamini-Hochberg) for each scope, a name with the columns that make up its families; rows of null p take no part and get null.

    A family's different p-values with their counts are dealt by range and sorted; ranks are counted and the least later value is
    kept within a range, and a row per range and family carries counts forward and minima back. So no task holds more of a family than a range,
    whatever its size. Ties share one value, so this is exact. All scopes go through one pass.
    """
    by, name = ["_scope", "_family"], lambda columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    stacked = None
    for scope, columns in scopes.items():
        rows = df.filter(F.col(p).isNotNull()).groupBy(name(columns).alias("_family"), p).agg(F.count("*").alias("_k")).withColumn("_scope", F.lit(scope))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    ranges = materialize(stacked.repartitionByRange(*by, p).withColumn("_part", F.spark_partition_id()), "p_values")
    here = Window.partitionBy(*by, "_part").orderBy(p)
    sums = ranges.groupBy(*by, "_part").agg(F.sum("_k").alias("_s"))
    family = Window.partitionBy(*by)
    bases = sums.withColumns({"_base": F.coalesce(F.sum("_s").over(family.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_m": F.sum("_s").over(family)}).drop("_s")
    # a sort of the range serves both windows
    value = F.col(p) * F.col("_m") / (F.col("_base") + F.sum("_k").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranges.join(bases, [*by, "_part"]).withColumn("_v", value)
    ranked = ranked.withColumn("_least", F.min("_v").over(here.rowsBetween(0, Window.unboundedFollowing)))
    minima = ranked.groupBy(*by, "_part").agg(F.min("_v").alias("_v"))
    later = minima.withColumn("_later", F.min("_v").over(family.orderBy("_part").rowsBetween(1, Window.unboundedFollowing))).drop("_v")
    q = ranked.join(later, [*by, "_part"]).select(*by, p, F.least(F.lit(1.0), "_least", "_later").alias("_q"))
    for scope, columns in scopes.items():
        own = q.filter(F.col("_scope") == scope).select("_family", p, F.col("_q").alias(scope))
        df = spread_join(df.withColumn("_family", name(columns)), own, ["_family", p], "_k", "left", sizes=ranges.filter(F.col("_scope") == scope).select("_family", p, "_k")).drop("_family")
    return df
