"""Ranks, first rows and medians of groups of any size: ranges carry counts, no task holds a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.storage import materialize


def running_count(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str | None = None, upto: str = "upto", whole: str = "whole") -> DataFrame:
    """Add ``upto``, the rows (or the sum of ``weight``) of a group up to and with the row in ascending ``order`` (nulls first), and ``whole``, those of the group.

    Rows are dealt by range and sorted; a row per range and group carries the counts of the ranges before it. Rows that agree in ``order`` stand in any order and in one range. Null groups are groups.
    """
    by, order = list(by), list(order)
    ranged = materialize(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    amount = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    sums = ranged.groupBy(*by, "_part").agg(F.sum(amount).alias("_s"))
    group = Window.partitionBy(*by)
    bases = sums.withColumns({"_base": F.coalesce(F.sum("_s").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), whole: F.sum("_s").over(group)}).drop("_s")
    here = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = ranged.withColumn("_own", F.sum(amount).over(here)).alias("x")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in by]
    joined = counted.join(bases.alias("y"), [F.col("x._part") == F.col("y._part"), *same])
    return joined.select(*[f"x.{c}" for c in df.columns], (F.col("_base") + F.col("_own")).alias(upto), F.col(whole))


def first_rows(df: DataFrame, by: Sequence[str], count: str, tie: str, limit: str) -> DataFrame:
    """The first rows of every group by falling ``count`` (a whole number), then rising ``tie``, as many as the column ``limit`` says (the same in a group); without a group for no ``by``.

    A histogram of the counts tells which count the limit falls on: rows above it all stay, and only rows of that count are ranked.
    """
    by = list(by)
    bars = df.groupBy(*by, count).agg(F.count("*").alias("_n"), F.max(limit).alias("_limit"))
    above = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(F.desc(count)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = bars.withColumn("_above", above).filter("_above < _limit AND _above + _n >= _limit").select(*by, F.col(count).alias("_at"), (F.col("_limit") - F.col("_above")).alias("_open"))
    cut = materialize(cut, "cuts")
    marked = df.join(cut, by, "left") if by else df.join(cut, how="left", on=F.lit(True))
    marked = marked.filter(F.col(limit) > 0)
    whole = marked.filter(F.col("_at").isNull() | (F.col(count) > F.col("_at"))).select(*df.columns)
    edge = running_count(marked.filter(F.col(count) == F.col("_at")), by, [tie], upto="_rank")
    return whole.unionByName(edge.filter(F.col("_rank") <= F.col("_open")).select(*df.columns))


def medians(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(by, values): exact medians, the mean of the two middle values where the number is even; nulls take no part, and a group without values has nulls.

    Different values are counted, and the counts are added up over ranges of values until they pass the middle.
    """
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(v).alias("_name"), F.col(v).cast("double").alias("_value")) for v in values])).alias("v")).select(*by, "v.*")
    counts = long.filter("_value IS NOT NULL").groupBy(*by, "_name", "_value").agg(F.count("*").alias("_n"))
    run = running_count(counts, [*by, "_name"], ["_value"], weight="_n", upto="_upto", whole="_whole")
    low, high = F.floor((F.col("_whole") + 1) / 2), F.ceil((F.col("_whole") + 1) / 2)
    middle = (F.min(F.when(F.col("_upto") >= low, F.col("_value"))) + F.min(F.when(F.col("_upto") >= high, F.col("_value")))) / 2
    found = run.groupBy(*by, "_name").agg(middle.alias("_median"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == v, F.col("_median"))).alias(v) for v in values])
