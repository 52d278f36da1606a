"""Fisher's test against exact sums, and adjusted p-values against the rule, over many ranges."""

import random
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry import joins
from cohortry.operators import statistics


def exact(a, b, c, d):
    row, column, total = a + b, a + c, a + b + c + d
    weights = {x: comb(row, x) * comb(total - row, column - x) for x in range(max(0, row + column - total), min(row, column) + 1)}
    return float(Fraction(sum(w for w in weights.values() if w <= weights[a]), sum(weights.values())))


def test_fisher_against_exact_sums():
    rng = random.Random(4)
    tables = [(a, b, c, d) for a in range(6) for b in range(6) for c in range(6) for d in range(6)]
    tables += [tuple(rng.randint(0, size) for _ in range(4)) for size in (20, 60, 300) for _ in range(300)]
    tables += [(0, 0, 0, 0), (500, 0, 0, 500), (400, 3, 2, 900), (40, 900, 800, 2), (300, 300, 300, 300), (0, 7, 1, 700)]
    got = statistics.fisher_p(*np.array(tables, np.int64).T)
    want = np.array([exact(*t) for t in tables])
    assert np.abs(got - want).max() <= 9.66e-15
    assert (np.abs(got - want) <= 1e-11 * want).all()


def test_fisher_of_large_tables():
    """Large counts keep a relative precision, and the symmetric table has p 1."""
    tables = np.array([(1_000_000, 1_000_000, 1_000_000, 1_000_000), (100_100, 99_900, 99_900, 100_100), (450, 20, 30, 500)], np.int64)
    p = statistics.fisher_p(*tables.T)
    assert abs(p[0] - 1) < 1e-9 and abs(p[2] / exact(450, 20, 30, 500) - 1) < 1e-10
    assert 0.5 < p[1] / 0.5286 < 1.5


def test_fisher_keeps_rows_and_nulls(spark):
    rows = [(1, 2, 3, 4, "x"), (1, 2, 3, 4, "y"), (None, 2, 3, 4, "z"), (0, 0, 0, 0, None), (3, 0, 0, 3, "w"), (0, 3, 3, 0, "v")]
    got = {r["t"]: (r["p_value"], r["odds_ratio"]) for r in statistics.fisher_exact(spark.createDataFrame(rows, "a int, b int, c int, d int, t string")).collect()}
    assert len(got) == 6 and got["x"] == got["y"] and abs(got["x"][0] - exact(1, 2, 3, 4)) < 1e-15
    assert got["z"] == (None, None) and got[None] == (1.0, None) and got["w"] == (pytest.approx(0.1), float("inf")) and got["v"] == (pytest.approx(0.1), 0.0)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_adjusted_values_over_many_ranges(spark, parts):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(6)
        rows = [("big", round(rng.random() ** 3, 3)) for _ in range(3000)] + [("big", 1.0)] * 400 + [("small", 0.2), ("small", None), ("one", 0.5), (None, 0.1), (None, 0.1)]
        found = statistics.benjamini_hochberg(spark.createDataFrame(rows, "f string, p_value double"), ["f"]).collect()
        assert len(found) == len(rows)
        for name in ("big", "small", "one"):
            p = sorted(x for f, x in rows if f == name and x is not None)
            q, least = {}, 1.0
            for k in range(len(p), 0, -1):
                least = min(least, p[k - 1] * len(p) / k)
                q.setdefault(p[k - 1], least)
                q[p[k - 1]] = min(q[p[k - 1]], least)
            for r in found:
                if r["f"] == name:
                    assert (r["q_value"] is None) if r["p_value"] is None else abs(r["q_value"] - q[r["p_value"]]) < 1e-12
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_no_window_holds_a_whole_family(spark):
    rows = spark.range(20_000).select(F.lit("f").alias("f"), (F.rand(1)).alias("p_value"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = rows.groupBy("f", "p_value").count().repartitionByRange("f", "p_value").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in counts) < 2 * 20_000 / 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_heavy_keys_of_several_columns(spark, monkeypatch):
    monkeypatch.setattr(joins, "FLOOR", 1000)
    rows = spark.range(9000).selectExpr("if(id < 4000, 'a', 'b') as f", "if(id < 4000, 1, id) as p", "id")
    keys = rows.groupBy("f", "p").agg(F.count("*").alias("n"), F.max("id").alias("v"))
    got = joins.spread_join(rows, keys, ["f", "p"], "n", "left")
    want = rows.join(keys.drop("n"), ["f", "p"], "left")
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and got.count() == 9000
