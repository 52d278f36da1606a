"""Components of graphs with hubs: right, and no part of a round holds a hub."""

import random
import statistics

from pyspark.sql import functions as F

from cohortry.operators import components as C


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in edges:
        if x is not None and y is not None and x != y:
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def test_graphs_with_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARE", 50)
    monkeypatch.setattr(C, "FLOOR", 5)
    for seed in range(3):
        rng = random.Random(seed)
        edges = [(500, rng.randint(0, 999)) for _ in range(300)] + [(k, k + 1) for k in range(2000, 2040)] + [(rng.randint(0, 1500), rng.randint(0, 1500)) for _ in range(400)]
        edges += [(None, 4), (7, 7), (3000, 3001), (3001, 3000), (3000, 3001)]
        rng.shuffle(edges)
        got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == brute(edges)


def test_a_star_of_a_million_leaves(spark):
    middle = 500_000
    edges = spark.range(1_000_001).filter(F.col("id") != middle).select(F.lit(middle).cast("long").alias("a"), F.col("id").alias("b"))
    found = C.components(edges)
    assert found.agg(F.count("*"), F.max("component"), F.count_distinct("node")).first() == (1_000_001, 0, 1_000_001)
    hubs, (ends, _) = C._hubs(edges)
    assert ends == 2_000_000 and [r["a"] for r in hubs.collect()] == [middle]
    # the edges as they are dealt for the join of a round
    sizes = [r["count"] for r in C.salted(C._both(edges), hubs).repartition(16, "a", "salt").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * statistics.median(sizes)
