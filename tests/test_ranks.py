"""Ranks, first rows, medians, digests and pairs of groups that span many ranges."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortry import ranks
from cohortry.operators import sequences


@pytest.fixture(params=["1", "6"])
def parts(spark, request):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_running_counts(spark, parts):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), k * 7919 % 1000, rng.randint(0, 4)) for k in range(1000)]
    frame = spark.createDataFrame(rows, "g string, v int, w int")
    got = {(r["g"], r["v"]): (r["upto"], r["whole"]) for r in ranks.running_count(frame, ["g"], ["v"], weight="w").collect()}
    for g in ("a", "b", None):
        total = 0
        mine = sorted((v, w) for x, v, w in rows if x == g)
        for v, w in mine:
            total += w
            assert got[g, v] == (total, sum(x for _, x in mine))
    plain = {r["v"]: r["upto"] for r in ranks.running_count(frame, [], ["v"]).collect()}
    assert plain == {v: v + 1 for v in range(1000)}


@pytest.mark.parametrize("limit", [0, 1, 7, 40, 41, 500])
def test_first_rows(spark, parts, limit):
    rng = random.Random(2)
    rows = [(rng.choice("xy"), f"t{k:03d}", rng.randint(1, 6), limit) for k in range(120)]
    frame = spark.createDataFrame(rows, "g string, t string, n int, most int")
    got = sorted((r["g"], r["t"]) for r in ranks.first_rows(frame, ["g"], "n", "t", "most").collect())
    assert got == sorted((r[0], r[1]) for g in "xy" for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:limit])
    assert sorted(r["t"] for r in ranks.first_rows(frame, [], "n", "t", "most").collect()) == sorted(r[1] for r in sorted(rows, key=lambda r: (-r[2], r[1]))[:limit])


def test_medians(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(9)]), rng.random()) for _ in range(401)] + [(4, None, 0.5), (5, 1, 2.0), (5, 2, 4.0)]
    got = {r["g"]: (r["x"], r["y"]) for r in ranks.medians(spark.createDataFrame(rows, "g int, x int, y double"), ["g"], ["x", "y"]).collect()}
    for g in (1, 2, None, 4, 5):
        for k in (1, 2):
            values = [r[k] for r in rows if r[0] == g and r[k] is not None]
            assert got[g][k - 1] == (pytest.approx(statistics.median(values)) if values else None)


def test_digest_trees(spark, parts):
    rows = [("one", 1, "x"), ("empty", 1, None), (None, 2, "y"), (None, 1, "y")] + [("many", k * 37 % 100, f"v{k}") for k in range(100)] + [("four", k, "z") for k in range(4)] + [("five", k, "z") for k in range(5)]
    got = {r["g"]: r["digest"] for r in sequences.digest_tree(spark.createDataFrame(rows, "g string, k long, t string").repartition(5), "g", "k", "t", fan=4).collect()}
    for g in {r[0] for r in rows}:
        level = [f"{k}\t{t}\n" for x, k, t in sorted((r for r in rows if r[0] == g and r[2] is not None), key=lambda r: r[1])]
        while len(level) > 1 or level and "\n" in level[0]:
            level = [hashlib.sha256("".join(level[i : i + 4]).encode()).hexdigest() for i in range(0, len(level), 4)]
        assert got[g] == (level[0] if level else None)


def test_pairs_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sequences, "PAIR_ROWS", 7)
    rng = random.Random(4)
    rows = [(k, rng.choice(["f", "g", "h"]), "".join(rng.choice("ACD-X") for _ in range(rng.randint(0, 12)))) for k in range(90)] + [(200, "alone", "AC-")]
    frame = spark.createDataFrame(rows, "sequence_id long, family string, sequence string")
    for known in (None, "ACD"):
        want = {}
        for a, f, s in rows:
            for b, g, t in rows:
                if f == g and a <= b:
                    both = [(x, y) for x, y in zip(s, t, strict=False) if (x in known and y in known if known else "-" not in (x, y))]
                    if both:
                        want[a, b] = (len(both), sum(x == y for x, y in both))
        found = sequences.pairwise_identity(frame, ["family"], known).collect()
        assert {(r["a"], r["b"]): (r["comparable"], r["identical"]) for r in found} == want and len(found) == len(want)
    family = dict((r[0], r[1]) for r in rows)
    one = sequences.pairwise_identity(frame.filter(F.col("family") == "f"), known="ACD").collect()
    assert {(r["a"], r["b"]) for r in one} == {k for k in want if family[k[0]] == "f"}


def test_vocabulary_of_a_budget(spark, parts):
    rng = random.Random(5)
    rows = [(length, f"K{length}{k:02d}", rng.randint(1, 5)) for length, n in ((3, 30), (4, 6), (5, 40)) for k in range(n)]
    frame = spark.createDataFrame(rows, "length int, kmer string, proteins long")
    for budget in (1, 20, 50, 1000):
        usable = [r for r in rows if r[2] >= 2]
        share, extra = divmod(budget, 3)
        first = [r for place, k in enumerate((5, 4, 3)) for r in sorted((r for r in usable if r[0] == k), key=lambda r: (-r[2], r[1]))[: share + (place < extra)]]
        rest = sorted((r for r in usable if r not in first), key=lambda r: (-r[2], f"k{r[0]}:{r[1]}"))
        got = sequences.ranked_vocabulary(frame, budget, [3, 4, 5], minimum=2)
        assert got.columns == ["length", "kmer", "proteins"] and sorted(map(tuple, got.collect())) == sorted(first + rest[: budget - len(first)])
