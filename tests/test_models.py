"""Batched elastic nets against fits one by one, permutations, and held-out figures against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortry.operators import models

ROWS = "comparison_id string, protein_id long, partition string, unit long, target int, fold int, folds int, features array<int>, n_features int"


def made(comparisons, size, width, folds, seed=3):
    rng, rows, protein = random.Random(seed), [], 0
    for c in range(comparisons):
        weights = [rng.gauss(0, 1.5) for _ in range(width)]
        for unit in range(size // 3):
            target = unit % 2
            for _ in range(rng.randint(1, 5)):
                x = [j for j in range(width) if rng.random() < 1 / (1 + np.exp(-(weights[j] if target else -weights[j]) / 2))]
                rows.append((f"c{c}", protein, "DISCOVERY", unit, target, unit // 2 % folds, folds, x, width))
                protein += 1
    return rows


def test_batched_fits_equal_fits_one_by_one(spark):
    rows = made(2, 90, 6, 2)
    settings = models.Settings(strengths=(0.05, 1.0, 20.0), l1_ratio=0.4, tolerance=1e-9)
    got = {(r["comparison_id"], r["strength"], r["fold"]): r for r in models.fit_all(spark.createDataFrame(rows, ROWS), 2, settings).collect()}
    assert len(got) == 2 * 3 * 3 and all(r["converged"] for r in got.values())
    for (name, strength, fold), r in got.items():
        if fold == 0:
            continue
        own = [x for x in rows if x[0] == name and x[5] != fold]
        frame = models.sample_weights(spark.createDataFrame([x[:5] for x in own], "comparison_id string, protein_id long, partition string, unit long, target int"))
        weight = {w["protein_id"]: w["weight"] for w in frame.collect()}
        data = spark.createDataFrame([(float(x[4]), weight[x[1]], Vectors.sparse(6, x[7], [1.0] * len(x[7]))) for x in own], ["target", "weight", "features"])
        one = LogisticRegression(labelCol="target", weightCol="weight", regParam=strength / len(own), elasticNetParam=0.4, standardization=False, maxIter=2000, tol=1e-13).fit(data)
        assert np.abs(np.array(r["beta"]) - [*one.coefficients.toArray(), one.intercept]).max() < 1e-6


def test_many_comparisons_take_one_set_of_passes(spark, monkeypatch):
    monkeypatch.setattr(models, "BLOCK_ROWS", 7)
    rows = made(73, 24, 3, 2, seed=8)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fits", "fits")
    fits = models.fit_all(spark.createDataFrame(rows, ROWS).repartition(3), 2, models.Settings())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(tracker.getJobIdsForGroup("fits"))
    got = fits.collect()
    assert len(got) == 73 * 3 * 3 and all(r["converged"] for r in got)
    # a fixed number of jobs a pass, whatever the number of models
    assert jobs <= 12 * (max(r["passes"] for r in got) + 2)
    # at the minimum no part of the gradient exceeds the penalty
    by = defaultdict(list)
    for x in rows:
        by[x[0]].append(x)
    for r in got[::97]:
        own = [x for x in by[r["comparison_id"]] if x[5] != r["fold"]]
        size = defaultdict(int)
        for x in own:
            size[x[3]] += 1
        base = [1 / size[x[3]] for x in own]
        total = [sum(b for b, x in zip(base, own, strict=True) if x[4] == t) for t in (0, 1)]
        x = np.zeros((len(own), 4))
        for k, row in enumerate(own):
            x[k, row[7]] = 1
        x[:, 3] = 1
        w = np.array([b * len(own) / 2 / total[row[4]] for b, row in zip(base, own, strict=True)])
        beta = np.array(r["beta"])
        slope = x.T @ (w * (1 / (1 + np.exp(-x @ beta)) - [row[4] for row in own]))
        slope[:3] += r["strength"] * 0.8 * beta[:3]
        assert abs(slope[3]) < 1e-3 and (np.abs(slope[:3]) < r["strength"] * 0.2 + 1e-3).all()


def test_defaults_are_those_of_the_survey():
    s = models.Settings()
    assert (s.maximum_features, s.strengths, s.l1_ratio, s.folds, s.iterations, s.tolerance, s.repeats, s.permuted_features, s.minimum_samples, s.minimum_blocks, s.explained) == (500, (0.01, 0.1, 1.0), 0.2, 5, 2000, 1e-4, 10, 50, 10, 3, 10)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 12, 100, 997])
def test_permutations_are_permutations(spark, n):
    rows = spark.range(n).select("id", *[models.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(seed), F.lit("x")).alias(f"p{seed}") for seed in range(3)]).collect()
    for seed in range(3):
        assert sorted(r[f"p{seed}"] for r in rows) == list(range(n))
    if n > 50:
        assert len({tuple(r[f"p{s}"] for r in rows) for s in range(3)}) == 3
        steps = {(b["p0"] - a["p0"]) % n for a, b in zip(rows, rows[1:], strict=False)}
        assert len(steps) > n / 3


def test_permutation_importance_by_hand(spark):
    rng = random.Random(5)
    blocks = [("c", u, u % 2, rng.gauss(0, 1)) for u in range(40)] + [("e", u, u % 2, rng.gauss(0, 1)) for u in range(9)]
    values = [(c, u, at, rng.random()) for c, u, _, _ in blocks for at in range(3) if rng.random() < 0.4]
    table = [(c, "T", f"f{at}", at, k) for c in ("c", "e") for at, k in enumerate((2.5, -1.0, 0.1, 0.0))]
    got = models.permutation_importance(
        spark.createDataFrame(blocks, "comparison_id string, unit long, target int, logit double"), spark.createDataFrame(values, "comparison_id string, unit long, at int, value double"),
        spark.createDataFrame(table, "comparison_id string, feature_type string, feature_id string, at int, coefficient double"), repeats=4, top=3,
    ).collect()
    assert len(got) == 6
    order = {c: [r["unit"] for r in spark.createDataFrame([b[:2] for b in blocks if b[0] == c], "c string, unit long").orderBy(F.xxhash64("unit"), "unit").collect()] for c in ("c", "e")}
    for r in got:
        name, units = r["comparison_id"], order[r["comparison_id"]]
        at = int(r["feature_id"][1:])
        own = {u: v for c, u, a, v in values if c == name and a == at}
        by_unit = {u: (t, z) for c, u, t, z in blocks if c == name}
        k = next(x[4] for x in table if x[0] == name and x[3] == at)

        def balanced(z, by_unit=by_unit):
            rate = [np.mean([(z[u] >= 0) == bool(t) for u, (t, _) in by_unit.items() if t == side]) for side in (0, 1)]
            return sum(rate) / 2

        losses = []
        for repeat in range(4):
            to = [x["p"] for x in spark.range(len(units)).orderBy("id").select(models.permuted(F.col("id"), F.lit(len(units)).cast("long"), F.lit(1729), F.lit(repeat), F.lit("T"), F.lit(r["feature_id"])).alias("p")).collect()]
            moved = {units[to[p]]: own.get(u, 0.0) for p, u in enumerate(units)}
            losses.append(balanced({u: z for u, (_, z) in by_unit.items()}) - balanced({u: z + k * (moved[u] - own.get(u, 0.0)) for u, (_, z) in by_unit.items()}))
        assert abs(r["importance_mean"] - np.mean(losses)) < 1e-12 and abs(r["importance_stddev"] - np.std(losses)) < 1e-12


def test_predictions_and_strengths_by_hand(spark):
    rows = made(2, 60, 4, 3, seed=11)
    frame = spark.createDataFrame(rows, ROWS)
    fits = models.fit_all(frame, 3, models.Settings())
    fits.cache()
    found = {(r["comparison_id"], r["strength"], r["fold"]): np.array(r["beta"]) for r in fits.collect()}
    best = {r["comparison_id"]: r for r in models.select_strength(frame, fits).collect()}
    for name in ("c0", "c1"):
        areas = {}
        for strength in (0.01, 0.1, 1.0):
            folds = []
            for fold in range(3):
                beta, logits, target = found[name, strength, fold], defaultdict(list), {}
                for x in rows:
                    if x[0] == name and x[5] == fold:
                        logits[x[3]].append(beta[x[7]].sum() + beta[-1])
                        target[x[3]] = x[4]
                z = {u: np.mean(v) for u, v in logits.items()}
                pairs = [(z[a] > z[b]) + (z[a] == z[b]) / 2 for a in z for b in z if target[a] and not target[b]]
                folds.append(np.mean(pairs))
            areas[strength] = np.mean(folds)
        want = max(areas, key=lambda s: (round(areas[s], 12), s))
        assert (best[name]["strength"], best[name]["folds"]) == (want, 3) and abs(best[name]["cv_roc_auc"] - areas[want]) < 1e-9
    fits.unpersist()
