"""One elastic-net model a comparison: samples, features, folds, fit, held-out metrics and what explains it."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.operators.association import TECHNICAL_TYPES
from cohortry.operators.checks import require_empty
from cohortry.storage import materialize

FEATURE = ["feature_type", "feature_id"]
#: Different training rows of a comparison that are worked on as one matrix.
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """Sizes, strengths and seed of the models."""

    minimum_samples: int = 10
    minimum_blocks: int = 3
    maximum_features: int = 500
    folds: int = 5
    strengths: tuple[float, ...] = (0.01, 0.1, 1.0)
    l1_ratio: float = 0.2
    iterations: int = 2000
    tolerance: float = 1e-4
    repeats: int = 10
    permuted_features: int = 50
    explained: int = 10
    seed: int = 1729


# -- samples and features ----------------------------------------------------------------------------------------


def model_samples(members: DataFrame) -> DataFrame:
    """(comparison_id, protein_id, partition, unit, target): the samples of all comparisons; discovery blocks of both classes are left out.

    ``members``: comparison_id, protein_id, partition, unit, is_target. A protein in both classes of a comparison is an error.
    """
    rows = members.groupBy("comparison_id", "protein_id", "partition", "unit").agg(F.max("is_target").alias("t"), F.min("is_target").alias("b"))
    require_empty(rows.filter("t <> b"), "samples in both classes")
    rows = rows.select("comparison_id", "protein_id", "partition", "unit", F.col("t").cast("int").alias("target"))
    mixed = rows.filter("partition = 'DISCOVERY'").groupBy("comparison_id", "partition", "unit").agg(F.min("target").alias("a"), F.max("target").alias("b")).filter("a <> b").select("comparison_id", "partition", "unit")
    return rows.join(mixed, ["comparison_id", "partition", "unit"], "left_anti").select("comparison_id", "protein_id", "partition", "unit", "target")


def sample_status(samples: DataFrame, comparisons: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every comparison with its discovery and held-out samples and blocks by class, and whether discovery suffices for a model."""
    side = lambda part, value: (F.col("partition") == part) & (F.col("target") == value)
    parts = [(p, v, f"{p.lower()}_{n}") for p in ("DISCOVERY", "VALIDATION") for n, v in (("target", 1), ("background", 0))]
    counts = samples.groupBy("comparison_id").agg(*[F.count_if(side(p, v)).alias(f"{n}_count") for p, v, n in parts], *[F.count_distinct(F.when(side(p, v), F.col("unit"))).alias(f"{n}_blocks") for p, v, n in parts])
    rows = comparisons.select("comparison_id").distinct().join(counts, "comparison_id", "left").fillna(0)
    few = F.least("discovery_target_count", "discovery_background_count") < settings.minimum_samples
    blocks = F.least("discovery_target_blocks", "discovery_background_blocks") < settings.minimum_blocks
    return rows.withColumn("status", F.when(few, "INSUFFICIENT_SAMPLE_SIZE").when(blocks, "INSUFFICIENT_INDEPENDENT_GROUPS").otherwise("READY"))


def complete_features(samples: DataFrame, positives: DataFrame, universes: DataFrame, assessed: DataFrame, exploratory: DataFrame | None = None, technical: Sequence[str] = TECHNICAL_TYPES) -> DataFrame:
    """(comparison_id, feature_type, feature_id): features that every sample of a comparison was assessed for, without technical and exploratory ones.

    ``universes`` and ``assessed`` as for the associations; only universes are compared with the samples, not features.
    """
    sizes = samples.groupBy("comparison_id").agg(F.count("*").alias("n"))
    inside = samples.join(assessed, "protein_id").groupBy("comparison_id", "universe").agg(F.count("*").alias("k")).join(sizes, "comparison_id").filter("k = n").select("comparison_id", "universe")
    usable = universes.filter(~F.col("feature_type").isin(*technical))
    if exploratory is not None:
        usable = usable.join(exploratory.select(*FEATURE).distinct(), FEATURE, "left_anti")
    listed = usable.join(inside, "universe").select("comparison_id", *FEATURE)
    every = usable.filter("universe is null").select(*FEATURE).crossJoin(sizes.select("comparison_id"))
    return listed.unionByName(every.select("comparison_id", *FEATURE))


def select_features(samples: DataFrame, positives: DataFrame, complete: DataFrame, maximum: int = Settings.maximum_features) -> DataFrame:
    """(comparison_id, feature_type, feature_id, proteins, place): the most frequent features of discovery, a type in turn; constant ones are left out.

    Types take turns in order of their names: first the most frequent feature of each, then the second, and so on; ties go to the smaller id. Labels are not looked at.
    """
    own = samples.filter("partition = 'DISCOVERY'")
    sizes = own.groupBy("comparison_id").agg(F.count("*").alias("n"))
    # features are counted before those to keep are looked up, so rows of samples meet no list of features
    counts = own.join(positives.select("protein_id", *FEATURE).distinct(), "protein_id").groupBy("comparison_id", *FEATURE).agg(F.count("*").alias("proteins"))
    counts = counts.join(complete, ["comparison_id", *FEATURE], "left_semi").join(sizes, "comparison_id").filter("proteins < n")
    rank = F.row_number().over(Window.partitionBy("comparison_id", "feature_type").orderBy(F.desc("proteins"), "feature_id"))
    # no type can give more than the maximum
    ranked = counts.withColumn("_rank", rank).filter(F.col("_rank") <= maximum)
    place = F.row_number().over(Window.partitionBy("comparison_id").orderBy("_rank", "feature_type"))
    return ranked.withColumn("place", place).filter(F.col("place") <= maximum).select("comparison_id", *FEATURE, "proteins", "place")


def grouped_folds(samples: DataFrame, folds: int = Settings.folds, seed: int = Settings.seed) -> DataFrame:
    """(comparison_id, unit, target, fold, folds) of the discovery blocks: blocks of a class are dealt to folds in turn, in the order of a hash.

    There are ``folds`` of them, or as many as the smaller class has blocks.
    """
    blocks = samples.filter("partition = 'DISCOVERY'").select("comparison_id", "unit", "target").distinct()
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("unit").cast("string")), 256)
    place = F.row_number().over(Window.partitionBy("comparison_id", "target").orderBy(order, "unit"))
    sizes = blocks.groupBy("comparison_id", "target").agg(F.count("*").alias("n")).groupBy("comparison_id").agg(F.least(F.lit(folds), F.min("n")).cast("int").alias("folds"))
    return blocks.withColumn("_place", place).join(sizes, "comparison_id").select("comparison_id", "unit", "target", ((F.col("_place") - 1) % F.col("folds")).cast("int").alias("fold"), "folds")


def sample_weights(samples: DataFrame) -> DataFrame:
    """Add weight: one over the block's size, scaled so that each class adds up to half the samples."""
    w = samples.join(samples.groupBy("comparison_id", "unit").agg((1 / F.count("*")).alias("_w")), ["comparison_id", "unit"])
    classes = w.groupBy("comparison_id", "target").agg(F.sum("_w").alias("_total"), F.count("*").alias("_k"))
    n = classes.groupBy("comparison_id").agg(F.sum("_k").alias("_n"))
    out = w.join(classes, ["comparison_id", "target"]).join(n, "comparison_id")
    return out.withColumn("weight", F.col("_w") * F.col("_n") / 2 / F.col("_total")).drop("_w", "_total", "_k", "_n")


def feature_rows(samples: DataFrame, positives: DataFrame, chosen: DataFrame) -> DataFrame:
    """Add features: the places (from 0) of the chosen features that a sample has, in order; no more than a comparison has features.

    ``chosen``: comparison_id, feature_type, feature_id, place (from 1), as ``select_features`` gives them. All comparisons are done at once.
    """
    have = samples.join(positives.select("protein_id", *FEATURE).distinct(), "protein_id").join(chosen.select("comparison_id", *FEATURE, "place"), ["comparison_id", *FEATURE])
    lists = have.groupBy("comparison_id", "protein_id").agg(F.sort_array(F.collect_list((F.col("place") - 1).cast("int"))).alias("features"))
    return samples.join(lists, ["comparison_id", "protein_id"], "left").withColumn("features", F.coalesce("features", F.array().cast("array<int>")))


# -- fit ---------------------------------------------------------------------------------------------------------


def _training_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Different training rows of all comparisons, packed by comparison: fold, target, weight before scaling and features of up to ``BLOCK_ROWS`` rows.

    Rows of one comparison that agree in fold, class and features add up their weights, so a model reads different rows only.
    """
    weighted = rows.join(sizes, ["comparison_id", "unit"])
    different = weighted.groupBy("comparison_id", "fold", "target", "features").agg(F.sum("base").alias("base"))
    ordered = different.repartitionByRange("comparison_id", F.xxhash64("features")).sortWithinPartitions("comparison_id")
    names = ["fold", "target", "base", "sizes", "features"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            heads = batch.column("comparison_id").to_pylist()
            a = 0
            while a < len(heads):
                b = a
                while b < len(heads) and b - a < BLOCK_ROWS and heads[b] == heads[a]:
                    b += 1
                part = table.slice(a, b - a)
                lists = part.column("features").combine_chunks()
                cells = [part.column("fold").to_numpy().astype("<i4"), part.column("target").to_numpy().astype("<i4"), part.column("base").to_numpy().astype("<f8"), pc.list_value_length(lists).to_numpy().astype("<i4"), lists.flatten().to_numpy().astype("<i4")]
                yield pa.RecordBatch.from_arrays([pa.array([heads[a]]), *(pa.array([c.tobytes()], pa.binary()) for c in cells)], names=["comparison_id", *names])
                a = b

    return ordered.mapInArrow(pack, "comparison_id string, fold binary, target binary, base binary, sizes binary, features binary")


def _sums(x: np.ndarray, sign: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted log loss of some rows at ``beta``, its gradient and its matrix of second derivatives; the last column of ``x`` is 1."""
    margin = x @ beta
    p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
    loss = float(weight @ np.logaddexp(0.0, -sign * margin))
    return loss, x.T @ (weight * (p - (sign > 0))), x.T @ (x * (weight * p * (1 - p))[:, None])


def _direction(gradient: np.ndarray, curvature: np.ndarray, beta: np.ndarray, l1: float) -> np.ndarray:
    """The step that minimises the quadratic model plus the l1 penalty, by coordinate descent; the last coefficient is the intercept, without penalty."""
    step, bent, diagonal, k = np.zeros(len(beta)), np.zeros(len(beta)), curvature.diagonal(), len(beta)
    enough = 1e-12 * (1 + np.abs(beta).max())
    for _ in range(1000):
        largest = 0.0
        for j in range(k):
            a = diagonal[j]
            if a <= 1e-14:
                continue
            to = beta[j] + step[j] - (gradient[j] + bent[j]) / a
            if j < k - 1:
                to = math.copysign(max(abs(to) - l1 / a, 0.0), to)
            change = to - beta[j] - step[j]
            if change:
                bent += change * curvature[:, j]
                step[j] += change
                largest = max(largest, abs(change))
        if largest <= enough:
            break
    return step


_STATE = (
    "comparison_id string, strength double, fold int, background_scale double, target_scale double, at array<double>, trial array<double>, step array<double>, "
    "objective double, drop double, size double, passes int, done boolean, converged boolean"
)


def fit_all(rows: DataFrame, folds: int, settings: Settings = Settings()) -> DataFrame:
    """(comparison_id, strength, fold, beta, converged, passes): the elastic nets of all comparisons, strengths and left-out folds (-1: none), fitted together.

    ``rows``: comparison_id, unit, target, fold, features (places) and n_features of the discovery samples. The penalty of a model is strength * (l1_ratio * |b|_1 + (1 - l1_ratio) / 2 * |b|^2)
    beside the weighted log loss; weights are those of ``sample_weights`` over the training rows. ``beta`` ends with the intercept.

    Every pass is one job over the packed rows of all models: a task adds up loss, gradient and curvature of its rows, the sums of a model meet, and the model takes a proximal Newton step, or
    halves its last one if the loss did not fall enough. A model is done when its step is below the tolerance; the state of the models is a table with a row each.
    """
    sizes = rows.groupBy("comparison_id", "unit").agg((1 / F.count("*")).alias("base"))
    blocks = materialize(_training_blocks(rows, sizes), "training")
    classes = rows.join(sizes, ["comparison_id", "unit"]).groupBy("comparison_id", "fold", "target").agg(F.sum("base").alias("w"), F.count("*").alias("k"), F.max("n_features").alias("d"))
    left_out = rows.select("comparison_id", F.explode(F.sequence(F.lit(-1), F.lit(folds - 1))).alias("out")).distinct()
    use = classes.join(left_out, "comparison_id").filter("fold <> out")
    parts = use.groupBy("comparison_id", "out").agg(
        F.sum("k").alias("n"), F.sum(F.when(F.col("target") == 1, F.col("w"))).alias("t"), F.sum(F.when(F.col("target") == 0, F.col("w"))).alias("b"), F.max("d").alias("d"), F.count_distinct("fold").alias("left")
    )
    have = classes.groupBy("comparison_id").agg(F.count_distinct("fold").alias("all"))
    # leaving out a fold that a comparison does not have is no model of its own
    ready = parts.join(have, "comparison_id").filter("t is not null and b is not null and (out = -1 or left < all)")
    zeros = F.array_repeat(F.lit(0.0), F.col("d") + 1)
    state = ready.select(
        "comparison_id", F.explode(F.array(*[F.lit(float(x)) for x in settings.strengths])).alias("strength"), F.col("out").alias("fold"), (F.col("n") / 2 / F.col("b")).alias("background_scale"),
        (F.col("n") / 2 / F.col("t")).alias("target_scale"), zeros.alias("at"), zeros.alias("trial"), zeros.alias("step"), F.lit(float("inf")).alias("objective"), F.lit(0.0).alias("drop"), F.lit(1.0).alias("size"),
        F.lit(0).alias("passes"), F.lit(False).alias("done"), F.lit(False).alias("converged"),
    )
    state = materialize(state, "state")
    key, ratio, tolerance, most = ["comparison_id", "strength", "fold"], settings.l1_ratio, settings.tolerance, settings.iterations

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}

        def out() -> pa.RecordBatch:
            columns = [[*k, v[0], v[1].tobytes(), v[2].tobytes()] for k, v in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns, strict=True), [pa.string(), pa.float64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()], strict=True)], names=[*key, "loss", "gradient", "curvature"])

        for batch in batches:
            for row in batch.to_pylist():
                if sums and next(iter(sums))[0] != row["comparison_id"]:
                    yield out()
                fold, target, each, features = (np.frombuffer(row[n], "<i4") for n in ("fold", "target", "sizes", "features"))
                base = np.frombuffer(row["base"], "<f8")
                x = np.zeros((len(fold), len(row["models"][0]["trial"])))
                x[np.repeat(np.arange(len(fold)), each), features] = 1
                x[:, -1] = 1
                for m in row["models"]:
                    # rows of the fold that is left out weigh nothing
                    weight = base * np.where(target == 1, m["target_scale"], m["background_scale"]) * (fold != m["fold"])
                    found = _sums(x, np.where(target == 1, 1.0, -1.0), weight, np.array(m["trial"]))
                    have = sums.setdefault((row["comparison_id"], m["strength"], m["fold"]), [0.0, 0.0, 0.0])
                    for k in range(3):
                        have[k] = have[k] + found[k]
        if sums:
            yield out()

    def advance(sums: pa.Table, states: pa.Table) -> pa.Table:
        (m,) = states.to_pylist()
        if sums.num_rows:
            trial, at, k = np.array(m["trial"]), np.array(m["at"]), len(m["at"])
            gradient = sum(np.frombuffer(v) for v in sums.column("gradient").to_pylist())
            curvature = sum(np.frombuffer(v) for v in sums.column("curvature").to_pylist()).reshape(k, k)
            l1, ridge = m["strength"] * ratio, np.append(np.full(k - 1, m["strength"] * (1 - ratio)), 0.0)
            objective = sum(sums.column("loss").to_pylist()) + l1 * np.abs(trial[:-1]).sum() + (ridge * trial**2).sum() / 2
            m["passes"] += 1
            if objective <= m["objective"] + 0.01 * m["size"] * m["drop"] + 1e-12 * abs(objective):
                gradient = gradient + ridge * trial
                step = _direction(gradient, curvature + np.diag(ridge), trial, l1)
                # at a small step the next error is of its square, so the step is taken without another look
                small = np.abs(step).max() <= tolerance * max(1.0, np.abs(trial).max())
                m |= {"at": trial + step if small else trial, "step": step, "objective": objective, "size": 1.0, "drop": float(gradient @ step + l1 * (np.abs(trial + step)[:-1].sum() - np.abs(trial[:-1]).sum())), "trial": trial + step, "done": small, "converged": small}
            else:
                m["size"] /= 2
                m["trial"] = at + m["size"] * np.array(m["step"])
                m["done"] = m["size"] < 1e-12
            m["done"] = bool(m["done"] or m["passes"] >= most)
        return pa.table([pa.array([m[f.name]], f.type) for f in states.schema], schema=states.schema)

    while True:
        live = state.filter("not done")
        if live.isEmpty():
            break
        models = live.groupBy("comparison_id").agg(F.collect_list(F.struct("strength", "fold", "background_scale", "target_scale", "trial")).alias("models"))
        sums = blocks.join(models, "comparison_id").mapInArrow(add, "comparison_id string, strength double, fold int, loss double, gradient binary, curvature binary")
        state = materialize(sums.groupBy(*key).cogroup(state.groupBy(*key)).applyInArrow(advance, _STATE), "state")
    return state.select(*key, F.col("at").alias("beta"), "converged", "passes")


def logit(features: str, beta: str) -> Column:
    """The logit of a row: the coefficients at its places, and the intercept, which stands last."""
    return F.aggregate(F.col(features), F.element_at(F.col(beta), -1), lambda total, k: total + F.element_at(F.col(beta), k + 1))


def block_logits(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, unit, target, logit, probability) of pure blocks: the model is linear, so the logit of a block's mean vector is the mean of its members' logits."""
    blocks = rows.groupBy(*by, "unit").agg(F.min("target").alias("target"), F.max("target").alias("_high"), F.avg("logit").alias("logit")).filter("target = _high").drop("_high")
    return blocks.withColumn("probability", 1 / (1 + F.exp(-F.col("logit"))))


def block_means(rows: DataFrame, by: Sequence[str] = ("comparison_id",)) -> DataFrame:
    """(by, unit, target, at, value): the mean vector of every pure block without its zeros; blocks of both classes are left out."""
    by = list(by)
    sizes = rows.groupBy(*by, "unit").agg(F.min("target").alias("target"), F.max("target").alias("_high"), F.count("*").alias("_n")).filter("target = _high").drop("_high")
    ones = rows.select(*by, "unit", F.explode("features").alias("at")).groupBy(*by, "unit", "at").agg(F.count("*").alias("_k"))
    return ones.join(sizes, [*by, "unit"]).select(*by, "unit", "target", "at", (F.col("_k") / F.col("_n")).alias("value"))


def select_strength(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """(comparison_id, strength, cv_roc_auc, folds): the strength of the largest mean area under the curve over held-out blocks, the larger one of equals.

    ``rows``: comparison_id, unit, target, fold, folds, features of discovery; ``fits``: what ``fit_all`` gives. Strengths without a figure for every fold, and comparisons with fewer than two folds, are left out.
    """
    key = ["comparison_id", "strength", "fold"]
    scored = rows.filter("folds > 1").join(fits.select(*key, "beta"), ["comparison_id", "fold"]).withColumn("logit", logit("features", "beta"))
    areas = ranking_metrics(block_logits(scored, key), key).filter("roc_auc is not null")
    folds = rows.groupBy("comparison_id").agg(F.max("folds").cast("int").alias("folds"))
    means = areas.groupBy("comparison_id", "strength").agg(F.avg("roc_auc").alias("cv_roc_auc"), F.count("*").alias("k")).join(folds, "comparison_id").filter("k = folds")
    best = means.groupBy("comparison_id", "folds").agg(F.max(F.struct("cv_roc_auc", "strength")).alias("best"))
    return best.select("comparison_id", "best.strength", "best.cv_roc_auc", "folds")


# -- metrics -----------------------------------------------------------------------------------------------------


def ranking_metrics(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, roc_auc, average_precision, balanced_accuracy, matthews_correlation, brier_score) of target (0 or 1) and probability; all null without both classes.

    Rows of equal probability share a rank. Only different probabilities enter the windows.
    """
    by = list(by)
    marks = rows.groupBy(*by, "probability").agg(F.sum("target").alias("t"), F.count("*").alias("n"))
    up, down = Window.partitionBy(*by).orderBy("probability").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by).orderBy(F.desc("probability")).rowsBetween(Window.unboundedPreceding, 0)
    marks = marks.withColumns({"below": F.coalesce(F.sum("n").over(up), F.lit(0)), "tp": F.sum("t").over(down), "seen": F.sum("n").over(down)})
    area = marks.groupBy(*by).agg(
        F.sum(F.col("t") * (F.col("below") + (F.col("n") + 1) / 2)).alias("ranks"), F.sum("t").alias("pos"), F.sum("n").alias("all"), F.sum(F.col("t") * F.col("tp") / F.col("seen")).alias("ap"),
    )
    called = F.col("probability") >= 0.5
    cells = rows.groupBy(*by).agg(
        F.count_if(called & (F.col("target") == 1)).alias("tp"), F.count_if(called & (F.col("target") == 0)).alias("fp"), F.count_if(~called & (F.col("target") == 0)).alias("tn"), F.count_if(~called & (F.col("target") == 1)).alias("fn"),
        F.avg((F.col("probability") - F.col("target")) ** 2).alias("brier"),
    )
    joined = area.join(cells, by) if by else area.crossJoin(cells)
    neg = F.col("all") - F.col("pos")
    both = (F.col("pos") > 0) & (neg > 0)
    # four counts of 55,109 multiply beyond a long
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    product = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    matthews = F.when(product > 0, (F.col("tp") * F.col("tn") - F.col("fp") * F.col("fn")) / F.sqrt(product)).otherwise(0.0)
    return joined.select(
        *by, F.when(both, (F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * neg)).alias("roc_auc"), F.when(both, F.col("ap") / F.col("pos")).alias("average_precision"),
        F.when(both, (F.col("tp") / F.col("pos") + F.col("tn") / neg) / 2).alias("balanced_accuracy"), F.when(both, matthews).alias("matthews_correlation"), F.when(both, F.col("brier")).alias("brier_score"),
    )


def validation_metrics(blocks: DataFrame, samples: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Held-out metrics over the pure blocks of all comparisons, null where the held-out samples or blocks of a class are too few.

    ``blocks``: comparison_id, unit, target, probability; ``samples``: comparison_id, unit, target of the held-out partition.
    """
    found = ranking_metrics(blocks, ["comparison_id"])
    pure = samples.join(blocks.select("comparison_id", "unit"), ["comparison_id", "unit"], "left_semi")
    sizes = pure.groupBy("comparison_id").agg(F.least(F.count_if(F.col("target") == 1), F.count_if(F.col("target") == 0)).alias("_s"), F.least(F.count_distinct(F.when(F.col("target") == 1, F.col("unit"))), F.count_distinct(F.when(F.col("target") == 0, F.col("unit")))).alias("_b"))
    enough = (F.coalesce("_s", F.lit(0)) >= settings.minimum_samples) & (F.coalesce("_b", F.lit(0)) >= settings.minimum_blocks)
    names = [c for c in found.columns if c != "comparison_id"]
    return found.join(sizes, "comparison_id", "left").select("comparison_id", *[F.when(enough, F.col(c)).alias(c) for c in names])


# -- explanations ------------------------------------------------------------------------------------------------


def coefficient_table(fits: DataFrame, chosen: DataFrame) -> DataFrame:
    """(comparison_id, feature_type, feature_id, at, coefficient) of one fit a comparison, in the order of the features."""
    places = fits.select("comparison_id", F.posexplode("beta").alias("at", "coefficient"))
    return places.join(chosen.select("comparison_id", *FEATURE, (F.col("place") - 1).cast("int").alias("at")), ["comparison_id", "at"]).select("comparison_id", *FEATURE, "at", "coefficient")


def discovery_means(samples: DataFrame, positives: DataFrame, features: DataFrame) -> DataFrame:
    """(comparison_id, feature_type, feature_id, mean, target_mean, background_mean): means over the discovery blocks, in all and by class, of a feature's share in a block.

    Blocks without it count as 0 and are not listed.
    """
    own = samples.filter("partition = 'DISCOVERY'")
    have = own.join(positives.select("protein_id", *FEATURE).distinct(), "protein_id").join(features.select("comparison_id", *FEATURE), ["comparison_id", *FEATURE], "left_semi")
    return _share_means(own, have, features, FEATURE)


def place_means(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """``discovery_means`` of ``rows`` that hold the places of their features: comparison_id, partition, unit, target, features."""
    own = rows.filter("partition = 'DISCOVERY'")
    return _share_means(own, own.select("comparison_id", "unit", "target", F.explode("features").alias("at")), coefficients, ["at"])


def _share_means(own: DataFrame, have: DataFrame, features: DataFrame, key: list[str]) -> DataFrame:
    """Means of the shares of the features, told apart by ``key``, in the blocks of ``own``; ``have``: a row for each sample and feature that it has."""
    sizes = own.groupBy("comparison_id", "unit", "target").agg(F.count("*").alias("n"))
    blocks = sizes.groupBy("comparison_id").agg(F.count("*").alias("_b"), F.count_if(F.col("target") == 1).alias("_t"), F.count_if(F.col("target") == 0).alias("_c"))
    share = have.groupBy("comparison_id", "unit", "target", *key).agg(F.count("*").alias("k")).join(sizes, ["comparison_id", "unit", "target"]).withColumn("s", F.col("k") / F.col("n"))
    sums = share.groupBy("comparison_id", *key).agg(F.sum("s").alias("_s"), F.sum(F.when(F.col("target") == 1, F.col("s")).otherwise(0.0)).alias("_st"))
    rows = features.select("comparison_id", *dict.fromkeys([*FEATURE, *key])).join(sums, ["comparison_id", *key], "left").fillna(0.0, ["_s", "_st"]).join(blocks, "comparison_id")
    return rows.select("comparison_id", *FEATURE, (F.col("_s") / F.col("_b")).alias("mean"), (F.col("_st") / F.col("_t")).alias("target_mean"), ((F.col("_s") - F.col("_st")) / F.col("_c")).alias("background_mean"))


def linear_contributions(samples: DataFrame, positives: DataFrame, coefficients: DataFrame, means: DataFrame, top: int | None = None) -> DataFrame:
    """(comparison_id, protein_id, feature_type, feature_id, value, contribution, absolute_rank): coefficient times (value - mean over the discovery blocks).

    This is the interventional additive explanation of a linear model. ``coefficients``: comparison_id, feature_type, feature_id, at, coefficient. ``top`` keeps the largest of each protein; ties go to the earlier feature.
    """
    rows = feature_rows(samples.select("comparison_id", "protein_id"), positives, coefficients.withColumn("place", F.col("at") + 1))
    return row_contributions(rows, coefficients, means, top)


def row_contributions(rows: DataFrame, coefficients: DataFrame, means: DataFrame, top: int | None = None) -> DataFrame:
    """``linear_contributions`` of ``rows``: comparison_id, protein_id, features (the places, ``at``, of those that a sample has).

    What a feature adds where it is absent is the same for all samples of a comparison, so a row per comparison holds these in order, and a sample takes the first of them beside
    its own features: samples are neither multiplied by features nor moved.
    """
    table = coefficients.join(means.select("comparison_id", *FEATURE, "mean"), ["comparison_id", *FEATURE])

    def item(value: int) -> Column:
        contribution = F.col("coefficient") * (F.lit(value) - F.col("mean"))
        return F.struct((-F.abs(contribution)).alias("order"), "at", *FEATURE, F.lit(value).alias("value"), "mean", "coefficient", contribution.alias("contribution"))

    listed = table.groupBy("comparison_id").agg(F.sort_array(F.collect_list(item(0))).alias("absent"), F.map_from_entries(F.collect_list(F.struct("at", item(1)))).alias("present"))
    held = rows.select("comparison_id", "protein_id", "features").join(materialize(listed, "listed"), "comparison_id")
    absent = F.col("absent") if top is None else F.slice("absent", 1, F.size("features") + top)
    every = F.sort_array(F.concat(F.filter(absent, lambda x: ~F.array_contains("features", x["at"])), F.transform("features", lambda k: F.element_at("present", k))))
    ranked = held.select("comparison_id", "protein_id", F.posexplode(every if top is None else F.slice(every, 1, top)).alias("_k", "_x"))
    return ranked.select("comparison_id", "protein_id", *[F.col(f"_x.{c}") for c in (*FEATURE, "value", "mean", "coefficient", "contribution")], (F.col("_k") + 1).alias("absolute_rank"))


def importance_rank(coefficients: DataFrame) -> DataFrame:
    """Add importance_rank: the place of a feature in its comparison by falling absolute coefficient, then key."""
    rank = F.row_number().over(Window.partitionBy("comparison_id").orderBy(F.desc(F.abs("coefficient")), *FEATURE))
    return coefficients.withColumn("importance_rank", rank)


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Where a keyed pseudorandom permutation of 0 to n - 1 puts x.

    A Feistel network on the cells of a grid that is hardly larger than n, walked until it ends inside. The walk is bounded: of 64 steps every one leaves the grid's
    surplus with a chance of 1 - 1 / sqrt(n) at least, and an x that never did would be null.
    """
    wide = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    high = F.ceil(n / wide).cast("long")

    def walk(y: Column) -> Column:
        left, right = F.floor(y / high).cast("long"), y % high
        for r in range(4):
            if r % 2:
                right = F.pmod(right + F.xxhash64(*key, F.lit(r), left), high)
            else:
                left = F.pmod(left + F.xxhash64(*key, F.lit(r), right), wide)
        return left * high + right

    found = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.lit(-1).cast("long"), lambda y, k: F.when((y >= 0) & (y < n), y).otherwise(walk(F.when(y < 0, x).otherwise(y))))
    return F.when(found < n, found)


def permutation_importance(blocks: DataFrame, values: DataFrame, coefficients: DataFrame, repeats: int = Settings.repeats, top: int = Settings.permuted_features, seed: int = Settings.seed) -> DataFrame:
    """(comparison_id, feature_type, feature_id, importance_mean, importance_stddev): the loss of balanced accuracy over held-out blocks when one feature's values are dealt anew.

    ``blocks``: comparison_id, unit, target, logit; ``values``: comparison_id, unit, at, value, without zeros; ``coefficients``: as ``coefficient_table`` gives them. The ``top`` features of a comparison by absolute coefficient are
    tried. A keyed permutation of the blocks sends every value to another block, so only blocks that lose or get a value are looked at: rows grow with the values that are not 0, not with blocks times features.
    """
    rank = F.row_number().over(Window.partitionBy("comparison_id").orderBy(F.desc(F.abs("coefficient")), "at"))
    tried = coefficients.withColumn("_k", rank).filter(F.col("_k") <= top).select("comparison_id", *FEATURE, "at", "coefficient")
    placed = materialize(blocks.withColumn("r", (F.row_number().over(Window.partitionBy("comparison_id").orderBy(F.xxhash64("unit"), "unit")) - 1).cast("long")), "placed")
    hit = (F.col("target") == 1) == (F.col("logit") >= 0)
    n = placed.groupBy("comparison_id").agg(F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg"))
    have = values.join(placed.select("comparison_id", "unit", "r"), ["comparison_id", "unit"]).join(tried, ["comparison_id", "at"]).join(n, "comparison_id")
    dealt = have.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    to = permuted(F.col("r"), F.col("n"), F.lit(seed), F.col("repeat"), *[F.col(c) for c in FEATURE])
    moved = F.explode(F.array(F.struct(F.col("r").alias("r"), (-F.col("value")).alias("by")), F.struct(to.alias("r"), F.col("value").alias("by"))))
    changes = dealt.select("comparison_id", *FEATURE, "repeat", "coefficient", moved.alias("m")).groupBy("comparison_id", *FEATURE, "repeat", "coefficient", F.col("m.r").alias("r")).agg(F.sum("m.by").alias("by"))
    after = changes.join(placed.select("comparison_id", "r", "target", "logit"), ["comparison_id", "r"])
    now = (F.col("target") == 1) == (F.col("logit") + F.col("coefficient") * F.col("by") >= 0)
    lost = (hit.cast("int") - now.cast("int")).cast("long")
    counts = after.groupBy("comparison_id", *FEATURE, "repeat").agg(F.sum(F.when(F.col("target") == 1, lost).otherwise(0)).alias("t"), F.sum(F.when(F.col("target") == 0, lost).otherwise(0)).alias("b"))
    # a feature that no held-out block has loses nothing
    every = tried.select("comparison_id", *FEATURE, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat")).join(n, "comparison_id").join(counts, ["comparison_id", *FEATURE, "repeat"], "left").fillna(0, ["t", "b"])
    loss = (F.col("t") / F.col("pos") + F.col("b") / F.col("neg")) / 2
    return every.withColumn("loss", loss).groupBy("comparison_id", *FEATURE).agg(F.avg("loss").alias("importance_mean"), F.stddev_pop("loss").alias("importance_stddev"))


def model_status(status: DataFrame, fitted: DataFrame) -> DataFrame:
    """The status of every comparison's model: why it was not fitted, or how complete it is.

    ``status``: what ``sample_status`` gives; ``fitted``: comparison_id, features, strength, adequate, converged; a missing row means no usable feature, a null strength that no strength could be chosen.
    """
    rows = status.join(fitted, "comparison_id", "left")
    held = F.col("validation_target_count") + F.col("validation_background_count")
    done = F.when(held == 0, "COMPLETE_NO_VALIDATION").when(~F.coalesce("adequate", F.lit(False)), "COMPLETE_VALIDATION_UNDERPOWERED").otherwise("COMPLETE")
    final = (
        F.when(F.col("status") != "READY", F.col("status")).when(F.coalesce("features", F.lit(0)) == 0, "NO_ELIGIBLE_FEATURES").when(F.col("strength").isNull(), "CROSS_VALIDATION_FAILED")
        .when(F.col("converged"), done).otherwise(F.concat(done, F.lit("_CONVERGENCE_WARNING")))
    )
    return rows.withColumn("status", final)


@dataclass(frozen=True)
class Fitted:
    """The tables of all models. Those that need more than the fit are written when they are first asked for."""

    coefficients: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    make_models: Callable[[], DataFrame]
    make_permutation: Callable[[], DataFrame]
    make_explanations: Callable[[], DataFrame]

    @cached_property
    def models(self) -> DataFrame:
        return materialize(self.make_models(), "models")

    @cached_property
    def permutation(self) -> DataFrame:
        return materialize(self.make_permutation(), "permutation")

    @cached_property
    def explanations(self) -> DataFrame:
        """Not written: as large as the held-out samples times ``explained``, and made in one pass over them."""
        return self.make_explanations()


def fit_comparisons(members: DataFrame, positives: DataFrame, universes: DataFrame, assessed: DataFrame, comparisons: DataFrame, exploratory: DataFrame | None = None, settings: Settings = Settings()) -> Fitted:
    """Fit, validate and explain a model for every comparison that has enough samples; all comparisons go through one set of jobs."""
    samples = materialize(model_samples(members), "samples")
    status = materialize(sample_status(samples, comparisons, settings), "status")
    ready = status.filter("status = 'READY'").select("comparison_id")
    usable = samples.join(ready, "comparison_id", "left_semi")
    chosen = materialize(select_features(usable, positives, complete_features(usable, positives, universes, assessed, exploratory), settings.maximum_features), "chosen")
    counts = chosen.groupBy("comparison_id").agg(F.count("*").cast("int").alias("n_features"))
    rows = materialize(feature_rows(usable, positives, chosen).join(counts, "comparison_id"), "rows")
    own = rows.filter("partition = 'DISCOVERY'")
    dealt = materialize(own.join(grouped_folds(usable, settings.folds, settings.seed).select("comparison_id", "unit", "fold", "folds"), ["comparison_id", "unit"]), "folds")
    fits = materialize(fit_all(dealt, settings.folds, settings), "fits")
    strengths = materialize(select_strength(dealt, fits), "strengths")
    final = materialize(fits.filter("fold = -1").join(strengths, ["comparison_id", "strength"]), "final")
    coefficients = materialize(importance_rank(coefficient_table(final, chosen)), "coefficients")
    scored = rows.join(final.select("comparison_id", "beta"), "comparison_id").withColumn("logit", logit("features", "beta")).drop("beta")
    scored = materialize(scored.withColumn("probability", 1 / (1 + F.exp(-F.col("logit")))), "scored")
    held = scored.filter("partition = 'VALIDATION'")
    blocks = materialize(block_logits(held, ["comparison_id"]), "blocks")
    pure = held.join(blocks.select("comparison_id", "unit"), ["comparison_id", "unit"], "left_semi")
    enough = pure.groupBy("comparison_id").agg(
        ((F.least(F.count_if(F.col("target") == 1), F.count_if(F.col("target") == 0)) >= settings.minimum_samples)
         & (F.least(F.count_distinct(F.when(F.col("target") == 1, F.col("unit"))), F.count_distinct(F.when(F.col("target") == 0, F.col("unit")))) >= settings.minimum_blocks)).alias("adequate")
    )
    adequate = enough.filter("adequate").select("comparison_id")
    metrics = validation_metrics(blocks, held.select("comparison_id", "unit", "target"), settings)

    @cache
    def means() -> DataFrame:
        return materialize(place_means(rows, coefficients), "means")

    def models() -> DataFrame:
        fitted = counts.join(final.select("comparison_id", "strength", "cv_roc_auc", "folds", "converged", F.element_at("beta", -1).alias("intercept")), "comparison_id", "left").join(enough, "comparison_id", "left")
        fitted = fitted.select("comparison_id", F.col("n_features").alias("features"), "strength", "cv_roc_auc", F.coalesce("folds", F.lit(0)).alias("folds"), F.coalesce("adequate", F.lit(False)).alias("adequate"), "converged", "intercept")
        base = coefficients.join(means(), ["comparison_id", *FEATURE]).groupBy("comparison_id").agg(F.sum(F.col("coefficient") * F.col("mean")).alias("_base"))
        return model_status(status, fitted).join(base, "comparison_id", "left").withColumn("expected_log_odds", F.col("intercept") + F.col("_base")).drop("_base").join(metrics, "comparison_id", "left")

    def permutation() -> DataFrame:
        return permutation_importance(blocks.join(adequate, "comparison_id", "left_semi"), block_means(held), coefficients.join(adequate, "comparison_id", "left_semi"), settings.repeats, settings.permuted_features, settings.seed)

    def explanations() -> DataFrame:
        return row_contributions(held, coefficients, means(), settings.explained)

    predictions = scored.select("comparison_id", "protein_id", "partition", "unit", "target", "probability")
    return Fitted(coefficients, predictions, metrics, models, permutation, explanations)


def importance_table(fitted: Fitted, means: DataFrame) -> DataFrame:
    """Every feature of every model: coefficient, odds multiplier, prevalences in discovery by class and their difference, permutation importance and rank."""
    rows = fitted.coefficients.join(means, ["comparison_id", *FEATURE]).join(fitted.permutation, ["comparison_id", *FEATURE], "left")
    odds = F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("coefficient"))))
    return rows.select(
        "comparison_id", *FEATURE, "coefficient", odds.alias("odds_multiplier"), F.col("target_mean").alias("target_prevalence"), F.col("background_mean").alias("background_prevalence"),
        (F.col("target_mean") - F.col("background_mean")).alias("prevalence_difference"), "importance_mean", "importance_stddev", "importance_rank",
    )
