"""Queries of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import models
from cohortry.plans import bindings as B
from cohortry.plans.cohort import _BASE, cohort
from cohortry.plans.registry import query
from cohortry.plans.reports import r7
from cohortry.storage import materialize

SETTINGS = models.Settings()
_SAMPLES = f"""{_BASE}, mixed AS (SELECT comparison_id, unit FROM blocks WHERE mixed AND partition = 'DISCOVERY'),
    samples AS (SELECT m.comparison_id, m.protein_id, m.partition, m.unit, m.is_target::INT AS target FROM members m WHERE m.partition <> 'DISCOVERY' OR (m.comparison_id, m.unit) NOT IN (SELECT (comparison_id, unit) FROM mixed))"""


def samples(spark: SparkSession, d: str) -> DataFrame:
    return models.model_samples(B.members(spark, d))


@query("mlx01_sample_selection", f"""WITH {_SAMPLES}, c AS (SELECT comparison_id, count_if(partition = 'DISCOVERY' AND target = 1) AS discovery_target_count, count_if(partition = 'DISCOVERY' AND target = 0) AS discovery_background_count, count_if(partition = 'VALIDATION' AND target = 1) AS validation_target_count, count_if(partition = 'VALIDATION' AND target = 0) AS validation_background_count,
        count(DISTINCT CASE WHEN partition = 'DISCOVERY' AND target = 1 THEN unit END) AS discovery_target_blocks, count(DISTINCT CASE WHEN partition = 'DISCOVERY' AND target = 0 THEN unit END) AS discovery_background_blocks, count(DISTINCT CASE WHEN partition = 'VALIDATION' AND target = 1 THEN unit END) AS validation_target_blocks, count(DISTINCT CASE WHEN partition = 'VALIDATION' AND target = 0 THEN unit END) AS validation_background_blocks FROM samples GROUP BY 1)
    SELECT *, CASE WHEN least(discovery_target_count, discovery_background_count) < 10 THEN 'INSUFFICIENT_SAMPLE_SIZE' WHEN least(discovery_target_blocks, discovery_background_blocks) < 3 THEN 'INSUFFICIENT_INDEPENDENT_GROUPS' ELSE 'READY' END AS status FROM c""")
def mlx01(spark: SparkSession, d: str) -> DataFrame:
    return models.sample_status(samples(spark, d), B.frame(spark, d, "comparisons"), SETTINGS)


_COMPLETE = f"""{_SAMPLES}, n AS (SELECT comparison_id, count(*) AS n FROM samples GROUP BY 1), inside AS (SELECT s.comparison_id, a.universe, count(*) AS k FROM samples s JOIN assessed a USING (protein_id) GROUP BY ALL),
    complete AS (SELECT n.comparison_id, u.feature_type, u.feature_id FROM n CROSS JOIN univ u LEFT JOIN inside i ON i.comparison_id = n.comparison_id AND i.universe = u.universe WHERE u.feature_type NOT IN ('EVIDENCE_AVAILABILITY', 'STRUCTURE_AVAILABLE') AND (u.feature_type, u.feature_id) NOT IN (SELECT (feature_type, feature_id) FROM exploratory) AND (u.universe IS NULL OR i.k = n.n))"""


@query("mlx02_complete_case_features", f"WITH {_COMPLETE} SELECT comparison_id, feature_type, feature_id FROM complete")
def mlx02(spark: SparkSession, d: str) -> DataFrame:
    _, positives, universes, assessed = cohort(spark, d)
    return models.complete_features(samples(spark, d), positives, universes, assessed, B.frame(spark, d, "exploratory"))


_ALL = f"""{_SAMPLES}, prev AS (SELECT s.comparison_id, f.feature_type, f.feature_id, count(*) AS proteins FROM samples s JOIN positives f USING (protein_id) WHERE s.partition = 'DISCOVERY' GROUP BY ALL), n AS (SELECT comparison_id, count(*) AS n FROM samples WHERE partition = 'DISCOVERY' GROUP BY 1),
    ranked AS (SELECT p.*, row_number() OVER (PARTITION BY comparison_id, feature_type ORDER BY proteins DESC, feature_id) AS k FROM prev p JOIN n USING (comparison_id) WHERE proteins < n), placed AS (SELECT *, row_number() OVER (PARTITION BY comparison_id ORDER BY k, feature_type) AS place FROM ranked)"""


def _everything(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, positives, all features of all comparisons), as if all had been assessed."""
    positives = materialize(B.frame(spark, d, "positives"), "positives")
    every = positives.select("feature_type", "feature_id").distinct().crossJoin(F.broadcast(B.frame(spark, d, "comparisons").select("comparison_id")))
    return materialize(samples(spark, d), "samples"), positives, every


@query("win02_round_robin_features", f"WITH {_ALL} SELECT comparison_id, feature_type, feature_id, proteins, place FROM placed WHERE place <= 500")
def win02(spark: SparkSession, d: str) -> DataFrame:
    return models.select_features(*_everything(spark, d))


@query("mlx03_feature_vectors", f"""
    WITH {_ALL},
    x AS (
        SELECT s.comparison_id, s.protein_id, p.place - 1 AS k FROM samples s JOIN positives f USING (protein_id)
        JOIN placed p ON p.comparison_id = s.comparison_id AND p.feature_type = f.feature_type AND p.feature_id = f.feature_id WHERE p.place <= 500
    ),
    v AS (SELECT comparison_id, protein_id, string_agg(k, ',' ORDER BY k) AS places, count(*) AS ones FROM x GROUP BY ALL)
    SELECT s.comparison_id, s.protein_id, s.partition, s.target, coalesce(v.places, '') AS places, coalesce(v.ones, 0)::INT AS ones
    FROM samples s LEFT JOIN v USING (comparison_id, protein_id)""")
def mlx03(spark: SparkSession, d: str) -> DataFrame:
    own, positives, every = _everything(spark, d)
    chosen = materialize(models.select_features(own, positives, every), "chosen")
    rows = models.feature_rows(own, positives, chosen)
    return rows.select("comparison_id", "protein_id", "partition", "target", F.array_join(F.col("features").cast("array<string>"), ",").alias("places"), F.size("features").alias("ones"))


@query("mlx04_grouped_folds", f"""WITH {_SAMPLES}, b AS (SELECT DISTINCT comparison_id, unit, target FROM samples WHERE partition = 'DISCOVERY'), p AS (SELECT *, row_number() OVER (PARTITION BY comparison_id, target ORDER BY sha256('1729:' || unit), unit) AS k FROM b), f AS (SELECT comparison_id, least(5, min(n))::INT AS folds FROM (SELECT comparison_id, target, count(*) AS n FROM b GROUP BY ALL) GROUP BY 1)
    SELECT comparison_id, unit, target, ((k - 1) % folds)::INT AS fold, folds FROM p JOIN f USING (comparison_id)""")
def mlx04(spark: SparkSession, d: str) -> DataFrame:
    return models.grouped_folds(samples(spark, d))


@query("agg39_block_feature_mean", f"""
    WITH {B.MEMBERS}, {B.POSITIVES}, pure AS (SELECT comparison_id, unit
    FROM members GROUP BY ALL HAVING bool_or(is_target) = bool_and(is_target)), x AS (SELECT m.comparison_id, m.unit, m.protein_id,
    f.feature_id FROM members m JOIN pure USING (comparison_id, unit)
    JOIN positives f USING (protein_id) WHERE f.feature_type = 'DOMAIN'), n AS (SELECT comparison_id, unit, count(*) AS n
    FROM members GROUP BY ALL) SELECT comparison_id, unit, feature_id, round(count(*) / any_value(n), 7) AS mean
    FROM x JOIN n USING (comparison_id, unit) GROUP BY ALL""")
def agg39(spark: SparkSession, d: str) -> DataFrame:
    m = B.members(spark, d)
    sizes = m.groupBy("comparison_id", "unit").agg(F.count("*").alias("n"), F.max("is_target").alias("x"), F.min("is_target").alias("y")).filter("x = y")
    rows = m.join(sizes, ["comparison_id", "unit"]).join(B.frame(spark, d, "positives").filter("feature_type = 'DOMAIN'"), "protein_id")
    return rows.groupBy("comparison_id", "unit", "feature_id").agg(F.round(F.count("*") / F.max("n"), 7).alias("mean"))


@query("agg40_sample_weights", f"""
    WITH {_SAMPLES}, w AS (SELECT comparison_id, protein_id, target, 1 / count(*) OVER (PARTITION BY comparison_id, unit) AS w
    FROM samples WHERE partition = 'DISCOVERY') SELECT comparison_id, protein_id, round(w * count(*) OVER (PARTITION BY comparison_id)
    / 2 / sum(w) OVER (PARTITION BY comparison_id, target), 7) AS weight
    FROM w""")
def agg40(spark: SparkSession, d: str) -> DataFrame:
    weighted = models.sample_weights(samples(spark, d).filter("partition = 'DISCOVERY'"))
    return weighted.select("comparison_id", "protein_id", F.round("weight", 7).alias("weight"))


_BLOCKS = f"""{B.cte('predictions')}, b AS (SELECT comparison_id, partition_key AS unit, min((true_class = 'TARGET')::INT) AS target, avg(predicted_probability) AS p FROM predictions WHERE partition = 'VALIDATION' GROUP BY 1, 2 HAVING count(DISTINCT true_class) = 1)"""


@query("mlx08_validation_metrics", f"""WITH {_BLOCKS}, r AS (SELECT *, sum(1) OVER (PARTITION BY comparison_id ORDER BY p) AS upto, count(*) OVER (PARTITION BY comparison_id, p) AS ties, sum(target) OVER (PARTITION BY comparison_id ORDER BY p DESC) AS tp, count(*) OVER (PARTITION BY comparison_id ORDER BY p DESC) AS seen FROM b),
    a AS (SELECT comparison_id, sum(target) AS pos, count(*) - sum(target) AS neg, sum(CASE WHEN target = 1 THEN upto - (ties - 1) / 2 END) AS ranks, sum(CASE WHEN target = 1 THEN tp / seen END) AS ap, count_if(p >= 0.5 AND target = 1) AS tpn, count_if(p >= 0.5 AND target = 0) AS fpn, count_if(p < 0.5 AND target = 0) AS tnn, count_if(p < 0.5 AND target = 1) AS fnn, avg((p - target) ** 2) AS brier FROM r GROUP BY 1)
    SELECT comparison_id, round((ranks - pos * (pos + 1) / 2) / (pos * neg), 7) AS roc_auc, round(ap / pos, 7) AS average_precision, round((tpn / pos + tnn / neg) / 2, 7) AS balanced_accuracy, round(CASE WHEN (tpn + fpn) * (tpn + fnn) * (tnn + fpn) * (tnn + fnn) > 0 THEN (tpn * tnn - fpn * fnn) / sqrt(((tpn + fpn) * (tpn + fnn) * (tnn + fpn) * (tnn + fnn))::DOUBLE) ELSE 0 END, 7) AS matthews_correlation, round(brier, 7) AS brier_score FROM a""")
def mlx08(spark: SparkSession, d: str) -> DataFrame:
    held = B.frame(spark, d, "predictions").filter("partition = 'VALIDATION'").withColumnRenamed("partition_key", "unit").withColumn("target", (F.col("true_class") == "TARGET").cast("int"))
    blocks = held.groupBy("comparison_id", "unit").agg(F.min("target").alias("target"), F.max("target").alias("h"), F.avg("predicted_probability").alias("probability")).filter("target = h").drop("h")
    found = models.validation_metrics(materialize(blocks, "blocks"), held, SETTINGS)
    return r7(found, *[c for c in found.columns if c != "comparison_id"])


_MEANS = f"""{_ALL}, chosen AS (SELECT * FROM placed WHERE place <= 500), size AS (SELECT comparison_id, unit, target, count(*) AS n FROM samples WHERE partition = 'DISCOVERY' GROUP BY ALL), tot AS (SELECT comparison_id, count(*) AS b, sum(target) AS t FROM size GROUP BY 1),
    sh AS (SELECT s.comparison_id, s.unit, s.target, f.feature_type, f.feature_id, count(*) / any_value(z.n) AS v FROM samples s JOIN positives f USING (protein_id) JOIN size z ON z.comparison_id = s.comparison_id AND z.unit = s.unit WHERE s.partition = 'DISCOVERY' GROUP BY ALL),
    means AS (SELECT c.comparison_id, c.feature_type, c.feature_id, c.place, coalesce(sum(v), 0) / any_value(b) AS mean, coalesce(sum(CASE WHEN sh.target = 1 THEN v END), 0) / any_value(t) AS target_mean, coalesce(sum(CASE WHEN sh.target = 0 THEN v END), 0) / any_value(b - t) AS background_mean FROM chosen c JOIN tot USING (comparison_id) LEFT JOIN sh ON sh.comparison_id = c.comparison_id AND sh.feature_type = c.feature_type AND sh.feature_id = c.feature_id GROUP BY ALL),
    coef AS (SELECT *, (place * 7 % 11 - 5) / 4e0 AS coefficient FROM means)"""


def _explained(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(samples, positives, coefficients, means); the coefficients are numbers that stand in for a fit."""
    own, positives, every = _everything(spark, d)
    chosen = materialize(models.select_features(own, positives, every), "chosen")
    means = materialize(models.discovery_means(own, positives, chosen), "means")
    return own, positives, chosen.select("comparison_id", "feature_type", "feature_id", F.col("place").alias("at"), ((F.col("place") * 7 % 11 - 5) / 4).alias("coefficient")), means


@query("mlx10_linear_shap", f"""
    WITH {_MEANS}, x AS (SELECT s.comparison_id, s.protein_id, c.feature_type, c.feature_id, c.place, c.coefficient * ((p.protein_id IS
    NOT NULL)::INT - c.mean) AS contribution FROM samples s JOIN coef c USING (comparison_id)
    LEFT JOIN positives p ON p.protein_id = s.protein_id AND p.feature_type = c.feature_type AND p.feature_id = c.feature_id
    WHERE s.partition = 'VALIDATION') SELECT comparison_id, feature_type, feature_id, count(*) AS samples,
    round(avg(abs(contribution)), 6) AS mean_absolute, round(sum(contribution), 4) AS total
    FROM x GROUP BY ALL""")
def mlx10(spark: SparkSession, d: str) -> DataFrame:
    own, positives, coefficients, means = _explained(spark, d)
    found = models.linear_contributions(own.filter("partition = 'VALIDATION'"), positives, coefficients, means)
    return found.groupBy("comparison_id", "feature_type", "feature_id").agg(F.count("*").alias("samples"), F.round(F.avg(F.abs("contribution")), 6).alias("mean_absolute"), F.round(F.sum("contribution"), 4).alias("total"))


@query("win10_importance_rank", f"""
    WITH {_MEANS} SELECT comparison_id, feature_type, feature_id, coefficient, row_number() OVER (PARTITION BY comparison_id
    ORDER BY abs(coefficient) DESC, feature_type, feature_id) AS importance_rank, round(target_mean, 7) AS target_mean,
    round(background_mean, 7) AS background_mean FROM coef""")
def win10(spark: SparkSession, d: str) -> DataFrame:
    _, _, coefficients, means = _explained(spark, d)
    rows = models.importance_rank(coefficients).join(means, ["comparison_id", "feature_type", "feature_id"])
    return r7(rows.select("comparison_id", "feature_type", "feature_id", "coefficient", "importance_rank", "target_mean", "background_mean"), "target_mean", "background_mean")


_FITTED: dict[tuple[str, str], models.Fitted] = {}


def fitted(spark: SparkSession, d: str) -> models.Fitted:
    """The models of all comparisons; a session fits them once, as six queries read them."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        members, positives, universes, assessed = cohort(spark, d)
        # every protein of the stand-in counts as assessed for domains, so that models have some features
        whole = universes.withColumn("universe", F.when(F.col("feature_type") != "DOMAIN", F.col("universe")))
        _FITTED[key] = models.fit_comparisons(members, positives, whole, assessed, B.frame(spark, d, "comparisons"), B.frame(spark, d, "exploratory", positives=positives), SETTINGS)
    return _FITTED[key]


@query("mlx05_elastic_net_fit")
def mlx05(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).coefficients.select("comparison_id", "feature_type", "feature_id", "coefficient", "importance_rank")


@query("mlx06_strength_selection")
def mlx06(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).models.select("comparison_id", "strength", "cv_roc_auc", "folds")


@query("mlx07_predictions")
def mlx07(spark: SparkSession, d: str) -> DataFrame:
    rows, p = fitted(spark, d).predictions, F.col("probability")
    return rows.select("comparison_id", "protein_id", "partition", "unit", "target", "probability", F.when(p >= 0.5, "TARGET").otherwise("BACKGROUND").alias("predicted_class"), ((p >= 0.5).cast("int") == F.col("target")).alias("correct"))


@query("mlx09_permutation_importance")
def mlx09(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).permutation


@query("mlx10_fitted_contributions")
def mlx10_fitted(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).explanations


@query("win10_fitted_rank")
def win10_fitted(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).coefficients.select("comparison_id", "feature_type", "feature_id", "coefficient", "importance_rank")


@query("mlx11_importance_table")
def mlx11(spark: SparkSession, d: str) -> DataFrame:
    found = fitted(spark, d)
    own = models.model_samples(B.members(spark, d))
    means = models.discovery_means(own, B.frame(spark, d, "positives"), found.coefficients.select("comparison_id", "feature_type", "feature_id"))
    return models.importance_table(found, means)


@query("mlx11_status_rows")
def mlx11_status(spark: SparkSession, d: str) -> DataFrame:
    return fitted(spark, d).models


@query("mlx11_status_counts", f"""
    WITH {_SAMPLES}
    SELECT comparison_id, count_if(partition = 'DISCOVERY' AND target = 1) AS discovery_target_count, count_if(partition = 'DISCOVERY' AND target = 0) AS discovery_background_count,
        count_if(partition = 'VALIDATION' AND target = 1) AS validation_target_count, count_if(partition = 'VALIDATION' AND target = 0) AS validation_background_count
    FROM samples GROUP BY 1""")
def mlx11_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts that stand in the status rows of the fitted models."""
    return fitted(spark, d).models.select("comparison_id", *[f"{p}_{c}_count" for p in ("discovery", "validation") for c in ("target", "background")])
