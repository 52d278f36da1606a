"""Queries of report operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import families, matching, reports
from cohortry.plans import bindings as B
from cohortry.plans.registry import query
from cohortry.storage import table


def r7(df: DataFrame, *columns: str) -> DataFrame:
    """The frame with the columns rounded to seven places."""
    return df.withColumns({c: F.round(c, 7) for c in columns})


# -- counts ------------------------------------------------------------------------------------------------------


@query("agg17_feature_type_counts", f"WITH {B.cte('features')} SELECT feature_type, count(*) AS memberships, count(DISTINCT feature_id) AS features, count(DISTINCT protein_id) AS proteins FROM features GROUP BY 1")
def agg17(spark: SparkSession, d: str) -> DataFrame:
    return reports.feature_type_counts(B.frame(spark, d, "features"))


_UP = "s.status = 'COMPLETE' AND s.discovery_prevalence_difference > 0 AND s.discovery_q_value <= 0.05"


@query("agg20_comparison_outcomes", f"""WITH {B.cte('report_comparisons', 'signatures')}, n AS (SELECT c.comparison_id, c.display_name, c.target_label_ids, coalesce(count_if({_UP} AND starts_with(s.evidence_class, 'DECISION_CANDIDATE__')), 0)::BIGINT AS enriched,
    coalesce(count_if({_UP} AND s.evidence_class IN ('DECISION_CANDIDATE__VALIDATED_STUDY_WIDE', 'DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON')), 0)::BIGINT AS validated_within, coalesce(count_if({_UP} AND s.evidence_class = 'DECISION_CANDIDATE__VALIDATED_STUDY_WIDE'), 0)::BIGINT AS validated_study,
    coalesce(count_if(s.status = 'COMPLETE'), 0)::BIGINT AS complete, coalesce(count_if(s.status = 'INSUFFICIENT_SAMPLE_SIZE'), 0)::BIGINT AS insufficient, coalesce(count_if(s.status = 'NO_SIGNIFICANT_SIGNATURE'), 0)::BIGINT AS no_signature
    FROM report_comparisons c LEFT JOIN signatures s USING (comparison_id) GROUP BY ALL)
    SELECT *, CASE WHEN enriched > 0 THEN 'DISCOVERY_ENRICHED' WHEN complete > 0 THEN 'COMPLETE_NO_POSITIVE_ENRICHMENT' WHEN insufficient > 0 THEN 'INSUFFICIENT_SAMPLE_SIZE' WHEN no_signature > 0 THEN 'NO_SIGNIFICANT_SIGNATURE' ELSE 'NO_PUBLISHED_SIGNATURE' END AS analysis_status FROM n""")
def agg20(spark: SparkSession, d: str) -> DataFrame:
    return reports.comparison_outcomes(B.frame(spark, d, "report_comparisons"), B.frame(spark, d, "signatures"))


@query("agg23_pure_block_class_counts", f"""
    WITH {B.cte('predictions')}, p AS (SELECT comparison_id, partition_key, min(true_class) AS c
    FROM predictions WHERE partition = 'VALIDATION' GROUP BY 1, 2
    HAVING count(DISTINCT true_class) = 1) SELECT comparison_id, count_if(c = 'TARGET') AS target_blocks, count_if(c = 'BACKGROUND') AS
    background_blocks FROM p GROUP BY 1""")
def agg23(spark: SparkSession, d: str) -> DataFrame:
    return reports.pure_block_counts(B.frame(spark, d, "predictions"))


_NATION_LABELS = """
    labels AS (SELECT 'N' || n_nationkey AS label_id, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'ROLE' || n_regionkey END AS
    component_role FROM nation), memberships AS (SELECT c_custkey AS protein_id, 'N' || c_nationkey AS label_id
    FROM customer WHERE c_nationkey % 5 <> 4)"""


def _nation_labels(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    nation, customer = table(spark, d, "nation"), table(spark, d, "customer")
    labels = nation.select(F.concat(F.lit("N"), "n_nationkey").alias("label_id"), F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.concat(F.lit("ROLE"), "n_regionkey")).alias("component_role"))
    return labels, customer.filter("c_nationkey % 5 <> 4").select(F.col("c_custkey").alias("protein_id"), F.concat(F.lit("N"), "c_nationkey").alias("label_id"))


@query("agg24_label_coverage", f"WITH {_NATION_LABELS} SELECT label_id, component_role, count(DISTINCT protein_id) AS observed_proteins FROM labels LEFT JOIN memberships USING (label_id) GROUP BY ALL")
def agg24(spark: SparkSession, d: str) -> DataFrame:
    return reports.label_coverage(*_nation_labels(spark, d))


@query("agg24_role_coverage", f"WITH {_NATION_LABELS} SELECT component_role, count(DISTINCT protein_id) AS proteins FROM memberships JOIN labels USING (label_id) WHERE component_role <> '' GROUP BY 1")
def agg24_role(spark: SparkSession, d: str) -> DataFrame:
    return reports.role_coverage(*_nation_labels(spark, d))


@query("agg25_structure_source_summary", f"""
    WITH {B.cte('structures')} SELECT structure_source, availability_status, analysis_eligibility_status, fold_evidence_status,
    count(*) AS models, round(avg(mean_confidence), 2) AS mean_confidence
    FROM structures GROUP BY ALL""")
def agg25(spark: SparkSession, d: str) -> DataFrame:
    return reports.structure_sources(B.frame(spark, d, "structures"))


@query("agg25_fold_counts", f"WITH {B.cte('structures')} SELECT fold_authority, fold_id, fold_name, count(DISTINCT protein_id) AS proteins FROM structures WHERE fold_id <> '' GROUP BY ALL")
def agg25_folds(spark: SparkSession, d: str) -> DataFrame:
    return reports.fold_counts(B.frame(spark, d, "structures"))


@query("agg28_assessment_coverage", f"""
    WITH {B.cte('feature_assessments')} SELECT feature_type, evidence_status, derivation_scope, count(DISTINCT feature_id) AS features,
    count(DISTINCT protein_id) AS proteins FROM feature_assessments
    GROUP BY ALL""")
def agg28(spark: SparkSession, d: str) -> DataFrame:
    return reports.assessment_coverage(B.frame(spark, d, "feature_assessments"))


@query("agg28_domain_coverage", f"""
    WITH {B.cte('domain_assessments')} SELECT domain_authority, count_if(assessment_status = 'ASSESSED_WITH_HIT') AS ASSESSED_WITH_HIT,
    count_if(assessment_status = 'ASSESSED_NO_HIT') AS ASSESSED_NO_HIT, count_if(assessment_status = 'NOT_ASSESSED') AS NOT_ASSESSED,
    count_if(assessment_status = 'FAILED') AS FAILED FROM domain_assessments
    GROUP BY 1""")
def agg28_domains(spark: SparkSession, d: str) -> DataFrame:
    return reports.domain_coverage(B.frame(spark, d, "domain_assessments"))


@query("agg28_curation_coverage", "SELECT o_orderstatus AS curation_status, count(DISTINCT o_custkey) AS proteins, count(*) AS assignments FROM orders GROUP BY 1")
def agg28_curation(spark: SparkSession, d: str) -> DataFrame:
    return reports.curation_coverage(table(spark, d, "orders").select(F.col("o_custkey").alias("protein_id"), F.col("o_orderstatus").alias("curation_status")))


@query("agg28_acquisition_coverage", f"WITH {B.cte('structures')} SELECT analysis_eligibility_status AS acquisition_status, count(*) AS proteins, round(avg(mean_confidence), 2) AS mean_confidence FROM structures GROUP BY 1")
def agg28_acquisitions(spark: SparkSession, d: str) -> DataFrame:
    return reports.acquisition_coverage(B.frame(spark, d, "structures").withColumnRenamed("analysis_eligibility_status", "acquisition_status"))


@query("agg30_orthology_metrics", f"""
    WITH {B.PARTS}, {B.cte('group_memberships')} SELECT (SELECT count(DISTINCT (run_id, group_type, hierarchy_node, group_id))
    FROM group_memberships) AS groups, (SELECT count(DISTINCT unit)
    FROM parts) AS blocks, (SELECT count(DISTINCT l_suppkey) FROM lineitem
    WHERE l_returnflag = 'R') AS near_redundancy_clusters""")
def agg30(spark: SparkSession, d: str) -> DataFrame:
    clusters = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cluster_id"), F.when(F.col("l_returnflag") == "R", "NEAR_REDUNDANCY").otherwise("EXACT").alias("cluster_type"))
    return reports.orthology_metrics(B.frame(spark, d, "group_memberships"), B.proteins_in_blocks(spark, d).withColumnRenamed("unit", "partition_key"), clusters)


@query("agg30_partition_units", f"WITH {B.PARTS} SELECT partition, label AS partition_unit, count(*) AS proteins, count(DISTINCT unit) AS blocks FROM parts GROUP BY ALL")
def agg30_units(spark: SparkSession, d: str) -> DataFrame:
    return reports.partition_units(B.proteins_in_blocks(spark, d).withColumnsRenamed({"unit": "partition_key", "label": "partition_unit"}))


@query("agg41_direct_label_counts", "SELECT 'B' || p_size AS label_id, count(*) AS proteins FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N' GROUP BY 1 ORDER BY proteins DESC, label_id LIMIT 40")
def agg41(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return reports.direct_label_counts(lines.select(F.concat(F.lit("B"), "p_size").alias("label_id"), F.when(F.col("l_returnflag") == "N", "INHERITED").otherwise("DIRECT").alias("membership_source")))


@query("agg41_histogram", f"WITH {B.cte('predictions')} SELECT CASE WHEN predicted_probability = 1 THEN 20 ELSE floor(predicted_probability * 20)::BIGINT + 1 END AS bin, count(*) AS n FROM predictions GROUP BY 1")
def agg41_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram(B.frame(spark, d, "predictions"), "predicted_probability", 0.0, 1.0, 20)


@query("agg42_reference_count_estimates", """SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS distinct_values, count(*) AS rows FROM orders UNION ALL SELECT 'o_orderpriority', count(DISTINCT nullif(o_orderpriority, '')), count(*) FROM orders UNION ALL SELECT 'o_orderstatus', count(DISTINCT nullif(o_orderstatus, '')), count(*) FROM orders""")
def agg42(spark: SparkSession, d: str) -> DataFrame:
    return reports.column_values(table(spark, d, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"])


# -- signatures --------------------------------------------------------------------------------------------------


_TIER_SQL = {
    "discovery": f"{_UP} AND starts_with(s.evidence_class, 'DECISION_CANDIDATE__')",
    "within_comparison": "s.status = 'COMPLETE' AND s.validation_prevalence_difference > 0 AND s.validation_q_value <= 0.05 AND s.evidence_class IN ('DECISION_CANDIDATE__VALIDATED_STUDY_WIDE', 'DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON')",
    "study_wide": "s.status = 'COMPLETE' AND s.validation_prevalence_difference > 0 AND s.validation_study_q_value <= 0.05 AND s.evidence_class = 'DECISION_CANDIDATE__VALIDATED_STUDY_WIDE'",
}


@query("prj09_evidence_tier_filter", f"WITH {B.cte('signatures')} " + " UNION ALL ".join(f"SELECT '{t}' AS tier, comparison_id, feature_type, feature_id FROM signatures s WHERE {w}" for t, w in _TIER_SQL.items()))
def prj09(spark: SparkSession, d: str) -> DataFrame:
    rows = B.frame(spark, d, "signatures")
    parts = [reports.tier_signatures(rows, t).select(F.lit(t).alias("tier"), "comparison_id", "feature_type", "feature_id") for t in reports.TIERS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("prj10_signature_plot_points", f"""
    WITH {B.cte('signatures')} SELECT comparison_id, feature_type, feature_id, discovery_q_value < 1e-300 AS q_clipped,
    round(-log10(greatest(discovery_q_value, 1e-300)), 7) AS negative_log10_q
    FROM signatures WHERE discovery_q_value BETWEEN 0 AND 1 AND discovery_prevalence_difference BETWEEN -1 AND 1""")
def prj10(spark: SparkSession, d: str) -> DataFrame:
    return r7(reports.plot_points(B.frame(spark, d, "signatures")).select("comparison_id", "feature_type", "feature_id", "q_clipped", "negative_log10_q"), "negative_log10_q")


@query("win05_ranked_signatures", f"""WITH {B.cte('signatures')}, r AS (SELECT s.*, row_number() OVER (PARTITION BY comparison_id ORDER BY discovery_q_value ASC NULLS LAST, discovery_prevalence_difference DESC, feature_type, feature_id) AS rank FROM signatures s WHERE comparison_id IN ('C0', 'C1', 'C3') AND {_TIER_SQL['discovery']})
    SELECT comparison_id, feature_type, feature_id, rank FROM r WHERE rank <= 25 ORDER BY rank, comparison_id LIMIT 60""")
def win05(spark: SparkSession, d: str) -> DataFrame:
    return reports.ranked_signatures(B.frame(spark, d, "signatures"), ["C0", "C1", "C3"], 25, 60).select("comparison_id", "feature_type", "feature_id", "rank")


@query("win12_top_signatures", f"""
    WITH {B.cte('signatures')} SELECT comparison_id, feature_type, feature_id
    FROM signatures ORDER BY validation_study_q_value NULLS LAST, validation_q_value NULLS LAST, discovery_q_value NULLS LAST,
    comparison_id, feature_type, feature_id LIMIT 100""")
def win12(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_signatures(B.frame(spark, d, "signatures")).select("comparison_id", "feature_type", "feature_id")


@query("win12_top_prevalence", f"""
    WITH {B.cte('signatures')} SELECT comparison_id, feature_type, feature_id, discovery_prevalence_difference
    FROM signatures WHERE status = 'COMPLETE' ORDER BY abs(discovery_prevalence_difference) DESC, comparison_id, feature_type,
    feature_id LIMIT 25""")
def win12_prevalence(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_prevalence(B.frame(spark, d, "signatures")).select("comparison_id", "feature_type", "feature_id", "discovery_prevalence_difference")


@query("win12_top_contributions", """
    SELECT p_type AS feature_type, p_brand AS feature_id, round(avg(abs(l_tax - l_discount)), 7) AS mean_absolute
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
    ORDER BY avg(abs(l_tax - l_discount)) DESC, 1, 2 LIMIT 30""")
def win12_contributions(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return r7(reports.top_contributions(lines.select(F.col("p_type").alias("feature_type"), F.col("p_brand").alias("feature_id"), (F.col("l_tax") - F.col("l_discount")).alias("log_odds_contribution"))), "mean_absolute")


@query("snk05_signature_evidence_view", f"WITH {B.cte('signatures', 'report_comparisons')} SELECT s.comparison_id, feature_type, feature_id, evidence_class, display_name FROM signatures s LEFT JOIN report_comparisons USING (comparison_id)")
def snk05(spark: SparkSession, d: str) -> DataFrame:
    return reports.signature_view(B.frame(spark, d, "signatures"), B.frame(spark, d, "report_comparisons")).select("comparison_id", "feature_type", "feature_id", "evidence_class", "display_name")


_RESIDUE_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in reports.RESIDUES.items()) + "}"


@query("prj12_feature_text", f"""WITH {B.cte('signatures')}, m AS (SELECT DISTINCT feature_type, feature_id, feature_name, CASE WHEN feature_type = 'AMINO_ACID_KMER' AND regexp_full_match(feature_id, 'k[0-9]+:[A-Z]+') AND length(split_part(feature_id, ':', 2))::VARCHAR = substr(split_part(feature_id, ':', 1), 2) THEN split_part(feature_id, ':', 2) END AS motif FROM signatures),
    t AS (SELECT *, array_to_string(list_transform(string_split(motif, ''), lambda r: coalesce(({_RESIDUE_SQL})[r], r)), '-') AS spelled FROM m)
    SELECT feature_type, feature_id, feature_name, CASE WHEN motif IS NOT NULL THEN 'The exact residues ' || motif || ' (' || spelled || ') somewhere in a protein.' WHEN feature_type = 'STRUCTURE_CLUSTER' THEN 'A cluster of whole models of similar structure.' ELSE 'A sequence domain: ' || feature_name || '.' END AS explanation,
        CASE WHEN motif IS NOT NULL THEN motif || ' ' || spelled WHEN feature_type = 'STRUCTURE_CLUSTER' THEN 'Model cluster ' || feature_id ELSE substr(feature_name || ' ' || feature_id, 1, 75) END AS label FROM t""")
def prj12(spark: SparkSession, d: str) -> DataFrame:
    return reports.feature_text(B.frame(spark, d, "signatures").select("feature_type", "feature_id", "feature_name").distinct())


# -- lookups -----------------------------------------------------------------------------------------------------


@query("prj07_filtered_feature_export", f"""
    WITH {B.cte('features')} SELECT protein_id, feature_type, feature_id, start, stop
    FROM features WHERE feature_type IN ('PFAM_DOMAIN') AND (contains(feature_id, '#1') OR contains(feature_name, '#1'))""")
def prj07(spark: SparkSession, d: str) -> DataFrame:
    return reports.filtered_features(B.frame(spark, d, "features"), types=["PFAM_DOMAIN"], text="#1", cap=2_000_000_000).select("protein_id", "feature_type", "feature_id", "start", "stop")


@query("prj08_bounded_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def prj08(spark: SparkSession, d: str) -> DataFrame:
    return reports.bounded_preview(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 50, 100)


@query("prj11_select_by_key", f"WITH {B.cte('domain_assessments')} SELECT * FROM domain_assessments WHERE protein_id = 7")
def prj11(spark: SparkSession, d: str) -> DataFrame:
    return reports.select_by_key(B.frame(spark, d, "domain_assessments"), "protein_id", 7, ["domain_authority"])


@query("jon19_seed_export", "SELECT o_orderkey AS protein_id, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey IN (3, 5))")
def jon19(spark: SparkSession, d: str) -> DataFrame:
    proteins = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), "o_totalprice")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.col("l_suppkey").alias("group_id"))
    return reports.seed_proteins(proteins, {"protein": (proteins, "protein_id"), "group": (lines, "group_id")}, "group", [3, 5], cap=2_000_000_000)


@query("jon20_enriched_intervals", f"""
    WITH {B.cte('features', 'signatures')} SELECT f.protein_id, f.feature_type, f.feature_id, f.start, f.stop,
    round(s.discovery_q_value, 7) AS q_value, round(s.discovery_prevalence_difference, 7) AS difference
    FROM features f JOIN signatures s USING (feature_type, feature_id)
    WHERE s.comparison_id = 'C1' AND (f.feature_type = 'AMINO_ACID_KMER' OR (f.start IS NOT NULL AND f.stop IS NOT NULL)) AND
    {_TIER_SQL['discovery']}""")
def jon20(spark: SparkSession, d: str) -> DataFrame:
    return r7(reports.enriched_intervals(B.frame(spark, d, "features"), B.frame(spark, d, "signatures"), "C1"), "q_value", "difference")


@query("jon21_model_proteins", f"""
    WITH {B.cte('structures', 'label_memberships')} SELECT protein_id, max(mean_confidence) AS model_confidence
    FROM structures WHERE coordinate_path <> '' AND protein_id IN (SELECT protein_id
    FROM label_memberships WHERE label_id IN ('MACHINERY', 'BUILDING'))
    GROUP BY 1 ORDER BY model_confidence DESC NULLS LAST, protein_id LIMIT 5000""")
def jon21(spark: SparkSession, d: str) -> DataFrame:
    return reports.model_proteins(B.frame(spark, d, "structures"), B.frame(spark, d, "label_memberships"), ["MACHINERY", "BUILDING"])


@query("win14_suggested_entities", f"""
    WITH {B.HITS}, {B.cte('structures')} SELECT protein_id, count(DISTINCT domain_id) AS labels, protein_id IN (SELECT protein_id
    FROM structures WHERE coordinate_path <> '') AS has_model FROM hits
    GROUP BY 1 ORDER BY has_model DESC, labels DESC, protein_id LIMIT 250""")
def win14(spark: SparkSession, d: str) -> DataFrame:
    modelled = B.frame(spark, d, "structures").filter("coordinate_path <> ''").select("protein_id", F.lit(True).alias("m")).distinct()
    counts = B.domain_hits(spark, d).groupBy("protein_id").agg(F.count_distinct("domain_id").alias("labels")).join(modelled, "protein_id", "left")
    return counts.select("protein_id", "labels", F.coalesce("m", F.lit(False)).alias("has_model")).orderBy(F.desc("has_model"), F.desc("labels"), "protein_id").limit(250)


_INTERVALS = f"""{B.cte('features', 'signatures')}, proteins AS (SELECT o_orderkey AS protein_id, 12 + o_orderkey % 30 AS length FROM orders),
    intervals AS (SELECT f.protein_id, f.start, f.stop, s.discovery_q_value AS q_value, s.discovery_prevalence_difference AS difference FROM features f JOIN signatures s USING (feature_type, feature_id) WHERE f.start IS NOT NULL AND s.comparison_id = 'C1' AND {_TIER_SQL['discovery']}),
    covered AS (SELECT protein_id, unnest(range(start, stop + 1)) AS position, q_value FROM intervals JOIN proteins USING (protein_id) WHERE q_value BETWEEN 0 AND 0.05 AND difference > 0 AND start >= 1 AND stop <= length),
    least_q AS (SELECT protein_id, position, min(q_value) AS q_value FROM covered GROUP BY 1, 2), every AS (SELECT protein_id, unnest(range(1, length + 1)) AS position FROM proteins)"""


@query("fea17_enrichment_track", f"""
    WITH {_INTERVALS} SELECT protein_id, position, round(q_value, 7) AS q_value, round(CASE WHEN q_value IS NULL THEN 0 ELSE 0.1 + 0.9
    * least(1, greatest(0, (-log10(greatest(q_value, 1e-8)) + log10(0.05)) / (8 + log10(0.05)))) END, 7) AS score
    FROM every LEFT JOIN least_q USING (protein_id, position)""")
def fea17(spark: SparkSession, d: str) -> DataFrame:
    proteins = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), (F.col("o_orderkey") % 30 + 12).alias("length"))
    intervals = reports.enriched_intervals(B.frame(spark, d, "features"), B.frame(spark, d, "signatures"), "C1").filter("start is not null")
    return r7(reports.enrichment_track(intervals, proteins), "q_value", "score")


# -- matched cohorts -----------------------------------------------------------------------------------------------

#: A control unit is the next unit, if all of it is background; so no control serves twice.
_AUDIT = f"""{B.PARTS}, {B.cte('comparisons')}, tu AS (SELECT unit, min(label) AS label, min(protein_id) AS protein_id FROM parts GROUP BY 1 HAVING min(label) = max(label) AND min(label) <> 'BUILDING'),
    cu AS (SELECT unit, min(protein_id) AS protein_id FROM parts GROUP BY 1 HAVING min(label) = 'BUILDING' AND max(label) = 'BUILDING'),
    audit AS (SELECT 'BUILDING' AS background_label_id, tu.label AS target_label_id, tu.protein_id AS target_protein_id, tu.unit AS target_unit_id, cu.protein_id AS control_protein_id, cu.unit AS control_unit_id, CASE WHEN cu.unit IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS status FROM tu LEFT JOIN cu ON cu.unit = tu.unit + 1)"""


def audit(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(audit, proteins in blocks)."""
    parts = B.proteins_in_blocks(spark, d)
    units = parts.groupBy("unit").agg(F.min("label").alias("label"), F.max("label").alias("_other"), F.min("protein_id").alias("protein_id")).filter("label = _other").drop("_other")
    controls = units.filter("label = 'BUILDING'").select((F.col("unit") - 1).alias("unit"), F.col("unit").alias("control_unit_id"), F.col("protein_id").alias("control_protein_id"))
    rows = units.filter("label <> 'BUILDING'").join(controls, "unit", "left")
    return rows.select(F.lit("BUILDING").alias("background_label_id"), F.col("label").alias("target_label_id"), F.col("protein_id").alias("target_protein_id"), F.col("unit").alias("target_unit_id"), "control_protein_id", "control_unit_id", F.when(F.col("control_unit_id").isNull(), "UNMATCHED").otherwise("MATCHED").alias("status")), parts


_COHORTS = f"""{_AUDIT}, links AS (SELECT c.comparison_id, a.target_unit_id, a.control_unit_id FROM audit a JOIN comparisons c ON c.background_label_ids = a.background_label_id WHERE a.status = 'MATCHED'),
    target AS (SELECT c.comparison_id, p.protein_id, p.unit FROM parts p JOIN comparisons c ON c.target_label_ids = p.label), kept AS (SELECT t.* FROM target t SEMI JOIN links l ON l.comparison_id = t.comparison_id AND l.target_unit_id = t.unit),
    used AS (SELECT DISTINCT l.comparison_id, l.control_unit_id AS unit FROM links l SEMI JOIN target t ON t.comparison_id = l.comparison_id AND t.unit = l.target_unit_id),
    cohorts AS (SELECT comparison_id, protein_id, unit, true AS is_target FROM kept UNION ALL SELECT u.comparison_id, p.protein_id, p.unit, false FROM parts p JOIN used u ON u.unit = p.unit WHERE p.label = 'BUILDING')"""


def _cohorts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows, parts = audit(spark, d)
    comparisons = B.frame(spark, d, "comparisons").select("comparison_id", F.col("target_label_ids").alias("target_label_id"), F.col("background_label_ids").alias("background_label_id"))
    labels, units = parts.select("protein_id", F.col("label").alias("label_id")), parts.select("protein_id", "unit")
    return matching.matched_cohorts(comparisons, labels, units, rows), comparisons, labels, units


@query("jon06_matched_cohorts", f"WITH {_COHORTS} SELECT * FROM cohorts")
def jon06(spark: SparkSession, d: str) -> DataFrame:
    return _cohorts(spark, d)[0]


@query("agg21_matched_control_pool_coverage", f"""
    WITH {_AUDIT} SELECT background_label_id, count(DISTINCT target_unit_id) AS target_units, count(DISTINCT CASE WHEN status =
    'MATCHED' THEN target_unit_id END) AS covered_target_units, count(DISTINCT CASE WHEN status = 'MATCHED' THEN control_unit_id END)
    AS matched_control_units, round(count(DISTINCT CASE WHEN status = 'MATCHED' THEN target_unit_id END) / count(DISTINCT
    target_unit_id), 7) AS target_coverage_fraction FROM audit GROUP BY 1""")
def agg21(spark: SparkSession, d: str) -> DataFrame:
    return r7(matching.pool_coverage(audit(spark, d)[0]), "target_coverage_fraction")


@query("agg22_matched_comparison_coverage", f"""WITH {_COHORTS}, w AS (SELECT comparison_id, count(DISTINCT unit) AS target_units, count(*) AS n FROM target GROUP BY 1),
    o AS (SELECT comparison_id, count(DISTINCT CASE WHEN is_target THEN unit END) AS matched_target_units, count_if(is_target) AS target_proteins, count(DISTINCT CASE WHEN NOT is_target THEN unit END) AS control_units, count_if(NOT is_target) AS control_proteins FROM cohorts GROUP BY 1)
    SELECT comparison_id, target_units, matched_target_units, target_units - matched_target_units AS unmatched_target_units, round(matched_target_units / target_units, 7) AS target_coverage_fraction, target_proteins, n - target_proteins AS unmatched_target_proteins, control_units, control_proteins FROM w JOIN o USING (comparison_id)""")
def agg22(spark: SparkSession, d: str) -> DataFrame:
    return r7(matching.cohort_coverage(*_cohorts(spark, d)), "target_coverage_fraction")


@query("agg07_control_coverage", f"""
    WITH {_AUDIT}, c AS (SELECT background_label_id, target_unit_id, count(*) AS requested, count_if(status = 'MATCHED') AS matched
    FROM audit GROUP BY ALL) SELECT *, CASE WHEN matched = 0 THEN 'UNMATCHED' WHEN matched = requested THEN 'FULL' ELSE 'PARTIAL' END
    AS coverage_status FROM c""")
def agg07(spark: SparkSession, d: str) -> DataFrame:
    return matching.target_coverage(audit(spark, d)[0])


@query("agg07_background_coverage", f"""
    WITH {_AUDIT} SELECT background_label_id, count(*) AS target_units, count_if(status = 'MATCHED')::BIGINT AS matched_controls,
    count_if(status = 'MATCHED') AS with_control, count(*) - count_if(status = 'MATCHED') AS without_control, round(count_if(status =
    'MATCHED') / count(*), 7) AS coverage_fraction FROM audit GROUP BY 1""")
def agg07_background(spark: SparkSession, d: str) -> DataFrame:
    return r7(matching.background_coverage(matching.target_coverage(audit(spark, d)[0])), "coverage_fraction")


# -- audited clusters ----------------------------------------------------------------------------------------------


@query("agg31_subcluster_audit_summary", f"""
    WITH {B.cte('audited')} SELECT subcluster_id, count(*) AS members, count_if(alignment_status NOT IN ('CENTROID_SELF',
    'EXACT_THRESHOLDS_PASS')) AS rescued_singletons, min(CASE WHEN alignment_status = 'EXACT_THRESHOLDS_PASS' THEN round(pident, 7)
    END) AS minimum_identity, min(CASE WHEN alignment_status = 'EXACT_THRESHOLDS_PASS' THEN representative_coverage END) AS
    minimum_representative_coverage, min(CASE WHEN alignment_status = 'EXACT_THRESHOLDS_PASS' THEN member_coverage END) AS
    minimum_member_coverage FROM audited GROUP BY 1""")
def agg31(spark: SparkSession, d: str) -> DataFrame:
    return r7(families.audit_summary(B.frame(spark, d, "audited")), "minimum_identity")


_SCOPES = f"{B.cte('audited')}, scopes AS (SELECT *, 'all' AS scope FROM audited UNION ALL SELECT *, 'selected' FROM audited WHERE subcluster_id = 'sub_7')"


@query("agg32_partition_compare", f"""
    WITH {_SCOPES} SELECT scope, count(*) AS proteins, count(DISTINCT subcluster_id) AS audited_groups, count(DISTINCT
    native_representative_id) AS native_groups, min(sequence_length) AS shortest, median(sequence_length) AS median_length,
    round(avg(sequence_length), 7) AS mean_length, max(sequence_length) AS longest, count_if(alignment_status NOT IN ('CENTROID_SELF',
    'EXACT_THRESHOLDS_PASS')) AS rescued_singletons FROM scopes GROUP BY 1""")
def agg32(spark: SparkSession, d: str) -> DataFrame:
    return r7(families.partition_compare(B.frame(spark, d, "audited"), "sub_7"), "mean_length")


@query("agg32_partition_evidence", f"""
    WITH {_SCOPES} SELECT scope, alignment_status, count(*) AS proteins, count(pident) AS measured, round(min(pident), 7) AS
    minimum_identity, round(median(pident), 7) AS median_identity, median(representative_coverage) AS median_representative_coverage,
    median(member_coverage) AS median_member_coverage, round(median(bitscore), 5) AS median_bitscore
    FROM scopes GROUP BY ALL""")
def agg32_evidence(spark: SparkSession, d: str) -> DataFrame:
    rows = families.partition_evidence(B.frame(spark, d, "audited"), "sub_7").withColumn("median_bitscore", F.round("median_bitscore", 5))
    return r7(rows, "minimum_identity", "median_identity")


_TAXA = "taxa AS (SELECT 'G' || l_suppkey AS \"group\", l_partkey % 400 AS taxon FROM lineitem WHERE l_suppkey IN (1, 2, 3)), sets AS (SELECT DISTINCT \"group\", taxon FROM taxa)"


def _taxa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.concat(F.lit("G"), "l_suppkey").alias("group"), (F.col("l_partkey") % 400).alias("taxon"))


@query("agg33_taxon_overlap", f"""WITH {_TAXA}, g AS (SELECT DISTINCT "group" AS g FROM sets), p AS (SELECT x.g AS group_a, y.g AS group_b FROM g x, g y)
    SELECT group_a, group_b, (SELECT count(*) FROM sets s WHERE s."group" = group_a AND s.taxon IN (SELECT taxon FROM sets z WHERE z."group" = group_b)) AS shared, (SELECT count(DISTINCT taxon) FROM sets s WHERE s."group" IN (group_a, group_b)) AS united,
        round((SELECT count(*) FROM sets s WHERE s."group" = group_a AND s.taxon IN (SELECT taxon FROM sets z WHERE z."group" = group_b)) / (SELECT count(DISTINCT taxon) FROM sets s WHERE s."group" IN (group_a, group_b)), 7) AS jaccard FROM p""")
def agg33(spark: SparkSession, d: str) -> DataFrame:
    return r7(families.taxon_overlap(_taxa(spark, d), ["G1", "G2", "G3"]), "jaccard")


@query("agg33_exclusive_regions", f"WITH {_TAXA}, m AS (SELECT taxon, string_agg(\"group\", ' + ' ORDER BY \"group\") AS groups FROM sets GROUP BY 1), n AS (SELECT unnest(['G1', 'G2', 'G3', 'G1 + G2', 'G1 + G3', 'G2 + G3', 'G1 + G2 + G3']) AS groups) SELECT n.groups, count(m.taxon) AS taxa FROM n LEFT JOIN m USING (groups) GROUP BY 1")
def agg33_regions(spark: SparkSession, d: str) -> DataFrame:
    return families.exclusive_regions(_taxa(spark, d), ["G1", "G2", "G3"])


_TAXONOMY = """
    rows AS (SELECT l_orderkey AS sequence_id, CASE WHEN l_partkey % 9 = 0 THEN 'x' ELSE (l_orderkey % 40)::VARCHAR END AS taxon_id,
    CASE WHEN l_partkey % 5 = 0 THEN 'species b' ELSE 'species a' END AS species
    FROM lineitem)"""


def _taxonomy(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    return lines.select(F.col("l_orderkey").alias("sequence_id"), F.when(F.col("l_partkey") % 9 == 0, "x").otherwise((F.col("l_orderkey") % 40).cast("string")).alias("taxon_id"), F.when(F.col("l_partkey") % 5 == 0, "species b").otherwise("species a").alias("species"))


@query("agg34_reviewed_taxonomy", f"""
    WITH {_TAXONOMY}, t AS (SELECT *, CASE WHEN regexp_full_match(taxon_id, '[1-9][0-9]*') THEN TRY_CAST(taxon_id AS BIGINT) END AS
    taxon FROM rows) SELECT sequence_id, CASE WHEN count(DISTINCT species) = 1 THEN min(species) END AS reviewed_species, min(taxon) AS
    reviewed_taxon_id FROM t GROUP BY 1 HAVING count(DISTINCT taxon) = 1 AND count(taxon) = count(*)""")
def agg34(spark: SparkSession, d: str) -> DataFrame:
    return families.reviewed_taxonomy(_taxonomy(spark, d))


@query("set06_taxon_filter", f"WITH {_TAXONOMY} SELECT sequence_id FROM rows GROUP BY 1 HAVING count(DISTINCT taxon_id) = 1 AND bool_and(taxon_id IN ('3', '5', '8'))")
def set06(spark: SparkSession, d: str) -> DataFrame:
    return families.one_taxon(_taxonomy(spark, d), ["3", "5", "8"])


_RETRIEVAL = """
    members AS (SELECT l_suppkey AS cluster_id, l_orderkey * 10 + l_linenumber AS sequence_id, l_partkey % 500 AS sequence_length
    FROM lineitem), taxonomy AS (SELECT o_orderkey * 10 + 1 AS sequence_id, 'S' || o_custkey % 5 AS reviewed_species, o_custkey % 5 AS
    reviewed_taxon_id FROM orders)"""


def _retrieval(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    members = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cluster_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sequence_id"), (F.col("l_partkey") % 500).alias("sequence_length"))
    taxonomy = table(spark, d, "orders").select((F.col("o_orderkey") * 10 + 1).alias("sequence_id"), F.concat(F.lit("S"), F.col("o_custkey") % 5).alias("reviewed_species"), (F.col("o_custkey") % 5).alias("reviewed_taxon_id"))
    return families.retrieval_summary(members, taxonomy)


@query("agg35_retrieval_summary", f"WITH {_RETRIEVAL} SELECT cluster_id, count(*) AS members, min(sequence_length) AS shortest, max(sequence_length) AS longest FROM members GROUP BY 1")
def agg35(spark: SparkSession, d: str) -> DataFrame:
    return _retrieval(spark, d)[0]


@query("agg35_species_counts", f"""
    WITH {_RETRIEVAL} SELECT cluster_id, coalesce(reviewed_species, 'Unclassified') AS species, reviewed_taxon_id AS taxon_id, count(*)
    AS sequences FROM members LEFT JOIN taxonomy USING (sequence_id)
    GROUP BY ALL""")
def agg35_species(spark: SparkSession, d: str) -> DataFrame:
    return _retrieval(spark, d)[1]


@query("win06_network_preview", f"""
    WITH {B.cte('audited')}, c AS (SELECT *, CASE WHEN alignment_status = 'CENTROID_SELF' THEN sequence_id ELSE -1 END AS
    audited_representative_id FROM audited WHERE subcluster_id IN ('sub_3', 'sub_4', 'sub_9')), r AS (SELECT *, count(*) OVER
    (PARTITION BY subcluster_id) AS cluster_size, row_number() OVER (PARTITION BY subcluster_id
    ORDER BY (sequence_id = audited_representative_id) DESC, sequence_id, bitscore) AS k
    FROM c) SELECT subcluster_id, sequence_id, cluster_size, CASE WHEN cluster_size = 1 THEN 'Singleton' WHEN sequence_id =
    audited_representative_id THEN 'Centroid' ELSE 'Member' END AS role
    FROM r WHERE k <= 120""")
def win06(spark: SparkSession, d: str) -> DataFrame:
    rows = B.frame(spark, d, "audited").withColumn("audited_representative_id", F.when(F.col("alignment_status") == "CENTROID_SELF", F.col("sequence_id")).otherwise(-1))
    return families.network_nodes(rows, ["sub_3", "sub_4", "sub_9"]).select("subcluster_id", "sequence_id", "cluster_size", "role")
