"""Queries of universes, evidence labels, matched controls and frozen signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import blocks, frozen, labels, matching, universes
from cohortry.plans import bindings as B
from cohortry.plans.registry import query
from cohortry.plans.reports import r7
from cohortry.storage import materialize, table


# -- universes ---------------------------------------------------------------------------------------------------

_EXPLICIT = """
    given AS (SELECT DISTINCT 'DOMAIN' AS feature_type, l_returnflag || ':' || p_brand AS feature_id, l_orderkey + CASE WHEN l_partkey
    % 50 = 0 THEN 1000000000 ELSE 0 END AS protein_id FROM lineitem
    JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 2 AND l_partkey % 7 <> 0)"""


@query("val11_universe_check", f"""
    WITH {B.cte('positives')}, {_EXPLICIT} SELECT DISTINCT feature_type, feature_id, protein_id, 'POSITIVE_NOT_ASSESSED' AS problem
    FROM positives p WHERE (feature_type, feature_id) IN (SELECT (feature_type, feature_id)
    FROM given) AND NOT EXISTS (SELECT 1 FROM given g WHERE g.feature_type = p.feature_type AND g.feature_id = p.feature_id AND
    g.protein_id = p.protein_id) UNION ALL SELECT feature_type, feature_id, protein_id, 'UNKNOWN_PROTEIN'
    FROM given WHERE protein_id NOT IN (SELECT o_orderkey FROM orders)""")
def val11(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).filter("l_linenumber <= 2 and l_partkey % 7 <> 0")
    given = lines.select(F.lit("DOMAIN").alias("feature_type"), F.concat_ws(":", "l_returnflag", "p_brand").alias("feature_id"), (F.col("l_orderkey") + F.when(F.col("l_partkey") % 50 == 0, 1_000_000_000).otherwise(0)).alias("protein_id"))
    return universes.universe_violations(given, B.frame(spark, d, "positives"), table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id")))


@query("val10_inference_scope_check", f"""
    WITH {B.cte('feature_assessments')}, f AS (SELECT DISTINCT feature_type, feature_id, derivation_scope
    FROM feature_assessments), x AS (SELECT DISTINCT 'EXTERNAL' AS feature_type, 'Brand#' || p_size AS feature_id
    FROM part WHERE p_size % 4 = 3) SELECT feature_type, feature_id, 'UNKNOWN_EXPLORATORY_FEATURE' AS problem
    FROM x WHERE (feature_type, feature_id) NOT IN (SELECT (feature_type, feature_id)
    FROM f) UNION ALL SELECT feature_type, feature_id, 'SUPERVISED_DEFINITION'
    FROM f WHERE derivation_scope = 'DISCOVERY_SUPERVISED' UNION ALL SELECT feature_type, feature_id, 'UNDECLARED_ALL_DATA_DEFINITION'
    FROM f WHERE derivation_scope = 'ALL_DATA_EXPLORATORY' AND (feature_type, feature_id) NOT IN (SELECT (feature_type, feature_id)
    FROM x)""")
def val10(spark: SparkSession, d: str) -> DataFrame:
    declared = table(spark, d, "part").filter("p_size % 4 = 3").select(F.lit("EXTERNAL").alias("feature_type"), F.concat(F.lit("Brand#"), "p_size").alias("feature_id"))
    return universes.scope_violations(B.frame(spark, d, "feature_assessments"), declared)


@query("jon05_imported_feature_split", f"""
    WITH {B.cte('feature_assessments')} SELECT 'POSITIVE' AS part, feature_type, feature_id, count(DISTINCT protein_id) AS proteins
    FROM feature_assessments WHERE derivation_scope IN ('FIXED_EXTERNAL', 'DISCOVERY_DERIVED') AND evidence_status =
    'ASSESSED_WITH_FEATURE' GROUP BY ALL UNION ALL SELECT 'ASSESSED', feature_type, feature_id, count(DISTINCT protein_id)
    FROM feature_assessments WHERE derivation_scope IN ('FIXED_EXTERNAL', 'DISCOVERY_DERIVED') AND evidence_status IN
    ('ASSESSED_WITH_FEATURE', 'ASSESSED_NO_FEATURE') GROUP BY ALL
    UNION ALL SELECT DISTINCT 'EXPLORATORY', feature_type, feature_id, 0
    FROM feature_assessments WHERE derivation_scope IN ('DISCOVERY_SUPERVISED', 'ALL_DATA_EXPLORATORY')""")
def jon05(spark: SparkSession, d: str) -> DataFrame:
    positives, assessed, exploratory = universes.split_imported(materialize(B.frame(spark, d, "feature_assessments"), "ledger"))
    key = ["feature_type", "feature_id"]
    counted = lambda df, name: df.groupBy(*key).agg(F.count("*").alias("proteins")).select(F.lit(name).alias("part"), *key, "proteins")
    return counted(positives, "POSITIVE").unionByName(counted(assessed, "ASSESSED")).unionByName(exploratory.select(F.lit("EXPLORATORY").alias("part"), *key, F.lit(0).cast("long").alias("proteins")))


@query("prj01_structure_eligibility", f"WITH {B.cte('structures')} SELECT structure_id, analysis_eligibility_status = 'ELIGIBLE' AND coordinate_path <> '' AND availability_status IN ('AVAILABLE', 'COMPLETE') AS eligible FROM structures")
def prj01(spark: SparkSession, d: str) -> DataFrame:
    return universes.coordinate_eligible(B.frame(spark, d, "structures")).select("structure_id", "eligible")


@query("prj02_eligible_positive", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'REVIEWED_POSITIVE' WHEN 'O' THEN 'EVIDENCE_SUPPORTED_POSITIVE' ELSE 'PROPOSED'
    END IN ('REVIEWED_POSITIVE', 'EVIDENCE_SUPPORTED_POSITIVE') AS eligible
    FROM orders""")
def prj02(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "REVIEWED_POSITIVE").when(F.col("o_orderstatus") == "O", "EVIDENCE_SUPPORTED_POSITIVE").otherwise("PROPOSED")
    return table(spark, d, "orders").select("o_orderkey", labels.eligible_positive(status).alias("eligible"))


@query("prj05_structural_policy_counts", f"""
    WITH {B.cte('structures', 'structure_comparisons')}, s AS (SELECT count_if(analysis_eligibility_status = 'ELIGIBLE' AND
    coordinate_path <> '') AS eligible_models, count_if(fold_id <> '' AND fold_evidence_status = 'ASSESSED_WITH_HIT' AND
    analysis_eligibility_status IN ('ELIGIBLE', 'NOT_APPLICABLE_EXTERNAL_EVIDENCE')) AS eligible_folds
    FROM structures), c AS (SELECT count_if(comparison_status = 'COMPLETE') AS complete_comparisons
    FROM structure_comparisons) SELECT *, eligible_folds + complete_comparisons AS evidence_items, CASE WHEN eligible_folds +
    complete_comparisons > 0 THEN 'COMPLETE' ELSE 'MISSING' END AS status
    FROM s, c""")
def prj05(spark: SparkSession, d: str) -> DataFrame:
    return universes.structural_policy(B.frame(spark, d, "structures"), B.frame(spark, d, "structure_comparisons"))


@query("prj06_evidence_availability", f"""
    WITH {B.cte('domain_assessments')} SELECT domain_authority, CASE WHEN NOT bool_or(assessment_status IN ('ASSESSED_WITH_HIT',
    'ASSESSED_NO_HIT')) THEN 'NOT_ASSESSED' WHEN bool_and(assessment_status IN ('ASSESSED_WITH_HIT', 'ASSESSED_NO_HIT')) THEN
    'COMPLETE' ELSE 'PARTIAL' END AS availability FROM domain_assessments
    GROUP BY 1""")
def prj06(spark: SparkSession, d: str) -> DataFrame:
    return universes.evidence_availability(B.frame(spark, d, "domain_assessments"))


@query("fea05_fold_and_availability_features", f"""
    WITH {B.cte('structures')} SELECT DISTINCT protein_id, 'STRUCTURE_AVAILABLE' AS feature_type, structure_source AS feature_id,
    'Structure available from ' || structure_source AS feature_name
    FROM structures WHERE analysis_eligibility_status = 'ELIGIBLE' AND coordinate_path <> ''
    UNION ALL SELECT DISTINCT protein_id, 'FOLD', fold_authority || ':' || fold_id, fold_authority || ' ' || fold_name
    FROM structures WHERE analysis_eligibility_status = 'ELIGIBLE' AND fold_evidence_status = 'ASSESSED_WITH_HIT'""")
def fea05(spark: SparkSession, d: str) -> DataFrame:
    return universes.structure_features(B.frame(spark, d, "structures"))


@query("jon04_structure_universes", f"""WITH {B.cte('structures')}, c AS (SELECT DISTINCT 'SC_' || o_custkey % 9 AS cluster_id, CASE WHEN o_orderkey % 3 = 1 THEN 'F' ELSE 'Z' END AS universe FROM orders WHERE o_orderkey % 3 < 2 AND o_orderkey % 7 <> 0 AND o_custkey % 9 = 5 * (o_orderkey % 3)),
    f AS (SELECT * FROM structures WHERE analysis_eligibility_status = 'ELIGIBLE')
    SELECT DISTINCT 'STRUCTURE_AVAILABLE' AS feature_type, structure_source AS feature_id, protein_id FROM structures
    UNION SELECT 'FOLD', h.fold_authority || ':' || h.fold_id, t.protein_id FROM (SELECT DISTINCT fold_authority, fold_id FROM f WHERE fold_evidence_status = 'ASSESSED_WITH_HIT') h JOIN (SELECT DISTINCT fold_authority, protein_id FROM f WHERE fold_evidence_status IN ('ASSESSED_WITH_HIT', 'ASSESSED_NO_HIT')) t USING (fold_authority)
    UNION SELECT 'STRUCTURE_CLUSTER', c.cluster_id, s.protein_id FROM c JOIN structures s ON s.comparison_universe_id = c.universe""")
def jon04(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").filter("o_orderkey % 3 < 2 and o_orderkey % 7 <> 0 and o_custkey % 9 = 5 * (o_orderkey % 3)")
    clusters = orders.select(F.concat(F.lit("SC_"), F.col("o_custkey") % 9).alias("cluster_id"), F.col("o_orderkey").alias("protein_id"), F.when(F.col("o_orderkey") % 3 == 1, "F").otherwise("Z").alias("comparison_universe_id"))
    return universes.structure_universes(B.frame(spark, d, "structures"), clusters)


# -- labels ------------------------------------------------------------------------------------------------------

#: The rules of the stand-in: words of part names speak for a label, brands are domains.
RULES = (
    labels.Rule("ring", "L_RING", "E", 2, annotation=("ring",), specific=("red ring",), exclusion=("^old",), required=("Brand#1[0-9]",), supporting=("PROMO",), specific_alone=True, propagate=True),
    labels.Rule("metal", "L_METAL", "M", 1, annotation=("plate|rod",), specific=("hot rod",), supporting=("Brand#2[0-9]", "SMALL")),
    labels.Rule("plain", "L_ROOT", "", 0, annotation=("gear|widget",), specific=("blue gear",)),
)
TREE = (("L_ROOT", None), ("L_METAL", "L_ROOT"), ("L_RING", "L_METAL"))
_TREE = """
    anc AS (SELECT * FROM (VALUES ('L_RING', 'L_METAL'), ('L_RING', 'L_ROOT'), ('L_METAL', 'L_ROOT')) v(label_id, ancestor_id)), dep AS
    (SELECT * FROM (VALUES ('L_RING', 2), ('L_METAL', 1), ('L_ROOT', 0)) v(label_id, depth)), up AS (SELECT *
    FROM anc UNION ALL SELECT label_id, label_id FROM dep)"""
_TEXTS = """texts AS (SELECT l_orderkey AS protein_id, p_name AS text, l_returnflag AS evidence_group, CASE l_linestatus WHEN 'F' THEN 1e0 ELSE 5e-1 END AS reliability, l_linenumber = 1 AS trusted FROM lineitem JOIN part ON l_partkey = p_partkey),
    domains AS (SELECT DISTINCT l_orderkey AS protein_id, p_brand AS domain_id, p_type AS domain_name FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _match_sql(column: str, patterns: tuple[str, ...]) -> str:
    return " OR ".join(f"regexp_matches({column}, '{p}')" for p in patterns) or "false"


_BEST = f"""{_TEXTS}, m AS ({" UNION ALL ".join(f"SELECT protein_id, evidence_group, text, '{r.rule_id}' AS rule_id, {_match_sql('text', r.specific)} AS spec, trusted, reliability FROM texts WHERE NOT ({_match_sql('text', r.exclusion)}) AND ({_match_sql('text', r.specific)} OR {_match_sql('text', r.annotation)})" for r in RULES)}),
    sc AS (SELECT *, CASE WHEN spec THEN 'SPECIFIC_ANNOTATION' ELSE 'ANNOTATION' END AS kind, CASE WHEN spec THEN 3e0 ELSE 2e0 END * reliability AS score FROM m),
    best AS (SELECT protein_id, rule_id, evidence_group, kind, text AS value, score, trusted_specific FROM (SELECT *, row_number() OVER (PARTITION BY protein_id, rule_id, evidence_group ORDER BY score DESC, text, kind) AS k, bool_or(spec AND trusted) OVER (PARTITION BY protein_id, rule_id, evidence_group) AS trusted_specific FROM sc) WHERE k = 1)"""
_DOMAIN_PARTS = [(r.rule_id, kind, k, p) for r in RULES for kind, ps in (("REQUIRED_DOMAIN", r.required), ("SUPPORTING_DOMAIN", r.supporting)) for k, p in enumerate(ps)]
_SCORED = f"""{_BEST}, dm AS ({" UNION ALL ".join(f"SELECT protein_id, '{r}' AS rule_id, '{kind}' AS kind, {k} AS at, min(domain_id) AS domain_id FROM domains WHERE regexp_matches(domain_id || ' ' || domain_name, '{p}') GROUP BY 1" for r, kind, k, p in _DOMAIN_PARTS)}),
    ds AS (SELECT protein_id, rule_id, CASE WHEN bool_or(kind = 'REQUIRED_DOMAIN') THEN 2e0 ELSE 0e0 END + CASE WHEN bool_or(kind = 'SUPPORTING_DOMAIN') THEN 1e0 ELSE 0e0 END AS domain_score, count_if(kind = 'REQUIRED_DOMAIN') AS required_found FROM dm GROUP BY 1, 2),
    ts AS (SELECT protein_id, rule_id, sum(score) AS text_score, list(evidence_group) FILTER (score > 0) AS text_groups, count(*) AS texts, bool_or(trusted_specific) AS trusted FROM best GROUP BY 1, 2),
    ru AS (SELECT * FROM (VALUES {", ".join(f"('{r.rule_id}', '{r.label_id}', '{r.component_role}', {r.priority}, {len(r.required)}, {str(r.specific_alone).lower()})" for r in RULES)}) v(rule_id, label_id, component_role, priority, required, alone)),
    j AS (SELECT protein_id, rule_id, coalesce(text_score, 0) + coalesce(domain_score, 0) AS score, coalesce(texts, 0) AS texts, coalesce(trusted, false) AS trusted, coalesce(required_found, 0) AS required_found, list_sort(list_concat(coalesce(text_groups, []), CASE WHEN coalesce(domain_score, 0) > 0 THEN ['PFAM'] ELSE [] END)) AS g FROM ts FULL JOIN ds USING (protein_id, rule_id)),
    k AS (SELECT j.*, ru.*, o_orderstatus <> 'P' AS ok FROM j JOIN ru ON ru.rule_id = j.rule_id JOIN orders ON o_orderkey = protein_id),
    e AS (SELECT protein_id, label_id, k.rule_id, component_role, priority, score, array_to_string(g, '|') AS evidence_groups, len(g) >= 2 AS several, alone AND trusted AND score >= 4 AS single, texts, required_found = required AS complete, ok FROM k),
    scored AS (SELECT *, (((texts > 0) AND complete AND score >= 4 AND several) OR single) AND ok AS accepted FROM e)"""


def evidence(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, domains, structures) of the stand-in."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = materialize(lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "p_name", "p_brand", "p_type"), "lines")
    texts = lines.select(F.col("l_orderkey").alias("protein_id"), F.col("p_name").alias("text"), F.col("l_returnflag").alias("evidence_group"), F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.5).alias("reliability"), (F.col("l_linenumber") == 1).alias("trusted"))
    domains = lines.select(F.col("l_orderkey").alias("protein_id"), F.col("p_brand").alias("domain_id"), F.col("p_type").alias("domain_name"))
    return texts, domains, table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), (F.col("o_orderstatus") != "P").alias("structure_eligible"))


@query("win08_best_evidence_per_group", f"WITH {_BEST} SELECT protein_id, rule_id, evidence_group, kind, value, score, trusted_specific FROM best")
def win08(spark: SparkSession, d: str) -> DataFrame:
    return labels.best_texts(evidence(spark, d)[0], RULES)


@query("fea07_rule_scoring", f"""
    WITH {_SCORED} SELECT protein_id, label_id, rule_id, component_role, score, evidence_groups, accepted, CASE WHEN accepted AND
    several THEN 'HIGH' WHEN accepted AND single THEN 'DIRECT_CURATED' ELSE 'PROPOSED' END AS confidence_tier
    FROM scored""")
def fea07(spark: SparkSession, d: str) -> DataFrame:
    found = labels.score_rules(*evidence(spark, d), RULES)
    return found.select("protein_id", "label_id", "rule_id", "component_role", "score", F.array_join("evidence_groups", "|").alias("evidence_groups"), "accepted", "confidence_tier")


@query("fea08_text_evidence_assembly", """WITH t AS (SELECT c_custkey AS protein_id, concat_ws(' | ', CASE WHEN c_custkey % 4 > 0 THEN 'family ' || c_nationkey END, c_mktsegment) AS text, 'UPSTREAM_CONTEXT' AS evidence_group, 'review context' AS evidence_source, 1e0 AS reliability, false AS trusted FROM customer
    UNION ALL SELECT o_orderkey, o_orderpriority, 'CURATED_SEED_CATALOGUE', 'catalogue', 1e0, o_orderstatus = 'F' AND o_custkey % 2 = 0 FROM orders UNION ALL SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'near ' || o_custkey ELSE '' END, 'UPSTREAM_CONTEXT', 'catalogue', 5e-1, false FROM orders
    UNION ALL SELECT l_orderkey, CASE WHEN l_quantity > 25 THEN 'line ' || l_partkey ELSE ' ' END, 'EXTERNAL_' || substr(sha256('tool ' || l_returnflag), 1, 16), 'tool ' || l_returnflag, 1e0, l_linestatus = 'F' FROM lineitem) SELECT * FROM t WHERE trim(text) <> ''""")
def fea08(spark: SparkSession, d: str) -> DataFrame:
    customer, orders, lines = (table(spark, d, n) for n in ("customer", "orders", "lineitem"))
    context = customer.select(F.col("c_custkey").alias("protein_id"), F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("family "), "c_nationkey")).otherwise("").alias("families"), F.lit(" ").alias("roles"), F.col("c_mktsegment").alias("details"))
    catalogue = orders.select(F.col("o_orderkey").alias("protein_id"), F.col("o_orderpriority").alias("category"), F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("near "), "o_custkey")).otherwise("").alias("associated"), F.when(F.col("o_custkey") % 2 == 0, " Direct").otherwise("cluster").alias("scope"), F.lit("catalogue").alias("source"), F.when(F.col("o_orderstatus") == "F", "Reviewed").otherwise("open").alias("review_status"))
    annotations = lines.select(F.col("l_orderkey").alias("protein_id"), F.when(F.col("l_quantity") > 25, F.concat(F.lit("line "), "l_partkey")).otherwise(" ").alias("text"), F.concat(F.lit("tool "), "l_returnflag").alias("source"), F.when(F.col("l_linestatus") == "F", "reviewed").otherwise("automatic").alias("status"), F.lit("EXACT_PROTEIN").alias("scope"))
    return labels.text_evidence(context, catalogue, annotations)


_TRUST = """
    SELECT o_orderkey AS protein_id, 'L_METAL' AS label_id, 'metal' AS rule_id, 1 AS priority, 10e0 AS score, o_orderstatus <> 'P' AS
    accepted, true AS trusted_direct FROM orders WHERE o_orderkey % 10 = 0"""
_RESOLVED = f"""{_SCORED}, {_TREE}, cand AS (SELECT protein_id, label_id, rule_id, priority, score, accepted, false AS trusted_direct FROM scored UNION ALL {_TRUST}),
    pool AS (SELECT * FROM (SELECT *, bool_or(trusted_direct) OVER (PARTITION BY protein_id) AS anyt FROM cand WHERE accepted) WHERE NOT anyt OR trusted_direct),
    apart AS (SELECT p.* FROM pool p WHERE NOT EXISTS (SELECT 1 FROM pool q JOIN anc ON anc.label_id = q.label_id WHERE q.protein_id = p.protein_id AND anc.ancestor_id = p.label_id)),
    led AS (SELECT *, row_number() OVER (PARTITION BY protein_id ORDER BY score DESC, priority DESC, label_id, rule_id) AS k, lead(score) OVER (PARTITION BY protein_id ORDER BY score DESC, priority DESC, label_id, rule_id) AS nxt, count(*) OVER (PARTITION BY protein_id) AS n FROM apart),
    chosen AS (SELECT protein_id, label_id AS sel_label, rule_id AS sel_rule, score AS sel_score FROM led WHERE k = 1 AND (n = 1 OR (NOT anyt AND score - nxt >= 1))),
    resolved AS (SELECT protein_id, CASE WHEN NOT bool_or(accepted) THEN 'PROPOSED' WHEN any_value(sel_label) IS NOT NULL THEN 'ACCEPTED' ELSE 'AMBIGUOUS' END AS status, any_value(sel_label) AS label_id, any_value(sel_rule) AS rule_id, any_value(sel_score) AS score FROM cand LEFT JOIN chosen USING (protein_id) GROUP BY 1)"""


def _labels(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(labels, closure) of the small tree that the rules know."""
    tree = spark.createDataFrame([(a, b, True, "") for a, b in TREE], "label_id string, parent_label_id string, reviewed_positive_allowed boolean, component_role string")
    return tree, materialize(blocks.label_closure(tree), "closure")


def resolved(spark: SparkSession, d: str, found: DataFrame | None = None, known: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(resolutions, decisions, closure). ``found``: the domains of the rules, and ``known``: what ``evidence`` gives, where a query has them."""
    tree, closure = _labels(spark)
    texts, domains, structures = known or evidence(spark, d)
    direct = table(spark, d, "orders").filter("o_orderkey % 10 = 0").select(F.col("o_orderkey").alias("protein_id"), F.lit("L_METAL").alias("label_id"))
    every = labels.score_rules(texts, domains, structures, RULES, found=found).unionByName(labels.trusted_candidates(direct, tree, structures, RULES))
    # which groups speak for a candidate is not asked; how many do is in its state
    return *labels.resolve_candidates(materialize(every.drop("evidence_groups"), "candidates"), closure), closure


@query("win09_candidate_resolution", f"""WITH {_RESOLVED} SELECT c.protein_id, c.label_id, c.rule_id, c.score, CASE WHEN NOT c.accepted THEN 'BELOW_ACCEPTANCE_POLICY' WHEN sel_label IS NULL THEN 'AMBIGUOUS_CONFLICT' WHEN c.label_id = sel_label AND c.rule_id = sel_rule THEN 'ACCEPTED'
    WHEN (sel_label, c.label_id) IN (SELECT (label_id, ancestor_id) FROM anc) THEN 'SUPERSEDED_BY_DESCENDANT' ELSE 'LOWER_PRIORITY' END AS decision, row_number() OVER (PARTITION BY c.protein_id ORDER BY accepted DESC, trusted_direct DESC, c.score DESC, depth DESC, priority DESC, c.label_id, c.rule_id) AS rank FROM cand c JOIN dep USING (label_id) LEFT JOIN chosen ON chosen.protein_id = c.protein_id""")
def win09(spark: SparkSession, d: str) -> DataFrame:
    return resolved(spark, d)[1].select("protein_id", "label_id", "rule_id", "score", "decision", "rank")


@query("fea10_candidate_audit", f"WITH {_RESOLVED} SELECT protein_id, status, label_id, rule_id, score FROM resolved")
def fea10_audit(spark: SparkSession, d: str) -> DataFrame:
    return resolved(spark, d)[0].select("protein_id", "status", "label_id", "rule_id", "score")


@query("fea10_label_definitions", f"""
    WITH {_RESOLVED} SELECT DISTINCT up.ancestor_id AS label_id, 'DOMAIN' AS feature_type, dm.domain_id AS feature_id, r.rule_id
    FROM resolved r JOIN dm ON dm.protein_id = r.protein_id AND dm.rule_id = r.rule_id
    JOIN up ON up.label_id = r.label_id WHERE r.status = 'ACCEPTED'""")
def fea10(spark: SparkSession, d: str) -> DataFrame:
    known = evidence(spark, d)
    domains = materialize(labels.domain_evidence(known[1], RULES), "domains")
    found, _, closure = resolved(spark, d, domains, known)
    return labels.label_definitions(found.filter("status = 'ACCEPTED'"), domains, closure)


_CONTROLS = "controls AS (SELECT o_orderkey AS protein_id, 'CONTROL' AS label_id FROM orders WHERE o_orderkey % 13 = 0 UNION SELECT o_orderkey, 'CONTROL2' FROM orders WHERE o_orderkey % 39 = 0)"


def _controls(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"))
    return orders.filter("protein_id % 13 = 0").withColumn("label_id", F.lit("CONTROL")).unionByName(orders.filter("protein_id % 39 = 0").withColumn("label_id", F.lit("CONTROL2")))


@query("fea09_label_rows", f"""WITH {_RESOLVED}, {_CONTROLS}, sel AS (SELECT * FROM resolved WHERE status = 'ACCEPTED') SELECT protein_id, label_id, 'EVIDENCE_SUPPORTED_POSITIVE' AS curation_status, 'AUTOMATED_TARGET_EVIDENCE' AS evidence_status FROM sel
    UNION ALL SELECT protein_id, label_id, 'EVIDENCE_SUPPORTED_POSITIVE', 'AUTOMATED_MATCHED_CONTROL' FROM controls WHERE protein_id NOT IN (SELECT protein_id FROM sel)
    UNION ALL SELECT o_orderkey, 'L_ROOT', coalesce(status, 'UNMAPPED'), CASE coalesce(status, '') WHEN 'AMBIGUOUS' THEN 'AUTOMATED_EVIDENCE_CONFLICT' WHEN 'PROPOSED' THEN 'AUTOMATED_EVIDENCE_BELOW_POLICY' ELSE 'AUTOMATED_EVIDENCE_NOT_MAPPED' END FROM orders LEFT JOIN resolved ON protein_id = o_orderkey
        WHERE o_orderkey NOT IN (SELECT protein_id FROM sel) AND o_orderkey NOT IN (SELECT protein_id FROM controls)""")
def fea09(spark: SparkSession, d: str) -> DataFrame:
    found = materialize(resolved(spark, d)[0], "resolved")
    proteins = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"))
    return labels.label_rows(proteins, found.filter("status = 'ACCEPTED'"), _controls(spark, d), found, "L_ROOT")


@query("agg08_class_summary", f"""WITH {_RESOLVED}, {_CONTROLS}, u AS (SELECT o_orderkey AS protein_id, o_custkey AS unit FROM orders), held AS (SELECT label_id, count(*) AS n, count(DISTINCT unit) AS m FROM controls JOIN u USING (protein_id) GROUP BY 1),
    own AS (SELECT label_id, count(*) AS proteins, count(DISTINCT unit) AS units FROM resolved JOIN u USING (protein_id) WHERE status = 'ACCEPTED' GROUP BY 1)
    SELECT own.label_id, 'TARGET' AS label_type, proteins, units, 'CONTROL' AS background_label_id, n AS control_proteins, m AS control_units FROM own LEFT JOIN held ON held.label_id = 'CONTROL' UNION ALL SELECT label_id, 'BACKGROUND', n, m, '', 0, 0 FROM held""")
def agg08(spark: SparkSession, d: str) -> DataFrame:
    found = materialize(resolved(spark, d)[0].filter("status = 'ACCEPTED'"), "selected")
    units = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), F.col("o_custkey").alias("unit"))
    backgrounds = spark.createDataFrame([(a, "CONTROL") for a, _ in TREE], "label_id string, background_label_id string")
    return labels.class_summary(found, units, _controls(spark, d), backgrounds)


_CONSENSUS = f"""{_RESOLVED}, g AS (SELECT o_custkey AS group_id, o_orderkey AS protein_id FROM orders), an AS (SELECT g.group_id, r.label_id FROM g JOIN resolved r USING (protein_id) WHERE status = 'ACCEPTED'),
    n AS (SELECT group_id, count(*) AS anchors FROM an GROUP BY 1 HAVING count(*) >= 2), com AS (SELECT an.group_id, up.ancestor_id AS label_id, count(*) AS k FROM an JOIN up USING (label_id) GROUP BY ALL),
    consensus AS (SELECT c.group_id, arg_max(c.label_id, depth) AS label_id, anchors FROM com c JOIN n USING (group_id) JOIN dep USING (label_id) WHERE k = anchors AND c.label_id IN ('L_RING', 'L_METAL', 'L_ROOT') GROUP BY c.group_id, anchors)"""


def consensus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(memberships, selected, consensus)."""
    found, _, closure = resolved(spark, d)
    selected = materialize(found.filter("status = 'ACCEPTED'"), "selected")
    groups = table(spark, d, "orders").select(F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("protein_id"))
    return groups, selected, labels.group_consensus(groups, selected, closure, [r.label_id for r in RULES])


@query("agg05_label_propagation_consensus", f"WITH {_CONSENSUS} SELECT group_id, label_id, anchors FROM consensus")
def agg05(spark: SparkSession, d: str) -> DataFrame:
    return consensus(spark, d)[2]


@query("agg05_propagated_candidates", f"""
    WITH {_CONSENSUS} SELECT DISTINCT g.protein_id, c.label_id, 'ring_group_propagation' AS rule_id, 4e0 AS score, o_orderstatus <> 'P'
    AS accepted FROM g JOIN consensus c USING (group_id) JOIN orders ON o_orderkey = g.protein_id
    JOIN dm ON dm.protein_id = g.protein_id AND dm.rule_id = 'ring' AND dm.kind = 'REQUIRED_DOMAIN'
    WHERE c.label_id = 'L_RING' AND g.protein_id NOT IN (SELECT protein_id
    FROM resolved WHERE status = 'ACCEPTED')""")
def agg05_propagated(spark: SparkSession, d: str) -> DataFrame:
    groups, selected, found = consensus(spark, d)
    _, domains, structures = evidence(spark, d)
    return labels.propagate_labels(groups, materialize(found, "consensus"), selected, domains, structures, RULES).select("protein_id", "label_id", "rule_id", "score", "accepted")


@query("fea11_circularity_filter", f"""
    WITH {B.HITS}, {B.cte('domain_assessments')}, gone AS (SELECT DISTINCT p_brand AS domain_id
    FROM part WHERE p_size % 10 = 1 AND p_brand LIKE '%#1%'), kept AS (SELECT protein_id, authority, count(DISTINCT domain_id) AS n
    FROM hits WHERE domain_id NOT IN (SELECT domain_id FROM gone)
    GROUP BY 1, 2) SELECT a.protein_id, a.domain_authority, CASE WHEN assessment_status = 'ASSESSED_WITH_HIT' AND n IS NULL THEN
    'ASSESSED_NO_HIT' ELSE assessment_status END AS assessment_status, coalesce(n, 0) AS kept
    FROM domain_assessments a LEFT JOIN kept k ON k.protein_id = a.protein_id AND k.authority = a.domain_authority""")
def fea11(spark: SparkSession, d: str) -> DataFrame:
    hits = B.domain_hits(spark, d).withColumnRenamed("authority", "domain_authority")
    defining = table(spark, d, "part").filter("p_size % 10 = 1 and p_brand like '%#1%'").select(F.col("p_brand").alias("domain_id"))
    return labels.without_defining_domains(hits, B.frame(spark, d, "domain_assessments"), defining)


@query("jon24_review_context_join", f"""WITH {B.HITS}, {B.cte('structures')}, dom AS (SELECT protein_id, string_agg(DISTINCT domain_id, '|' ORDER BY domain_id) AS domain_ids, count(DISTINCT domain_id) AS n FROM hits GROUP BY 1),
    st AS (SELECT protein_id, arg_max((analysis_eligibility_status = 'ELIGIBLE')::INT, (analysis_eligibility_status = 'ELIGIBLE', coalesce(mean_confidence, -1))) AS ok, max(CASE WHEN r = 1 THEN mean_confidence END) AS mean_confidence FROM (SELECT *, row_number() OVER (PARTITION BY protein_id ORDER BY (analysis_eligibility_status = 'ELIGIBLE') DESC, coalesce(mean_confidence, -1) DESC) AS r FROM structures) GROUP BY 1)
    SELECT o_orderkey AS protein_id, CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE 'S' || o_custkey % 50 END AS species, o_orderkey % 6 = 0 AS input_candidate, coalesce(domain_ids, '') AS domain_ids, coalesce(n, 0) AS domain_count, coalesce(ok, 0) = 1 AS structure_eligible, mean_confidence FROM orders LEFT JOIN dom ON dom.protein_id = o_orderkey LEFT JOIN st ON st.protein_id = o_orderkey""")
def jon24(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    key, species = F.col("o_orderkey"), F.concat(F.lit("S"), F.col("o_custkey") % 50)
    proteins = orders.select(key.alias("protein_id"), F.col("o_custkey").alias("sequence_length"))
    structures = B.frame(spark, d, "structures").select("protein_id", (F.col("analysis_eligibility_status") == "ELIGIBLE").alias("structure_eligible"), "mean_confidence")
    best = structures.groupBy("protein_id").agg(F.max("structure_eligible").alias("e"))
    review = orders.filter("o_orderkey % 4 < 2").join(best, key == F.col("protein_id"), "left").select(key.alias("protein_id"), F.col("o_custkey").alias("sequence_length"), F.array(species).alias("species"), (key % 6 == 0).alias("input_candidate"), F.coalesce("e", F.lit(False)).alias("structure_eligible"))
    metadata = orders.filter("o_orderkey % 4 > 0").select(key.alias("protein_id"), F.when(key % 4 < 3, F.array(species)).otherwise(F.array().cast("array<string>")).alias("species"), (key % 6 == 0).alias("input_candidate"))
    found = labels.merged_context(proteins, review, metadata, B.domain_hits(spark, d), structures)
    return found.withColumns({"species": F.array_join("species", "|"), "domain_ids": F.array_join("domain_ids", "|")})


@query("val08_assignment_profile_check", f"""WITH RECURSIVE labels AS (SELECT 'ROOT' AS label_id, NULL AS parent_label_id, NULL AS grp, true AS allowed, '' AS role UNION ALL SELECT 'R' || r_regionkey, 'ROOT', 'region', true, '' FROM region UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, NULL, n_nationkey % 6 <> 0, CASE WHEN n_nationkey % 4 = 0 THEN 'ENZYME' ELSE 'UNKNOWN' END FROM nation),
    up AS (SELECT label_id, label_id AS ancestor_id FROM labels UNION ALL SELECT up.label_id, l.parent_label_id FROM up JOIN labels l ON up.ancestor_id = l.label_id WHERE l.parent_label_id IS NOT NULL),
    a AS (SELECT c_custkey AS protein_id, 'N' || c_nationkey AS label_id, CASE WHEN c_custkey % 5 = 0 THEN 'AUTOMATED' ELSE 'REVIEWED' END AS state, CASE WHEN c_custkey % 7 = 0 THEN 'OTHER' ELSE 'ENZYME' END AS role FROM customer UNION ALL SELECT c_custkey, 'N' || (c_nationkey + 1) % 26, 'REVIEWED', 'ENZYME' FROM customer WHERE c_custkey % 11 = 0),
    s AS (SELECT a.protein_id, a.label_id, CASE WHEN l.label_id IS NULL THEN 'UNKNOWN_LABEL' WHEN NOT l.allowed THEN 'POSITIVE_NOT_ALLOWED' WHEN a.state = 'AUTOMATED' THEN 'STATE_NOT_REVIEWED' WHEN l.role NOT IN ('', 'UNKNOWN') AND a.role <> l.role THEN 'WRONG_ROLE' END AS problem FROM a LEFT JOIN labels l USING (label_id)),
    own AS (SELECT DISTINCT a.protein_id, l.grp, up.ancestor_id FROM a JOIN up USING (label_id) JOIN labels l ON l.label_id = up.ancestor_id WHERE l.grp IS NOT NULL)
    SELECT * FROM s WHERE problem IS NOT NULL UNION ALL SELECT protein_id, ancestor_id, 'EXCLUSIVITY_CONFLICT' FROM own WHERE (protein_id, grp) IN (SELECT (protein_id, grp) FROM own GROUP BY protein_id, grp HAVING count(*) > 1)""")
def val08(spark: SparkSession, d: str) -> DataFrame:
    region, nation, customer = (table(spark, d, n) for n in ("region", "nation", "customer"))
    none = F.lit(None).cast("string")
    tree = region.select(F.concat(F.lit("R"), "r_regionkey").alias("label_id"), F.lit("ROOT").alias("parent_label_id"), F.lit("region").alias("exclusivity_group"), F.lit(True).alias("reviewed_positive_allowed"), F.lit("").alias("component_role"))
    tree = tree.unionByName(nation.select(F.concat(F.lit("N"), "n_nationkey").alias("label_id"), F.concat(F.lit("R"), "n_regionkey").alias("parent_label_id"), none.alias("exclusivity_group"), (F.col("n_nationkey") % 6 != 0).alias("reviewed_positive_allowed"), F.when(F.col("n_nationkey") % 4 == 0, "ENZYME").otherwise("UNKNOWN").alias("component_role")))
    tree = tree.unionByName(region.select(F.lit("ROOT").alias("label_id"), none.alias("parent_label_id"), none.alias("exclusivity_group"), F.lit(True).alias("reviewed_positive_allowed"), F.lit("").alias("component_role")).distinct())
    row = lambda df, nat, state, role: df.select(F.col("c_custkey").alias("protein_id"), F.concat(F.lit("N"), nat).alias("label_id"), F.lit("REVIEWED_POSITIVE").alias("curation_status"), state.alias("evidence_status"), role.alias("component_role"))
    assigned = row(customer, F.col("c_nationkey"), F.when(F.col("c_custkey") % 5 == 0, "automated").otherwise("reviewed"), F.when(F.col("c_custkey") % 7 == 0, "OTHER").otherwise("ENZYME"))
    assigned = assigned.unionByName(row(customer.filter("c_custkey % 11 = 0"), (F.col("c_nationkey") + 1) % 26, F.lit("reviewed"), F.lit("ENZYME")))
    return labels_check(assigned, tree)


def labels_check(assigned: DataFrame, tree: DataFrame) -> DataFrame:
    return blocks.assignment_violations(assigned, tree, blocks.label_closure(tree), ["AUTOMATED"])


@query("grf04_profile_comparisons", f"""WITH RECURSIVE labels AS (SELECT 'ROOT' AS label_id, NULL AS parent_label_id, 'all' AS display_name, false AS dflt, NULL AS bg UNION ALL SELECT 'R:' || r_regionkey, 'ROOT', r_name, true, 'ctl/' || r_regionkey FROM region UNION ALL SELECT 'N' || n_nationkey, 'R:' || n_regionkey, n_name, n_nationkey % 4 <> 3, CASE WHEN n_nationkey % 9 = 0 THEN 'ctl/x' END FROM nation
        UNION ALL SELECT DISTINCT 'S' || c_nationkey || c_mktsegment, 'N' || c_nationkey, c_mktsegment || ' ' || c_nationkey, true, NULL FROM customer UNION ALL SELECT 'ctl/' || r_regionkey, NULL, 'control ' || r_name, false, NULL FROM region UNION ALL SELECT 'ctl/x', NULL, 'control x', false, NULL),
    up AS (SELECT label_id, label_id AS ancestor_id, 0 AS depth FROM labels UNION ALL SELECT up.label_id, l.parent_label_id, depth + 1 FROM up JOIN labels l ON up.ancestor_id = l.label_id WHERE l.parent_label_id IS NOT NULL),
    near AS (SELECT up.label_id, arg_min(l.bg, depth) AS bg FROM up JOIN labels l ON l.label_id = up.ancestor_id WHERE l.bg IS NOT NULL GROUP BY 1)
    SELECT replace(replace(l.label_id, ':', '__'), '/', '_') || '_vs_' || replace(replace(coalesce(n.bg, 'ctl/x'), ':', '__'), '/', '_') AS comparison_id, l.display_name || ' versus ' || b.display_name AS display_name, l.label_id AS target_label_id, coalesce(n.bg, 'ctl/x') AS background_label_id
    FROM labels l LEFT JOIN near n USING (label_id) JOIN labels b ON b.label_id = coalesce(n.bg, 'ctl/x') WHERE l.dflt AND l.label_id <> 'ROOT' AND l.label_id <> 'R:4' AND l.label_id IN (SELECT label_id FROM up WHERE ancestor_id = 'ROOT') AND l.label_id NOT IN (SELECT label_id FROM up WHERE ancestor_id = 'R:2')""")
def grf04(spark: SparkSession, d: str) -> DataFrame:
    region, nation, customer = (table(spark, d, n) for n in ("region", "nation", "customer"))
    none = F.lit(None).cast("string")
    row = lambda df, label, parent, name, default, background: df.select(label.alias("label_id"), parent.alias("parent_label_id"), name.alias("display_name"), default.alias("default_analysis"), background.alias("default_background_label_id"))
    r, n = F.col("r_regionkey"), F.col("n_nationkey")
    tree = row(region.limit(1), F.lit("ROOT"), none, F.lit("all"), F.lit(False), none).unionByName(row(region, F.concat(F.lit("R:"), r), F.lit("ROOT"), F.col("r_name"), F.lit(True), F.concat(F.lit("ctl/"), r)))
    tree = tree.unionByName(row(nation, F.concat(F.lit("N"), n), F.concat(F.lit("R:"), "n_regionkey"), F.col("n_name"), n % 4 != 3, F.when(n % 9 == 0, "ctl/x")))
    tree = tree.unionByName(row(customer, F.concat(F.lit("S"), "c_nationkey", "c_mktsegment"), F.concat(F.lit("N"), "c_nationkey"), F.concat_ws(" ", "c_mktsegment", "c_nationkey"), F.lit(True), none).distinct())
    tree = tree.unionByName(row(region, F.concat(F.lit("ctl/"), r), none, F.concat(F.lit("control "), "r_name"), F.lit(False), none)).unionByName(row(region.limit(1), F.lit("ctl/x"), none, F.lit("control x"), F.lit(False), none))
    tree = materialize(tree, "labels")
    return blocks.profile_comparisons(tree, blocks.label_closure(tree), "ROOT", "ctl/x", ["R:4"], ["R:2"])


# -- matching ------------------------------------------------------------------------------------------------------

_CONTEXT = """dom AS (SELECT l_orderkey, list_sort(list_distinct(list(p_brand))) AS domain_ids FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 2 GROUP BY 1),
    ctx AS (SELECT o_custkey AS unit, o_orderkey AS protein_id, 'S' || (o_custkey // 50) AS species, o_orderstatus = 'F' AS structure_eligible, coalesce(domain_ids, []) AS domain_ids, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey * 37 % 1000) / 10 END AS mean_confidence, (o_totalprice / 1000)::BIGINT AS sequence_length FROM orders LEFT JOIN dom ON l_orderkey = o_orderkey),
    rep AS (SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY structure_eligible DESC, coalesce(mean_confidence, -1) DESC, sequence_length, protein_id) AS k FROM ctx) WHERE k = 1)"""


def contexts(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").filter("l_linenumber <= 2").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    own = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_brand")).alias("domain_ids"))
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").join(own, F.col("l_orderkey") == key, "left")
    return rows.select(
        F.col("o_custkey").alias("unit"), key.alias("protein_id"), F.array(F.concat(F.lit("S"), F.floor(F.col("o_custkey") / 50))).alias("species"), (F.col("o_orderstatus") == "F").alias("structure_eligible"), F.coalesce("domain_ids", F.array().cast("array<string>")).alias("domain_ids"),
        F.when(key % 11 != 0, key * 37 % 1000 / 10).alias("mean_confidence"), F.rint(F.col("o_totalprice") / 1000).cast("long").alias("sequence_length"),  # halves to even, as the SQL's cast
    )


def representatives(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(targets, controls): a context a customer; every fourth is a target."""
    found = materialize(matching.unit_representatives(contexts(spark, d)), "representatives")
    return found.filter("unit % 4 = 0"), found.filter("unit % 4 <> 0")


@query("win07_unit_representative", f"WITH {_CONTEXT} SELECT unit, protein_id, sequence_length FROM rep")
def win07(spark: SparkSession, d: str) -> DataFrame:
    return matching.unit_representatives(contexts(spark, d)).select("unit", "protein_id", "sequence_length")


_CANDIDATES = f"""{_CONTEXT}, cand AS (SELECT t.unit AS target_unit, t.protein_id AS target_id, c.unit AS control_unit, c.protein_id AS control_id, abs(log2(t.sequence_length + 1) - log2(c.sequence_length + 1)) AS gap, abs(len(t.domain_ids) - len(c.domain_ids)) AS n,
        CASE WHEN len(list_distinct(list_concat(t.domain_ids, c.domain_ids))) > 0 THEN len(list_intersect(t.domain_ids, c.domain_ids)) / len(list_distinct(list_concat(t.domain_ids, c.domain_ids))) ELSE 1 END AS jaccard, coalesce(abs(t.mean_confidence - c.mean_confidence) / 100, 0) AS conf
        FROM rep t JOIN rep c ON t.unit % 4 = 0 AND c.unit % 4 <> 0 AND t.species = c.species AND t.structure_eligible = c.structure_eligible), near AS (SELECT * FROM cand WHERE gap <= 0.5 AND n <= 1)"""


@query("jon25_control_candidate_join", f"WITH {_CANDIDATES} SELECT target_unit, target_id, control_unit, control_id FROM near")
def jon25(spark: SparkSession, d: str) -> DataFrame:
    return matching.control_candidates(*representatives(spark, d)).select("target_unit", "target_id", "control_unit", "control_id")


@query("fea13_control_distance", f"WITH {_CANDIDATES} SELECT target_unit, control_unit, round(2 * gap + 0.25 * n + 0.5 * (1 - jaccard) + 0.5 * conf, 7) AS distance FROM near")
def fea13(spark: SparkSession, d: str) -> DataFrame:
    return r7(matching.control_candidates(*representatives(spark, d)).select("target_unit", "control_unit", "distance"), "distance")


@query("grf07_greedy_control_match")
def grf07(spark: SparkSession, d: str) -> DataFrame:
    return matching.greedy_match(matching.control_candidates(*representatives(spark, d)), 2)


@query("grf08_max_coverage_match")
def grf08(spark: SparkSession, d: str) -> DataFrame:
    return matching.coverage_first_match(materialize(matching.control_candidates(*representatives(spark, d)), "candidates"), 2)


@query("win15_matched_slots", """
    WITH m AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_totalprice, o_orderkey) AS slot FROM orders) SELECT 'B' AS background_label_id, c_custkey AS target_unit_id, s.slot,
    o_orderkey AS control_unit_id, CASE WHEN o_orderkey IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END AS status
    FROM customer CROSS JOIN (SELECT unnest([1, 2, 3]) AS slot) s
    LEFT JOIN m ON m.o_custkey = c_custkey AND m.slot = s.slot""")
def win15(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "orders").select(F.col("o_custkey").alias("target_unit"), F.col("o_orderkey").alias("control_unit"), F.col("o_orderkey").alias("control_id"), F.col("o_totalprice").alias("distance"))
    targets = table(spark, d, "customer").select(F.col("c_custkey").alias("unit"), F.col("c_custkey").alias("protein_id"))
    return matching.match_audit(targets, matching.greedy_match(pairs, 3), 3, "B").select("background_label_id", "target_unit_id", "slot", "control_unit_id", "status")


@query("fea12_control_pool", """
    WITH p AS (SELECT o_orderkey AS protein_id, o_custkey AS unit, o_orderstatus = 'P' AS input_candidate
    FROM orders) SELECT * FROM p WHERE protein_id NOT IN (SELECT l_orderkey
    FROM lineitem WHERE l_quantity > 45) AND unit NOT IN (SELECT unit
    FROM p WHERE protein_id % 40 = 0) AND NOT input_candidate""")
def fea12(spark: SparkSession, d: str) -> DataFrame:
    proteins = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), F.col("o_custkey").alias("unit"), (F.col("o_orderstatus") == "P").alias("input_candidate"))
    candidates = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("protein_id"))
    return matching.control_pool(proteins, candidates, proteins.filter("protein_id % 40 = 0")).select("protein_id", "unit", "input_candidate")


# -- frozen signatures -----------------------------------------------------------------------------------------------

_FROZEN = f"""{B.cte('signatures', 'features', 'report_comparisons')}, frozen AS (SELECT comparison_id, feature_type, feature_id, CASE WHEN evidence_class LIKE '%STUDY_WIDE' THEN validation_study_q_value ELSE validation_q_value END AS q_value, CASE WHEN evidence_class LIKE '%STUDY_WIDE' THEN 'STUDY_WIDE' ELSE 'WITHIN_COMPARISON' END AS fdr_scope, validation_prevalence_difference AS prevalence_difference
        FROM signatures WHERE evidence_class IN ('DECISION_CANDIDATE__VALIDATED_STUDY_WIDE', 'DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON') AND status = 'COMPLETE' AND validation_prevalence_difference > 0),
    states AS (SELECT DISTINCT protein_id, feature_type, feature_id, CASE (protein_id + length(feature_id)) % 3 WHEN 0 THEN 'ASSESSED_NO_FEATURE' WHEN 1 THEN 'NOT_ASSESSED' ELSE 'ASSESSED_WITH_FEATURE' END AS evidence_status FROM features WHERE feature_type <> 'AMINO_ACID_KMER'),
    kmers AS (SELECT DISTINCT protein_id, feature_type, feature_id FROM features WHERE feature_type = 'AMINO_ACID_KMER'), units AS (SELECT o_custkey AS unit_id, o_orderkey AS protein_id FROM orders)"""


def _signatures(spark: SparkSession, d: str) -> DataFrame:
    """The frozen signatures of all studies."""
    return frozen.frozen_signatures(B.frame(spark, d, "signature_studies"), within_comparison=True, within=["study"])


def _frozen(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(units, frozen, states, kmers)."""
    rows = materialize(B.frame(spark, d, "features").select("protein_id", "feature_type", "feature_id").distinct(), "features")
    state = (F.col("protein_id") + F.length("feature_id")) % 3
    states = rows.filter("feature_type <> 'AMINO_ACID_KMER'").withColumn("evidence_status", F.when(state == 0, "assessed_no_feature").when(state == 1, "not_assessed").otherwise("assessed_with_feature"))
    own = materialize(_signatures(spark, d), "frozen")
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("unit_id"), F.col("o_orderkey").alias("protein_id"))
    kept, _ = frozen.query_states(states, own, orders.select("protein_id"))
    return frozen.query_units(orders.select("protein_id"), orders), own, kept, rows.filter("feature_type = 'AMINO_ACID_KMER'")


@query("fea19_frozen_signature_select", f"WITH {_FROZEN} SELECT comparison_id, feature_type, feature_id, round(q_value, 7) AS q_value, fdr_scope, round(prevalence_difference, 7) AS prevalence_difference FROM frozen")
def fea19(spark: SparkSession, d: str) -> DataFrame:
    return r7(_signatures(spark, d).drop("study"), "q_value", "prevalence_difference")


@query("fea20_query_states_and_units", f"WITH {_FROZEN} SELECT s.* FROM states s SEMI JOIN frozen f ON f.feature_type = s.feature_type AND f.feature_id = s.feature_id")
def fea20(spark: SparkSession, d: str) -> DataFrame:
    return _frozen(spark, d)[2]


_CALLS = f"""{_FROZEN}, keys AS (SELECT DISTINCT feature_type, feature_id FROM frozen), size AS (SELECT unit_id, count(*) AS members FROM units GROUP BY 1),
    given AS (SELECT u.unit_id, s.feature_type, s.feature_id, CASE WHEN bool_or(evidence_status = 'ASSESSED_WITH_FEATURE') THEN 'PRESENT' WHEN count_if(evidence_status = 'ASSESSED_NO_FEATURE') = any_value(members) THEN 'ABSENT' ELSE 'UNKNOWN' END AS call FROM states s JOIN keys USING (feature_type, feature_id) JOIN units u USING (protein_id) JOIN size USING (unit_id) GROUP BY 1, 2, 3),
    calls AS (SELECT * FROM given UNION ALL SELECT DISTINCT u.unit_id, k.feature_type, k.feature_id, 'PRESENT' FROM kmers k JOIN keys USING (feature_type, feature_id) JOIN units u USING (protein_id))"""


@query("agg06_unit_evidence_state", f"WITH {_CALLS} SELECT unit_id, feature_type, feature_id, call FROM calls")
def agg06(spark: SparkSession, d: str) -> DataFrame:
    return frozen.feature_calls(*_frozen(spark, d))


@query("jon08_frozen_signature_query", f"""WITH {_CALLS}, ref AS (SELECT c.comparison_id, count(f.feature_id) AS reference_features, coalesce(count_if(f.feature_type = 'AMINO_ACID_KMER'), 0) AS kmer_refs FROM report_comparisons c LEFT JOIN frozen f USING (comparison_id) GROUP BY 1),
    cnt AS (SELECT unit_id, comparison_id, count_if(call = 'PRESENT') AS present, count_if(call = 'ABSENT') AS absent_listed, count_if(call = 'PRESENT' AND feature_type = 'AMINO_ACID_KMER') AS present_kmers, string_agg(DISTINCT feature_type, '|' ORDER BY feature_type) FILTER (call = 'PRESENT') AS types FROM calls JOIN frozen USING (feature_type, feature_id) GROUP BY 1, 2),
    o AS (SELECT unit_id, comparison_id, members AS member_count, reference_features, coalesce(present, 0) AS present, coalesce(absent_listed, 0) + kmer_refs - coalesce(present_kmers, 0) AS absent, coalesce(types, '') AS present_types FROM size CROSS JOIN ref LEFT JOIN cnt USING (unit_id, comparison_id))
    SELECT *, reference_features - present - absent AS unknown, CASE WHEN reference_features = 0 THEN 'NO_VALIDATED_REFERENCE_FEATURES' WHEN present > 0 THEN 'FEATURE_EVIDENCE_PRESENT' WHEN reference_features - present - absent > 0 THEN 'UNKNOWN_ASSESSMENT' ELSE 'ASSESSED_NO_FEATURE' END AS evidence_state FROM o""")
def jon08(spark: SparkSession, d: str) -> DataFrame:
    units, own, states, kmers = _frozen(spark, d)
    return frozen.unit_evidence(units, B.frame(spark, d, "report_comparisons"), own, frozen.feature_calls(units, own, states, kmers))


@query("jon08_unit_hits", f"""
    WITH {_CALLS}, have AS (SELECT protein_id, feature_type, feature_id
    FROM states WHERE evidence_status = 'ASSESSED_WITH_FEATURE' UNION SELECT *
    FROM kmers) SELECT u.unit_id, f.comparison_id, h.feature_type, h.feature_id, count(*) AS positives, round(any_value(q_value), 7) AS
    q_value, any_value(fdr_scope) AS fdr_scope FROM have h JOIN units u USING (protein_id)
    JOIN frozen f USING (feature_type, feature_id) GROUP BY 1, 2, 3, 4""")
def jon08_hits(spark: SparkSession, d: str) -> DataFrame:
    hits = frozen.unit_hits(*_frozen(spark, d))
    # one row for the studies of a feature, with the least q of them (the SQL takes that of any)
    own = hits.groupBy("unit_id", "comparison_id", "feature_type", "feature_id").agg(F.sum("positives").alias("positives"), F.min(F.struct("q_value", "fdr_scope")).alias("q"))
    return r7(own.select("unit_id", "comparison_id", "feature_type", "feature_id", "positives", "q.*"), "q_value")


@query("jon09_frozen_kmer_scan", f"""
    WITH {B.SEQUENCES}, v AS (SELECT unnest(['THE', 'EAU', 'CHE', 'ION', 'ZZZ']) AS kmer) SELECT protein_id, 'AMINO_ACID_KMER' AS
    feature_type, 'k3:' || kmer AS feature_id FROM sequences, v WHERE contains(sequence, kmer)
    UNION ALL SELECT protein_id, 'AMINO_ACID_KMER', 'k5:ATION' FROM sequences
    WHERE contains(sequence, 'ATION')""")
def jon09(spark: SparkSession, d: str) -> DataFrame:
    features = spark.createDataFrame([("AMINO_ACID_KMER", f) for f in ("k3:THE", "k3:EAU", "k3:CHE", "k3:ION", "k3:ZZZ", "k5:ATION")] + [("FOLD", "x")], "feature_type string, feature_id string")
    return frozen.kmer_calls(B.sequences(spark, d), features)


_PROJECT = """pairs AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey + 1000000000 ELSE l_suppkey END AS a, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE l_orderkey + 1000000000 END AS b, l_partkey % 100 / 1e2 AS tm_score, (40 + l_partkey % 61) / 1e2 AS ca, (40 + l_suppkey % 61) / 1e2 AS cb, l_returnflag <> 'N' AS done FROM lineitem),
    hits AS (SELECT greatest(a, b) AS protein_id, least(a, b) AS reference_id, 'SC_' || (least(a, b) // 5) AS cluster_id, tm_score FROM pairs WHERE done AND tm_score >= 0.5 AND least(ca, cb) >= 0.5 AND least(a, b) % 7 <> 0)"""


@query("jon10_cluster_projection", f"WITH {_PROJECT} SELECT protein_id, cluster_id, 'U1' AS comparison_universe_id, count(DISTINCT reference_id) AS supporting_references, max(tm_score) AS best_tm_score FROM hits GROUP BY 1, 2")
def jon10(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    far, even = F.col("l_orderkey") + 1_000_000_000, F.col("l_linenumber") % 2 == 0
    search = [F.lit("Foldseek").alias("comparison_tool"), F.lit("1").alias("comparison_tool_version"), F.lit("FULL_SEQUENCE").alias("coverage_scope")]
    pairs = lines.select(F.when(even, far).otherwise(F.col("l_suppkey")).alias("protein_a_id"), F.when(even, F.col("l_suppkey")).otherwise(far).alias("protein_b_id"), (F.col("l_partkey") % 100 / 100).alias("tm_score"), ((40 + F.col("l_partkey") % 61) / 100).alias("coverage_a"), ((40 + F.col("l_suppkey") % 61) / 100).alias("coverage_b"), F.when(F.col("l_returnflag") == "N", "FAILED").otherwise("COMPLETE").alias("comparison_status"), F.lit("U1").alias("comparison_universe_id"), *search)
    clusters = table(spark, d, "supplier").filter("s_suppkey % 7 <> 0").select(F.concat(F.lit("SC_"), F.floor(F.col("s_suppkey") / 5)).alias("cluster_id"), F.col("s_suppkey").alias("protein_id"), F.lit("DISCOVERY_COMPONENT").alias("membership_method"), F.lit(0.5).alias("tm_score_threshold"), F.lit(0.5).alias("minimum_coverage"), *search)
    return frozen.project_clusters(pairs, lines.select(far.alias("protein_id")), clusters)


@query("agg10_projection_support", f"WITH {_PROJECT} SELECT cluster_id, count(DISTINCT protein_id) AS queries, count(DISTINCT reference_id) AS supporting_references, max(tm_score) AS best_tm_score FROM hits GROUP BY 1")
def agg10(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").filter("l_returnflag <> 'N' and l_suppkey % 7 <> 0")
    cover = F.least((40 + F.col("l_partkey") % 61) / 100, (40 + F.col("l_suppkey") % 61) / 100)
    hits = lines.filter((F.col("l_partkey") % 100 / 100 >= 0.5) & (cover >= 0.5)).select((F.col("l_orderkey") + 1_000_000_000).alias("query"), F.concat(F.lit("SC_"), F.floor(F.col("l_suppkey") / 5)).alias("cluster_id"), F.col("l_suppkey").alias("reference_id"), (F.col("l_partkey") % 100 / 100).alias("tm_score"), F.lit("U1").alias("comparison_universe_id"))
    queries = hits.groupBy("cluster_id").agg(F.count_distinct("query").alias("queries"))
    return frozen.projection_support(hits.withColumn("protein_id", F.lit(0))).select("cluster_id", "supporting_references", "best_tm_score").join(queries, "cluster_id")


