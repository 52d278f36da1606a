"""How the driver's tables stand in for the tables of a cohort.

Most stand-ins are plain projections that Spark and DuckDB read alike; they are written once, as SQL, in ``SHARED``. A name in
braces is another stand-in or a table of the driver. ``frame`` gives one as a DataFrame, ``cte`` gives the SQL of some for the queries
that check ours.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators.blocks import partition_of
from cohortry.storage import table

BACKGROUND = "BUILDING"
_AA = "'ACDEFGHIKLMNPQRSTVWY'"


def _letter(step: int) -> str:
    return f"substr({_AA}, CAST(CAST(floor(p_partkey / {step}) AS BIGINT) % 20 AS INT) + 1, 1)"


#: The part of a line as a feature: a k-mer, a domain or a structure cluster.
_PART_TYPE = "CASE p_partkey % 3 WHEN 0 THEN 'AMINO_ACID_KMER' WHEN 1 THEN 'PFAM_DOMAIN' ELSE 'STRUCTURE_CLUSTER' END"
_PART_ID = f"CASE p_partkey % 3 WHEN 0 THEN 'k4:' || {_letter(1)} || {_letter(20)} || {_letter(400)} || {_letter(8000)} WHEN 1 THEN 'Pfam:' || p_brand || '.' || p_partkey ELSE 'SC_' || p_partkey END"

SHARED = {
    # -- comparisons of customer segments; orders are proteins ---------------------------------------------------
    "comparisons": "SELECT DISTINCT c_mktsegment AS comparison_id, c_mktsegment || ' versus BUILDING' AS display_name, c_mktsegment AS target_label_ids, 'BUILDING' AS background_label_ids FROM {customer} WHERE c_mktsegment <> 'BUILDING'",
    "label_memberships": "SELECT o_orderkey AS protein_id, c_mktsegment AS label_id, 'DIRECT' AS membership_source FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
    # brands of lines; three of five brands of a segment are found in three times as many lines
    "positives": """
        SELECT DISTINCT l_orderkey AS protein_id, 'DOMAIN' AS feature_type, l_returnflag || ':' || p_brand AS feature_id FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
            WHERE l_linenumber = 1 OR (l_linenumber <= 3 AND (length(c_mktsegment) * 3 + CAST(substr(p_brand, 7) AS INT)) % 5 = 0)
        UNION SELECT l_orderkey, 'AMINO_ACID_KMER', 'k3:' || upper(substr(p_type, 1, 3)) FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_linenumber = 1 AND l_quantity > 40
        UNION SELECT o_orderkey, 'STRUCTURE_AVAILABLE', 'MODEL' FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND (o_orderkey % 29 = 0 OR (c_mktsegment = 'MACHINERY' AND o_orderkey % 9 = 0))
        UNION SELECT l_orderkey, 'STRUCTURAL_POCKET', 'POCKET:' || l_linestatus FROM {lineitem} WHERE l_linenumber = 2 AND l_quantity > 47""",
    "domain_assessments": """
        SELECT o_orderkey AS protein_id, authority AS domain_authority, CASE WHEN n IS NOT NULL THEN 'ASSESSED_WITH_HIT' WHEN o_orderkey % 100 < 99 THEN 'ASSESSED_NO_HIT' ELSE 'NOT_ASSESSED' END AS assessment_status, coalesce(n, 0) AS hit_count
        FROM (SELECT o_orderkey, 'A' AS authority FROM {orders} UNION ALL SELECT o_orderkey, 'N' FROM {orders} UNION ALL SELECT o_orderkey, 'R' FROM {orders}) o
        LEFT JOIN (SELECT l_orderkey, l_returnflag, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_returnflag) h ON h.l_orderkey = o_orderkey AND h.l_returnflag = authority""",
    "explicit_universes": "SELECT 'STRUCTURE_AVAILABLE' AS feature_type, 'MODEL' AS feature_id, o_orderkey AS protein_id FROM {orders} WHERE o_orderstatus <> 'P'",
    "exploratory": "SELECT DISTINCT feature_type, feature_id FROM {positives} WHERE feature_type = 'DOMAIN' AND feature_id LIKE '%#7'",
    # -- features with places, and the signatures of reports -------------------------------------------------------
    "features": f"SELECT DISTINCT l_orderkey AS protein_id, {_PART_TYPE} AS feature_type, {_PART_ID} AS feature_id, p_name AS feature_name, CASE WHEN p_partkey % 3 = 1 THEN CAST(l_linenumber AS BIGINT) END AS start, CASE WHEN p_partkey % 3 = 1 THEN CAST(l_linenumber + p_size AS BIGINT) END AS stop, p_type AS evidence_source FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey",
    "report_comparisons": "SELECT 'C' || n_nationkey AS comparison_id, n_name || ' versus the rest' AS display_name, 'N' || n_nationkey AS target_label_ids FROM {nation}",
    "signatures": f"""
        SELECT 'C' || p_size % 6 AS comparison_id, {_PART_TYPE} AS feature_type, {_PART_ID} AS feature_id, p_name AS feature_name,
            CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE p_partkey * 31 % 997 / 1e4 END AS discovery_q_value, p_partkey * 37 % 991 / 1e4 AS discovery_study_q_value, (p_partkey * 17 % 200 - 60) / 2e2 AS discovery_prevalence_difference,
            p_partkey * 13 % 991 / 1e4 AS validation_q_value, p_partkey * 29 % 983 / 1e4 AS validation_study_q_value, (p_partkey * 11 % 200 - 60) / 2e2 AS validation_prevalence_difference,
            CASE p_partkey % 7 WHEN 0 THEN 'DECISION_CANDIDATE__VALIDATED_STUDY_WIDE' WHEN 1 THEN 'DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON' WHEN 2 THEN 'DECISION_CANDIDATE__DISCOVERY_ONLY' WHEN 3 THEN 'DECISION_CANDIDATE__NO_VALIDATION_DATA'
                WHEN 4 THEN 'EXPLORATORY_LOCAL_ONLY__DISCOVERY_ONLY' WHEN 5 THEN 'QC_TECHNICAL_NON_BIOLOGICAL__DISCOVERY_ONLY' ELSE 'DISCOVERY_NOT_TESTED__INSUFFICIENT_SAMPLE_SIZE' END AS evidence_class,
            CASE WHEN p_partkey % 7 = 6 THEN CASE WHEN p_partkey % 2 = 0 THEN 'INSUFFICIENT_SAMPLE_SIZE' ELSE 'NO_SIGNIFICANT_SIGNATURE' END ELSE 'COMPLETE' END AS status FROM {{part}}""",
    # -- assessments of outside features ------------------------------------------------------------------------------
    "feature_assessments": """
        SELECT DISTINCT l_orderkey AS protein_id, 'EXTERNAL' AS feature_type, p_brand AS feature_id,
            CASE (l_orderkey + CAST(substr(p_brand, 7) AS INT)) % 5 WHEN 0 THEN 'NOT_ASSESSED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'ASSESSED_NO_FEATURE' ELSE 'ASSESSED_WITH_FEATURE' END AS evidence_status,
            CASE CAST(substr(p_brand, 7) AS INT) % 4 WHEN 0 THEN 'FIXED_EXTERNAL' WHEN 1 THEN 'DISCOVERY_DERIVED' WHEN 2 THEN 'DISCOVERY_SUPERVISED' ELSE 'ALL_DATA_EXPLORATORY' END AS derivation_scope
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # -- structures ---------------------------------------------------------------------------------------------------
    "structures": """
        SELECT o_orderkey AS structure_id, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS protein_id, CASE WHEN o_orderkey % 3 = 0 THEN 'AlphaFoldDB' ELSE 'PDB' END AS structure_source,
            CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'models/' || o_orderkey || '.pdb' END AS coordinate_path, CASE WHEN o_orderstatus = 'P' THEN 'UNAVAILABLE' ELSE 'AVAILABLE' END AS availability_status,
            CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey * 37 % 1000 / 1e1 END AS mean_confidence,
            CASE WHEN o_orderstatus = 'P' THEN 'INELIGIBLE_COORDINATE_UNAVAILABLE' WHEN o_orderkey % 11 = 0 THEN 'INELIGIBLE_CONFIDENCE_UNAVAILABLE' WHEN o_orderkey * 37 % 1000 < 300 THEN 'INELIGIBLE_LOW_CONFIDENCE' ELSE 'ELIGIBLE' END AS analysis_eligibility_status,
            CASE o_orderkey % 5 WHEN 0 THEN 'NOT_ASSESSED' WHEN 1 THEN 'ASSESSED_NO_HIT' ELSE 'ASSESSED_WITH_HIT' END AS fold_evidence_status,
            CASE WHEN o_orderkey % 5 > 1 THEN 'F' || o_custkey % 12 ELSE '' END AS fold_id, CASE WHEN o_orderkey % 5 > 1 THEN 'fold ' || o_custkey % 12 ELSE '' END AS fold_name,
            CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_custkey % 12 < 6 THEN 'CATH' ELSE 'SCOP' END ELSE '' END AS fold_authority, CASE WHEN o_orderkey % 5 > 0 THEN '2024' ELSE '' END AS fold_authority_version,
            CASE WHEN o_orderkey % 3 = 1 THEN 'F' WHEN o_orderkey % 3 = 2 THEN 'O' ELSE '' END AS comparison_universe_id FROM {orders}""",
    "structure_comparisons": """
        SELECT l_linestatus AS comparison_universe_id, 'FULL_SEQUENCE' AS coverage_scope, CASE WHEN l_returnflag = 'A' THEN 'US-align' ELSE 'Foldseek' END AS comparison_tool, '1' AS comparison_tool_version,
            l_orderkey AS protein_a_id, l_orderkey + 1 + l_partkey % 3 AS protein_b_id, l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS source_record_id,
            CASE WHEN l_returnflag = 'N' AND l_partkey % 4 = 0 THEN 'FAILED' ELSE 'COMPLETE' END AS comparison_status,
            CASE WHEN l_returnflag = 'N' AND l_partkey % 4 = 0 THEN NULL ELSE (l_partkey * 7 + l_suppkey * 3) % 100 / 1e2 END AS tm_score,
            CASE WHEN l_returnflag = 'N' AND l_partkey % 4 = 0 THEN NULL ELSE (40 + l_partkey % 61) / 1e2 END AS coverage_a, CASE WHEN l_returnflag = 'N' AND l_partkey % 4 = 0 THEN NULL ELSE (40 + l_suppkey % 61) / 1e2 END AS coverage_b
        FROM {lineitem}""",
    "structure_partitions": "SELECT o_orderkey AS protein_id, CASE WHEN o_orderkey % 5 = 0 THEN 'VALIDATION' ELSE 'DISCOVERY' END AS partition FROM {orders}",
    # -- groups -------------------------------------------------------------------------------------------------------
    "group_memberships": """
        SELECT 'RUN1' AS run_id, 'HOG' AS group_type, 'N0' AS hierarchy_node, 'HOG' || o_custkey AS group_id, o_orderkey AS protein_id, c_mktsegment AS species_label FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        UNION ALL SELECT 'RUN1', 'OG', '', 'OG' || c_nationkey, o_orderkey, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # -- cluster audits -------------------------------------------------------------------------------------------------
    "audited": """
        SELECT 'sub_' || l_suppkey AS subcluster_id, l_suppkey AS native_representative_id, l_orderkey * 10 + l_linenumber AS sequence_id, CASE WHEN l_linenumber = 1 AND l_quantity > 49 THEN 'CENTROID_SELF' WHEN l_quantity > 10 THEN 'EXACT_THRESHOLDS_PASS' WHEN l_quantity > 5 THEN 'EXACT_THRESHOLDS_FAIL' ELSE 'NO_REALIGNMENT' END AS alignment_status,
            l_partkey % 700 + 50 AS sequence_length, CASE WHEN l_quantity > 5 THEN 100 - l_discount * 100 END AS pident, CASE WHEN l_quantity > 5 THEN 50 + l_partkey % 50 END AS representative_coverage, CASE WHEN l_quantity > 5 THEN 50 + l_suppkey % 50 END AS member_coverage, l_extendedprice AS bitscore FROM {lineitem}""",
    # -- predictions of a model -----------------------------------------------------------------------------------------
    "predictions": """
        SELECT c_mktsegment AS comparison_id, o_orderkey AS protein_id, CASE WHEN o_custkey % 3 = 0 THEN 'VALIDATION' ELSE 'DISCOVERY' END AS partition, CAST(floor(o_custkey / 2) AS BIGINT) AS partition_key, CASE WHEN o_custkey % 4 < 2 THEN 'TARGET' ELSE 'BACKGROUND' END AS true_class,
            (o_orderkey * 37 % 1000 + CASE WHEN o_custkey % 4 < 2 THEN 600 ELSE 0 END) / 16e2 AS predicted_probability FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
}
#: The signatures with the study of each: four residues have 160,000 forms, so as many parts make a study, within which no k-mer repeats.
SHARED["signature_studies"] = SHARED["signatures"].replace(" FROM {part}", ", CAST(floor(p_partkey / 160000) AS BIGINT) AS study FROM {part}")
#: Stand-ins as Spark makes them, the same rows as those of ``SHARED`` in fewer passes: lines meet their part and their order once for all features,
#: so those of a protein are already together when repeated ones are dropped, and the hits of an order are counted side by side.
_BUILT = {
    "labelled_orders": "SELECT o_orderkey, o_orderstatus, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
    "positives": """
        SELECT DISTINCT l_orderkey AS protein_id, f.feature_type, f.feature_id FROM (
            SELECT l_orderkey, explode(array(CASE WHEN domain IS NOT NULL AND o_orderkey IS NOT NULL AND (first OR (length(c_mktsegment) * 3 + number) % 5 = 0) THEN named_struct('feature_type', 'DOMAIN', 'feature_id', domain.id) END, other)) AS f
            FROM (SELECT l_orderkey, l_linenumber = 1 AS first, CASE WHEN p_partkey IS NOT NULL THEN named_struct('id', l_returnflag || ':' || p_brand) END AS domain, CASE WHEN l_linenumber <> 1 THEN CAST(substr(p_brand, 7) AS INT) END AS number,
                    CASE WHEN l_linenumber = 1 AND l_quantity > 40 AND p_partkey IS NOT NULL THEN named_struct('feature_type', 'AMINO_ACID_KMER', 'feature_id', 'k3:' || upper(substr(p_type, 1, 3)))
                        WHEN l_linenumber = 2 AND l_quantity > 47 THEN named_struct('feature_type', 'STRUCTURAL_POCKET', 'feature_id', 'POCKET:' || l_linestatus) END AS other
                FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM {lineitem} WHERE l_linenumber <= 3) LEFT JOIN (SELECT p_partkey, p_brand, p_type FROM {part}) ON l_partkey = p_partkey)
            LEFT JOIN (SELECT o_orderkey, c_mktsegment FROM {labelled_orders}) ON l_orderkey = o_orderkey) WHERE f IS NOT NULL
        UNION ALL SELECT DISTINCT o_orderkey, 'STRUCTURE_AVAILABLE', 'MODEL' FROM {labelled_orders} WHERE o_orderstatus <> 'P' AND (o_orderkey % 29 = 0 OR (c_mktsegment = 'MACHINERY' AND o_orderkey % 9 = 0))""",
    "domain_assessments": """
        SELECT o_orderkey AS protein_id, domain_authority, CASE WHEN n > 0 THEN 'ASSESSED_WITH_HIT' WHEN o_orderkey % 100 < 99 THEN 'ASSESSED_NO_HIT' ELSE 'NOT_ASSESSED' END AS assessment_status, coalesce(n, 0) AS hit_count
        FROM (SELECT o_orderkey, inline(array(named_struct('domain_authority', 'A', 'n', a), named_struct('domain_authority', 'N', 'n', n), named_struct('domain_authority', 'R', 'n', r))) FROM {orders}
            LEFT JOIN (SELECT l_orderkey, count_if(l_returnflag = 'A') AS a, count_if(l_returnflag = 'N') AS n, count_if(l_returnflag = 'R') AS r FROM {lineitem} GROUP BY l_orderkey) ON l_orderkey = o_orderkey)""",
}
_SHA = re.compile(r"sha256\(([^()]*)\)")


def frame(spark: SparkSession, d: str, name: str, **written: DataFrame) -> DataFrame:
    """A stand-in of ``SHARED`` as a DataFrame; those that it needs are made again unless they are given as ``written``."""
    known = {**SHARED, **_BUILT}
    text = known[name]
    parts = {n: written[n] if n in written else frame(spark, d, n) if n in known else table(spark, d, n) for n in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(_SHA.sub(r"sha2(\1, 256)", text), **parts)


def cte(*names: str) -> str:
    """The stand-ins and those they need, as the body of a WITH clause."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        for n in re.findall(r"\{(\w+)\}", SHARED[name]):
            if n in SHARED:
                add(n)
        out.setdefault(name, f"{name} AS ({re.sub(r'[{}]', '', SHARED[name])})")

    for n in names:
        add(n)
    return ", ".join(out.values())


def proteins_in_blocks(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """(protein_id, label, unit, partition): orders as proteins, the segment of the customer as label, two customers as a block; with the columns ``more`` of orders."""
    # the unit and its digest are worked out once a customer
    unit = F.floor(F.col("c_custkey") / 2)
    customer = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("label"), unit.alias("unit"), partition_of(F.lit("GROUP"), unit.cast("string")).alias("partition"))
    return table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("protein_id"), "label", "unit", "partition", *more)


def members(spark: SparkSession, d: str, placed: DataFrame | None = None) -> DataFrame:
    """(comparison_id, partition, unit, protein_id, label, is_target): each segment is compared with one background. ``placed``: proteins in blocks, if they are written."""
    # the background stands in every comparison; there are as many as segments, which is a handful
    names = frame(spark, d, "comparisons").agg(F.collect_set("comparison_id").alias("_names"))
    target = F.col("label") != BACKGROUND
    placed = proteins_in_blocks(spark, d) if placed is None else placed
    rows = placed.select("protein_id", "label", "unit", "partition", target.alias("is_target")).crossJoin(F.broadcast(names))
    return rows.withColumn("comparison_id", F.explode(F.when(target, F.array("label")).when(~target, F.col("_names")))).drop("_names")


PARTS = """
    parts AS (SELECT o_orderkey AS protein_id, c_mktsegment AS label, floor(o_custkey / 2)::BIGINT AS unit,
        CASE WHEN ('0x' || substr(sha256('1729:GROUP:' || (floor(o_custkey / 2)::BIGINT)::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.2 THEN 'VALIDATION' ELSE 'DISCOVERY' END AS partition FROM orders JOIN customer ON o_custkey = c_custkey)"""
MEMBERS = f"""{PARTS}, {cte("comparisons")},
    members AS (SELECT p.*, c.comparison_id, p.label <> '{BACKGROUND}' AS is_target FROM parts p JOIN comparisons c ON p.label = c.comparison_id OR p.label = '{BACKGROUND}')"""
POSITIVES = cte("positives")


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """Documents as sequences: their letters in upper case without J."""
    letters = F.regexp_replace(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "J", "")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("protein_id"), letters.alias("sequence"), "lang", "source")
    return rows.filter(F.length("sequence") >= 3)


SEQUENCES = """
    sequences AS (SELECT * FROM (SELECT doc_id AS protein_id, replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'J', '') AS sequence, lang, source FROM documents) WHERE length(sequence) >= 3)"""
#: Which of the sequences are for discovery.
IS_DISCOVERY = "('0x' || substr(sha256('1729:PROTEIN:' || protein_id::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 >= 0.2"


def discovery_sequences(spark: SparkSession, d: str) -> DataFrame:
    return sequences(spark, d).filter(partition_of(F.lit("PROTEIN"), F.col("protein_id").cast("string")) == "DISCOVERY")


def domain_hits(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order as domain hits."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(F.col("l_orderkey").alias("protein_id"), F.col("l_returnflag").alias("authority"), F.col("p_brand").alias("domain_id"), F.col("l_linenumber").cast("long").alias("start"))


HITS = """
    hits AS (SELECT l_orderkey AS protein_id, l_returnflag AS authority, p_brand AS domain_id, l_linenumber::BIGINT AS start FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def search_hits(spark: SparkSession, d: str) -> DataFrame:
    """Lines as search hits: member order, seed supplier, score price, identity from the discount."""
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("member"), F.col("l_suppkey").alias("seed"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("bitscore"), (100 * (1 - F.col("l_discount"))).alias("identity"), F.col("l_linenumber").alias("line"))


SEARCH = """
    search AS (SELECT l_orderkey AS member, l_suppkey AS seed, l_partkey AS part, l_extendedprice AS bitscore, 100 * (1 - l_discount) AS identity, l_linenumber AS line FROM lineitem)"""


def aligned(spark: SparkSession, d: str) -> DataFrame:
    """Orders as rows of an alignment of 30 columns: date, status and priority, padded by gaps. Orders of a customer are a family."""
    written = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderstatus", "o_orderpriority")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("sequence_id"), F.col("o_custkey").alias("family"), F.rpad(written, 30, "-").alias("sequence"))


ALIGNED = """
    aligned AS (SELECT o_orderkey AS sequence_id, o_custkey AS family, rpad(strftime(o_orderdate, '%Y-%m-%d') || o_orderstatus || o_orderpriority, 30, '-') AS sequence FROM orders),
    residues AS (SELECT sequence_id, family, i AS col, substr(sequence, i, 1) AS residue FROM aligned, (SELECT unnest(range(1, 31)) AS i))"""
