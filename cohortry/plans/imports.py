"""Queries of scans, consolidation, families and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import blocks, checks, consolidation, families, reports, sequences
from cohortry.plans import bindings as B
from cohortry.plans.registry import query
from cohortry.plans.reports import r7
from cohortry.sinks import writers
from cohortry.sources import readers, scans
from cohortry.storage import materialize, new_path, table


# -- sequences -----------------------------------------------------------------------------------------------------


@query("src02_fasta_scan_strict", """
    WITH s AS (SELECT CASE WHEN doc_id % 50 = 0 THEN doc_id - doc_id % 100 ELSE doc_id END AS sequence_id, upper(regexp_replace(text,
    '[^A-Za-z]', '', 'g')) AS sequence FROM documents) SELECT sequence_id, CASE WHEN coalesce(sequence, '') = '' THEN 'EMPTY_SEQUENCE'
    WHEN NOT regexp_full_match(sequence, '[A-IK-Z]+') THEN 'BAD_RESIDUE' ELSE 'TOO_LONG' END AS problem
    FROM s WHERE coalesce(sequence, '') = '' OR NOT regexp_full_match(sequence, '[A-IK-Z]+') OR length(sequence) > 5000
    UNION ALL SELECT sequence_id, 'REPEATED_ID' FROM s GROUP BY 1
    HAVING count(*) > 1""")
def src02(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.when(F.col("doc_id") % 50 == 0, F.col("doc_id") - F.col("doc_id") % 100).otherwise(F.col("doc_id")).alias("sequence_id"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence"))
    return scans.strict_fasta_violations(rows, 5000)


@query("src26_aligned_fasta_scan", """
    WITH a AS (SELECT o_orderkey - o_orderkey % 9 // 8 AS sequence_id, rpad(translate(o_orderpriority, '0123456789 ', '-----------'),
    CASE WHEN o_orderkey % 100 = 99 THEN 29 ELSE 30 END, '-') AS sequence
    FROM orders), b AS (SELECT sequence_id, CASE WHEN sequence_id % 10 = 3 THEN repeat('-', length(sequence)) ELSE sequence END AS
    sequence FROM a) SELECT sequence_id, CASE WHEN NOT regexp_full_match(sequence, '[A-IK-Z-]+') THEN 'BAD_RESIDUE' ELSE 'ONLY_GAPS'
    END AS problem FROM b WHERE NOT regexp_full_match(sequence, '[A-IK-Z-]+') OR replace(sequence, '-', '') = ''
    UNION ALL SELECT sequence_id, 'REPEATED_ID' FROM b GROUP BY 1
    HAVING count(*) > 1 UNION ALL SELECT NULL, 'ROWS_OF_DIFFERENT_LENGTH'""")
def src26(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select((key - F.floor(key % 9 / 8)).alias("sequence_id"), F.rpad(F.translate("o_orderpriority", "0123456789 ", "-----------"), F.when(key % 100 == 99, 29).otherwise(30), F.lit("-")).alias("sequence"))
    return scans.alignment_violations(rows.withColumn("sequence", F.when(F.col("sequence_id") % 10 == 3, F.repeat(F.lit("-"), F.length("sequence"))).otherwise(F.col("sequence"))))


@query("src24_model_confidence_scan", "SELECT o_orderkey AS path, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE round((o_orderkey % 90 + 10) / 2e0 + o_custkey % 20 / 2e0, 7) END AS mean_confidence FROM orders")
def src24(spark: SparkSession, d: str) -> DataFrame:
    # two CA atoms of the first model, one of another place, one that is no CA, and one of a second model
    line = lambda name, alternate, value: F.concat(F.lit("ATOM      1 "), F.rpad(F.lit(f" {name}"), 4, " "), F.lit(f"{alternate}ALA A   1    "), F.lit(" " * 24), F.lit("  1.00"), F.lpad(F.format_string("%.2f", value), 6, " "), F.lit("\n"))
    first, second = (F.col("o_orderkey") % 90 + 10).cast("double"), (F.col("o_custkey") % 20).cast("double")
    some = F.concat(line("CA", " ", first), line("CA", "A", second), line("CA", "B", F.lit(99.0)), line("CB", " ", F.lit(98.0)), F.lit("ENDMDL\n"), line("CA", " ", F.lit(97.0)))
    files = table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.when(F.col("o_orderkey") % 10 == 0, "HEADER\n").otherwise(some).alias("content"))
    return r7(scans.mean_confidence(files), "mean_confidence")


@query("snk03_fasta_write", """
    SELECT o_orderkey AS protein_id, '>' || o_orderkey || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' ' || o_orderpriority END ||
    chr(10) || CASE WHEN length(s) <= 20 THEN s WHEN length(s) <= 40 THEN substr(s, 1, 20) || chr(10) || substr(s, 21) ELSE substr(s,
    1, 20) || chr(10) || substr(s, 21, 20) || chr(10) || substr(s, 41) END AS text
    FROM (SELECT *, repeat('ACDEF', (o_orderkey % 12 + 1)::INT) AS s
    FROM orders)""")
def snk03(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("description"), F.repeat(F.lit("ACDEF"), (F.col("o_orderkey") % 12 + 1).cast("int")).alias("sequence"))
    return writers.fasta_text(rows, 20)


@query("snk01_canonical_parquet_write", f"WITH {B.HITS} SELECT authority, count(*) AS rows, sum(start)::BIGINT AS starts FROM hits GROUP BY 1")
def snk01(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "canonical")
    writers.write_canonical(B.domain_hits(spark, d), ["protein_id", "authority", "domain_id", "start"], path, 5000)
    return spark.read.parquet(path).groupBy("authority").agg(F.count("*").alias("rows"), F.sum("start").alias("starts"))


@query("snk02_canonical_tsv_write", "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def snk02(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "tsv")
    writers.write_tsv(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"], path)
    return readers.read_tsv(spark, path, ["o_orderkey", "o_orderstatus", "o_orderpriority"]).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.col("o_orderkey").cast("long")).alias("keys"))


@query("snk02_sorted_tsv", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def snk02_sorted(spark: SparkSession, d: str) -> DataFrame:
    """Orders as one sorted table with one heading, read back."""
    path, names = new_path(spark, "sorted"), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    writers.write_tsv(table(spark, d, "orders"), names, path, order=["o_orderkey"])
    return readers.read_tsv(spark, path, names, one_heading=True)


@query("snk04_manifest_reconcile", """
    SELECT 'g' || c_custkey AS name, CASE WHEN c_custkey % 5 = 0 THEN 'MISSING' WHEN c_custkey % 5 = 1 THEN 'UNDECLARED' WHEN c_custkey
    % 5 = 2 THEN 'SIZE_DIFFERS' ELSE 'DIGEST_DIFFERS' END AS problem
    FROM customer WHERE c_custkey % 5 < 4""")
def snk04(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "customer").select(F.concat(F.lit("g"), "c_custkey").alias("name"), (F.col("c_custkey") % 5).alias("k"), F.sha2(F.col("c_name"), 256).alias("sha256"))
    declared = own.filter("k <> 1").select("name", F.lit(10).alias("size_bytes"), F.upper("sha256").alias("sha256"))
    found = own.filter("k <> 0").select("name", F.when(F.col("k") == 2, 11).otherwise(10).alias("size_bytes"), F.when(F.col("k") == 3, F.sha2("name", 256)).otherwise(F.col("sha256")).alias("sha256"))
    return writers.reconcile(declared, found)


@query("snk04_written_files", """
    SELECT DISTINCT l_returnflag AS authority, CASE l_returnflag WHEN 'A' THEN 'UNDECLARED' ELSE 'DIGEST_DIFFERS' END AS problem FROM lineitem WHERE l_returnflag IN ('A', 'N')
    UNION ALL SELECT 'none', 'MISSING'""")
def snk04_written(spark: SparkSession, d: str) -> DataFrame:
    """Files of hits by authority, with a manifest of whole-file digests: A's files are not declared, N's digests are wrong, R's are right, and one file is declared too many."""
    path = new_path(spark, "written")
    B.domain_hits(spark, d).write.partitionBy("authority").option("maxRecordsPerFile", 5000).parquet(path)
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = whole.select(F.concat_ws("/", F.element_at(F.split("path", "/"), -2), F.element_at(F.split("path", "/"), -1)).alias("name"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    authority = F.regexp_extract("name", "authority=([^/]*)/", 1)
    extra = spark.createDataFrame([("authority=none/x", 1, "")], names.schema)
    declared = names.filter(authority != "A").withColumn("sha256", F.when(authority == "N", F.sha2("sha256", 256)).otherwise(F.upper("sha256"))).unionByName(extra)
    found = writers.file_inventory(spark, path).filter(F.col("name").startswith("authority="))
    return writers.reconcile(declared, found).select(authority.alias("authority"), "problem").distinct()


@query("snk03_written_fasta", """
    SELECT o_orderkey::VARCHAR AS protein_id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS description, repeat('ACDEF', (o_orderkey % 12 + 1)::INT) AS sequence,
        5 * (o_orderkey % 12 + 1) AS sequence_length, sha256(repeat('ACDEF', (o_orderkey % 12 + 1)::INT)) AS sequence_sha256 FROM orders""")
def snk03_written(spark: SparkSession, d: str) -> DataFrame:
    """FASTA files of orders, written in order of id and read back."""
    path = new_path(spark, "fasta")
    description = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority"))
    sequence = F.repeat(F.lit("ACDEF"), (F.col("o_orderkey") % 12 + 1).cast("int"))
    writers.write_fasta(table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), description.alias("description"), sequence.alias("sequence")), path, 20)
    return readers.read_fasta(spark, path)


@query("src01_fasta_scan", f"""
    WITH {B.SEQUENCES}, s AS (SELECT protein_id, sequence, protein_id % 4 AS k FROM sequences WHERE length(sequence) > 0)
    SELECT 'P' || protein_id AS protein_id, CASE WHEN k < 2 THEN 'of ' || k ELSE '' END AS description, sequence, length(sequence) AS sequence_length, sha256(sequence) AS sequence_sha256 FROM s""")
def src01(spark: SparkSession, d: str) -> DataFrame:
    """Whole sequences as records with lower-case residues, blank lines and a terminal stop; the scan takes these away."""
    path, k = new_path(spark, "records"), F.col("protein_id") % 4
    rows = B.sequences(spark, d).filter(F.length("sequence") > 0)
    body = F.when(k == 0, F.lower("sequence")).when(k == 1, F.regexp_replace("sequence", "(.{60})", "$1\n")).when(k == 2, F.concat("sequence", F.lit("*"))).otherwise(F.concat(F.lit("\n"), "sequence", F.lit(" \n")))
    head = F.concat(F.lit(">P"), "protein_id", F.when(k < 2, F.concat(F.lit("  of "), k)).otherwise(""))
    rows.select(F.concat(head, F.lit("\n"), body)).write.text(path)
    return readers.read_fasta(spark, path)


@query("src03_tsv_scan", "SELECT l_orderkey::VARCHAR AS l_orderkey, CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END AS flag, l_partkey::VARCHAR AS l_partkey, count(*) AS n FROM lineitem GROUP BY ALL")
def src03(spark: SparkSession, d: str) -> DataFrame:
    """Lines as a TSV with blank cells, read back as text."""
    path, names = new_path(spark, "tsv"), ["l_orderkey", "flag", "l_partkey"]
    writers.write_tsv(table(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_linenumber") > 1, F.col("l_returnflag"))), names, path)
    return readers.read_tsv(spark, path, names).groupBy(*names).agg(F.count("*").alias("n"))


@query("set05_manifest_inventory_diff", """
    SELECT 'part' || c_custkey AS name, 'DECLARED_ONLY' AS side FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT DISTINCT 'extra' || o_custkey, 'FOUND_ONLY' FROM orders
    WHERE o_custkey % 10 = 0""")
def set05(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    declared = table(spark, d, "customer").select(F.concat(F.lit("part"), "c_custkey").alias("name"))
    found = orders.filter("o_orderstatus = 'F'").select(F.concat(F.lit("part"), "o_custkey").alias("name")).unionByName(orders.filter("o_custkey % 10 = 0").select(F.concat(F.lit("extra"), "o_custkey").alias("name")))
    return writers.inventory_difference(declared, found)


# -- tables of a cohort --------------------------------------------------------------------------------------------


@query("src04_label_scan", """
    WITH a AS (SELECT o_custkey AS protein_id, CASE WHEN o_orderkey % 20 = 0 THEN 'X' ELSE o_orderstatus END AS label_id, CASE WHEN
    o_orderkey % 30 = 1 THEN 'MAYBE' ELSE ' proposed' END AS curation_status
    FROM orders), p AS (SELECT c_custkey FROM customer WHERE c_custkey % 40 <> 7) SELECT protein_id, label_id, CASE WHEN protein_id NOT
    IN (SELECT c_custkey FROM p) THEN 'UNKNOWN_PROTEIN' WHEN label_id = 'X' THEN 'UNKNOWN_LABEL' ELSE 'UNKNOWN_STATUS' END AS problem
    FROM a WHERE protein_id NOT IN (SELECT c_custkey FROM p) OR label_id = 'X' OR curation_status = 'MAYBE'
    UNION ALL SELECT protein_id, label_id, 'REPEATED_ASSIGNMENT' FROM a
    GROUP BY 1, 2 HAVING count(*) > 1""")
def src04(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey")
    rows = orders.select(F.col("o_custkey").alias("protein_id"), F.when(key % 20 == 0, "X").otherwise(F.col("o_orderstatus")).alias("label_id"), F.when(key % 30 == 1, "MAYBE").otherwise(" proposed").alias("curation_status"))
    proteins = table(spark, d, "customer").filter("c_custkey % 40 <> 7").select(F.col("c_custkey").alias("protein_id"))
    return scans.label_violations(rows, proteins, orders.select(F.col("o_orderstatus").alias("label_id")).distinct())


_LEDGER = """a AS (SELECT l_orderkey AS protein_id, 'T' AS feature_type, p_brand AS feature_id, CASE WHEN l_partkey % 400 = 3 THEN 'other name' ELSE p_brand END AS feature_name, CASE WHEN l_linenumber <= 4 THEN l_linenumber END AS start, CASE WHEN l_linenumber <= 4 THEN l_linenumber + l_quantity::INT END AS stop,
        CASE WHEN l_linenumber = 4 THEN 'ASSESSED_NO_FEATURE' WHEN l_linenumber = 6 AND l_quantity > 48 THEN 'ODD' ELSE 'assessed_with_feature ' END AS evidence_status, CASE CAST(substr(p_brand, 7) AS INT) % 3 WHEN 0 THEN 'FIXED_EXTERNAL' WHEN 1 THEN 'DISCOVERY_DERIVED' ELSE 'SOME_SCOPE' END AS derivation_scope,
        CASE WHEN p_size = 9 THEN 'abc' ELSE sha256(p_brand) END AS d1, CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 0 AND p_size > 2 THEN '' ELSE sha256('cohort') END AS d2 FROM lineitem JOIN part ON l_partkey = p_partkey),
    j AS (SELECT a.*, upper(trim(evidence_status)) AS st, 20 + o_custkey % 30 AS len FROM a LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 50 <> 7) ON o_orderkey = protein_id)"""


@query("src05_feature_ledger_scan", f"""WITH {_LEDGER}, f AS (SELECT protein_id, feature_type, feature_id, CASE WHEN len IS NULL THEN 'UNKNOWN_PROTEIN' WHEN st NOT IN ('ASSESSED_WITH_FEATURE', 'ASSESSED_NO_FEATURE') THEN 'UNKNOWN_STATUS' WHEN start IS NOT NULL AND (start < 1 OR start > stop OR stop > len) THEN 'PLACE_OUTSIDE' WHEN start IS NOT NULL AND st <> 'ASSESSED_WITH_FEATURE' THEN 'PLACE_WITHOUT_FEATURE'
        WHEN derivation_scope = 'SOME_SCOPE' THEN 'UNKNOWN_SCOPE' WHEN NOT regexp_full_match(d1, '[0-9a-f]{{64}}') THEN 'BAD_DEFINITION_DIGEST' WHEN (derivation_scope = 'FIXED_EXTERNAL') <> (d2 = '') THEN 'BAD_COHORT_DIGEST' END AS problem FROM j)
    SELECT * FROM f WHERE problem IS NOT NULL UNION ALL SELECT NULL, feature_type, feature_id, 'SEVERAL_DEFINITIONS' FROM a GROUP BY 2, 3 HAVING count(DISTINCT (feature_name, derivation_scope, d1, d2)) > 1
    UNION ALL SELECT protein_id, feature_type, feature_id, 'SEVERAL_STATES' FROM j GROUP BY 1, 2, 3 HAVING count(DISTINCT st) > 1 UNION ALL SELECT protein_id, feature_type, feature_id, 'REPEATED_ROW' FROM a GROUP BY protein_id, feature_type, feature_id, start, stop HAVING count(*) > 1""")
def src05(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    number, line = F.substring("p_brand", 7, 3).cast("int"), F.col("l_linenumber")
    rows = lines.select(
        F.col("l_orderkey").alias("protein_id"), F.lit("T").alias("feature_type"), F.col("p_brand").alias("feature_id"), F.when(F.col("l_partkey") % 400 == 3, "other name").otherwise(F.col("p_brand")).alias("feature_name"), F.when(line <= 4, line).alias("start"), F.when(line <= 4, line + F.col("l_quantity").cast("int")).alias("stop"),
        F.when(line == 4, "ASSESSED_NO_FEATURE").when((line == 6) & (F.col("l_quantity") > 48), "ODD").otherwise("assessed_with_feature ").alias("evidence_status"), F.when(number % 3 == 0, "FIXED_EXTERNAL").when(number % 3 == 1, "DISCOVERY_DERIVED").otherwise("SOME_SCOPE").alias("derivation_scope"),
        F.when(F.col("p_size") == 9, "abc").otherwise(F.sha2("p_brand", 256)).alias("feature_definition_sha256"), F.when((number % 3 == 0) & (F.col("p_size") > 2), "").otherwise(F.sha2(F.lit("cohort"), 256)).alias("derivation_cohort_sha256"),
    )
    proteins = table(spark, d, "orders").filter("o_orderkey % 50 <> 7").select(F.col("o_orderkey").alias("protein_id"), (F.col("o_custkey") % 30 + 20).alias("sequence_length"))
    return scans.ledger_violations(rows, proteins)


_DOMAINS = """
    a AS (SELECT l_orderkey AS protein_id, l_returnflag AS domain_authority, CASE WHEN l_linenumber = 5 THEN 'ASSESSED_NO_HIT' WHEN
    l_linenumber = 6 AND l_quantity > 49 THEN 'ODD' ELSE 'ASSESSED_WITH_HIT' END AS assessment_status, CASE WHEN l_linenumber = 5 AND
    l_quantity < 40 THEN '' WHEN l_linenumber = 7 AND l_quantity > 45 THEN ' ' ELSE 'D' || l_partkey % 9 END AS domain_id, l_linenumber
    AS start, l_linenumber + l_quantity::INT AS stop FROM lineitem)"""


def _domains(spark: SparkSession, d: str) -> DataFrame:
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    status = F.when(line == 5, "ASSESSED_NO_HIT").when((line == 6) & (quantity > 49), "ODD").otherwise("ASSESSED_WITH_HIT")
    name = F.when((line == 5) & (quantity < 40), "").when((line == 7) & (quantity > 45), " ").otherwise(F.concat(F.lit("D"), F.col("l_partkey") % 9))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.col("l_returnflag").alias("domain_authority"), status.alias("assessment_status"), name.alias("domain_id"), line.alias("start"), (line + quantity.cast("int")).alias("stop"))


@query("src06_domain_scan", f"WITH {_DOMAINS} SELECT protein_id, domain_authority, min(assessment_status) AS assessment_status, count_if(trim(domain_id) <> '') AS hit_count FROM a GROUP BY 1, 2")
def src06(spark: SparkSession, d: str) -> DataFrame:
    return scans.split_domains(_domains(spark, d))[1]


@query("src06_domain_violations", f"""WITH {_DOMAINS}, j AS (SELECT a.*, 20 + o_custkey % 30 AS len, trim(domain_id) <> '' AS has FROM a LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 50 <> 7) ON o_orderkey = protein_id),
    f AS (SELECT protein_id, domain_authority, CASE WHEN len IS NULL THEN 'UNKNOWN_PROTEIN' WHEN assessment_status = 'ODD' THEN 'UNKNOWN_STATUS' WHEN assessment_status = 'ASSESSED_WITH_HIT' AND NOT has THEN 'HIT_WITHOUT_DOMAIN' WHEN assessment_status <> 'ASSESSED_WITH_HIT' AND has THEN 'DOMAIN_WITHOUT_HIT' WHEN has AND (start < 1 OR start > stop OR stop > len) THEN 'PLACE_OUTSIDE' END AS problem FROM j)
    SELECT * FROM f WHERE problem IS NOT NULL UNION ALL SELECT protein_id, domain_authority, 'SEVERAL_STATES' FROM a GROUP BY 1, 2 HAVING count(DISTINCT assessment_status) > 1 UNION ALL SELECT protein_id, domain_authority, 'REPEATED_HIT' FROM a WHERE trim(domain_id) <> '' GROUP BY protein_id, domain_authority, domain_id, start, stop HAVING count(*) > 1""")
def src06_violations(spark: SparkSession, d: str) -> DataFrame:
    proteins = table(spark, d, "orders").filter("o_orderkey % 50 <> 7").select(F.col("o_orderkey").alias("protein_id"), (F.col("o_custkey") % 30 + 20).alias("sequence_length"))
    return scans.domain_violations(_domains(spark, d), proteins)


_STRUCTURES = f"""
    {B.cte('structures')}, a AS (SELECT structure_id - structure_id % 60 // 59 AS structure_id, protein_id, CASE WHEN structure_id % 41
    = 3 THEN '' ELSE coordinate_path END AS coordinate_path, availability_status, CASE WHEN structure_id % 37 = 5 THEN 120e0 ELSE
    mean_confidence END AS mean_confidence, CASE WHEN structure_id % 43 = 6 THEN 'NOT_APPLICABLE_EXTERNAL_EVIDENCE' ELSE
    analysis_eligibility_status END AS analysis_eligibility_status, fold_evidence_status, CASE WHEN structure_id % 31 = 4 THEN 'Fx'
    ELSE fold_id END AS fold_id, fold_name, fold_authority, CASE WHEN structure_id % 997 = 8 AND fold_authority <> '' THEN '2023' ELSE
    fold_authority_version END AS fold_authority_version FROM structures)"""


@query("src07_structure_scan", f"""WITH {_STRUCTURES}, f AS (SELECT structure_id, CASE WHEN protein_id NOT IN (SELECT o_orderkey FROM orders) THEN 'UNKNOWN_PROTEIN' WHEN (coordinate_path <> '') <> (availability_status = 'AVAILABLE') THEN 'PATH_AND_STATUS_DIFFER' WHEN mean_confidence NOT BETWEEN 0 AND 100 THEN 'CONFIDENCE_OUT_OF_RANGE' WHEN analysis_eligibility_status = 'ELIGIBLE' AND coordinate_path = '' THEN 'ELIGIBLE_WITHOUT_FILE'
        WHEN analysis_eligibility_status = 'NOT_APPLICABLE_EXTERNAL_EVIDENCE' AND coordinate_path <> '' THEN 'EXTERNAL_WITH_FILE' WHEN analysis_eligibility_status = 'INELIGIBLE_COORDINATE_UNAVAILABLE' AND coordinate_path <> '' THEN 'UNAVAILABLE_WITH_FILE' WHEN analysis_eligibility_status = 'INELIGIBLE_LOW_CONFIDENCE' AND mean_confidence IS NULL THEN 'LOW_CONFIDENCE_WITHOUT_VALUE'
        WHEN analysis_eligibility_status = 'INELIGIBLE_CONFIDENCE_UNAVAILABLE' AND mean_confidence IS NOT NULL THEN 'NO_CONFIDENCE_WITH_VALUE' WHEN fold_evidence_status = 'ASSESSED_WITH_HIT' AND (fold_id = '' OR fold_authority = '' OR fold_authority_version = '') THEN 'HIT_WITHOUT_FOLD' WHEN fold_evidence_status <> 'ASSESSED_WITH_HIT' AND (fold_id <> '' OR fold_name <> '') THEN 'FOLD_WITHOUT_HIT'
        WHEN fold_evidence_status = 'ASSESSED_NO_HIT' AND (fold_authority = '' OR fold_authority_version = '') THEN 'ASSESSED_WITHOUT_AUTHORITY' WHEN fold_evidence_status = 'NOT_ASSESSED' AND (fold_authority <> '' OR fold_authority_version <> '') THEN 'AUTHORITY_WITHOUT_ASSESSMENT' END AS problem FROM a)
    SELECT * FROM f WHERE problem IS NOT NULL UNION ALL SELECT structure_id, 'REPEATED_ID' FROM a GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT structure_id, 'SEVERAL_RELEASES' FROM a WHERE fold_authority IN (SELECT fold_authority FROM a WHERE fold_authority <> '' GROUP BY 1 HAVING count(DISTINCT fold_authority_version) > 1)""")
def src07(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("structure_id")
    rows = B.frame(spark, d, "structures").withColumns({
        "coordinate_path": F.when(key % 41 == 3, "").otherwise(F.col("coordinate_path")), "mean_confidence": F.when(key % 37 == 5, 120.0).otherwise(F.col("mean_confidence")), "fold_id": F.when(key % 31 == 4, "Fx").otherwise(F.col("fold_id")),
        "analysis_eligibility_status": F.when(key % 43 == 6, "NOT_APPLICABLE_EXTERNAL_EVIDENCE").otherwise(F.col("analysis_eligibility_status")), "fold_authority_version": F.when((key % 997 == 8) & (F.col("fold_authority") != ""), "2023").otherwise(F.col("fold_authority_version")),
    }).withColumn("structure_id", key - F.floor(key % 60 / 59))
    return scans.structure_violations(materialize(rows, "structures"), table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id")))


@query("src08_structure_pair_scan", f"""
    WITH {B.cte('structure_comparisons')}, s AS (SELECT CASE WHEN protein_a_id % 2 = 0 THEN protein_b_id ELSE protein_a_id END AS x,
    CASE WHEN protein_a_id % 2 = 0 THEN protein_a_id ELSE protein_b_id END AS y, coverage_a, coverage_b, source_record_id
    FROM structure_comparisons) SELECT source_record_id, least(x, y) AS protein_a_id, greatest(x, y) AS protein_b_id, CASE WHEN x <= y
    THEN coverage_a ELSE coverage_b END AS coverage_a, CASE WHEN x <= y THEN coverage_b ELSE coverage_a END AS coverage_b
    FROM s""")
def src08(spark: SparkSession, d: str) -> DataFrame:
    even, rows = F.col("protein_a_id") % 2 == 0, B.frame(spark, d, "structure_comparisons")
    mixed = rows.select("source_record_id", F.when(even, F.col("protein_b_id")).otherwise(F.col("protein_a_id")).alias("protein_a_id"), F.when(even, F.col("protein_a_id")).otherwise(F.col("protein_b_id")).alias("protein_b_id"), "coverage_a", "coverage_b")
    return scans.canonical_comparisons(mixed)


@query("src08_comparison_violations", f"""WITH {B.cte('structure_comparisons')}, a AS (SELECT source_record_id, comparison_tool, protein_a_id, CASE WHEN protein_a_id % 90 = 4 THEN protein_a_id ELSE protein_b_id END AS protein_b_id, CASE WHEN protein_a_id % 70 = 5 THEN 'LOST' ELSE comparison_status END AS comparison_status, CASE WHEN protein_a_id % 60 = 6 THEN NULL WHEN protein_a_id % 60 = 7 THEN 3e0 ELSE tm_score END AS tm_score, coverage_a, CASE WHEN protein_a_id % 50 = 8 THEN 5e-1 ELSE coverage_b END AS coverage_b FROM structure_comparisons),
    f AS (SELECT source_record_id, CASE WHEN protein_a_id = protein_b_id THEN 'SELF_PAIR' WHEN protein_a_id NOT IN (SELECT o_orderkey FROM orders) OR protein_b_id NOT IN (SELECT o_orderkey FROM orders) THEN 'UNKNOWN_PROTEIN' WHEN comparison_status = 'LOST' THEN 'UNKNOWN_STATUS' WHEN comparison_status = 'COMPLETE' AND (tm_score IS NULL OR coverage_a IS NULL OR coverage_b IS NULL) THEN 'SUCCESS_WITHOUT_METRICS'
        WHEN comparison_status <> 'COMPLETE' AND (tm_score IS NOT NULL OR coverage_a IS NOT NULL OR coverage_b IS NOT NULL) THEN 'FAILURE_WITH_METRICS' WHEN coalesce(tm_score NOT BETWEEN 0 AND 1, false) THEN 'OUT_OF_RANGE' END AS problem FROM a)
    SELECT * FROM f WHERE problem IS NOT NULL UNION ALL SELECT source_record_id, 'REPEATED_RECORD' FROM a GROUP BY least(protein_a_id, protein_b_id), greatest(protein_a_id, protein_b_id), comparison_tool, source_record_id HAVING count(*) > 1""")
def src08_violations(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("protein_a_id")
    rows = B.frame(spark, d, "structure_comparisons").withColumns({
        "protein_b_id": F.when(a % 90 == 4, a).otherwise(F.col("protein_b_id")), "comparison_status": F.when(a % 70 == 5, "LOST").otherwise(F.col("comparison_status")), "tm_score": F.when(a % 60 == 6, None).when(a % 60 == 7, 3.0).otherwise(F.col("tm_score")), "coverage_b": F.when(a % 50 == 8, 0.5).otherwise(F.col("coverage_b")),
    })
    return scans.comparison_violations(rows, table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id")))


@query("src09_redundancy_scan", """
    WITH a AS (SELECT o_orderkey - o_orderkey % 25 // 24 AS protein_id, CASE WHEN o_custkey % 19 = 3 THEN NULL WHEN o_custkey % 19 = 4
    THEN 90e0 ELSE 9e-1 END AS i, CASE WHEN o_custkey % 23 = 5 THEN -1e0 ELSE 8e-1 END AS c
    FROM orders) SELECT protein_id, CASE WHEN protein_id % 80 = 9 THEN 'UNKNOWN_PROTEIN' WHEN i IS NULL OR i > 1 THEN 'BAD_IDENTITY'
    ELSE 'BAD_COVERAGE' END AS problem FROM a WHERE protein_id % 80 = 9 OR i IS NULL OR i > 1 OR c < 0
    UNION ALL SELECT protein_id, 'REPEATED_PROTEIN' FROM a GROUP BY 1
    HAVING count(*) > 1""")
def src09(spark: SparkSession, d: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    orders = table(spark, d, "orders")
    rows = orders.select((key - F.floor(key % 25 / 24)).alias("protein_id"), F.when(cust % 19 == 3, None).when(cust % 19 == 4, 90.0).otherwise(0.9).alias("identity_threshold"), F.when(cust % 23 == 5, -1.0).otherwise(0.8).alias("coverage_threshold"))
    return scans.redundancy_violations(rows, orders.filter("o_orderkey % 80 <> 9").select(key.alias("protein_id")))


@query("src10_accession_map_scan", "SELECT o_orderkey AS protein_id, 'P' || o_orderkey AS accession FROM orders")
def src10(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return scans.accession_map(orders.select(F.col("o_orderkey").alias("protein_id"), F.concat(F.lit(" p"), "o_orderkey").alias("accession")), orders.select(F.col("o_orderkey").alias("protein_id")))


@query("src12_member_alias_resolution", """
    SELECT m AS member, CASE WHEN o_orderkey % 6 < 5 THEN 'A' || o_orderkey END AS protein_id
    FROM (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN 'A' || o_orderkey WHEN 1 THEN 'x@@A' || o_orderkey WHEN 2 THEN 'sp|A' || o_orderkey
    || '|E' || o_orderkey WHEN 3 THEN 's@@tr|Q' || o_orderkey || '|A' || o_orderkey WHEN 4 THEN '0_' || o_orderkey ELSE 'x@@y@@A' ||
    o_orderkey END AS m FROM orders)""")
def src12(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    name = F.concat(F.lit("A"), key)
    member = F.when(key % 6 == 0, name).when(key % 6 == 1, F.concat(F.lit("x@@"), name)).when(key % 6 == 2, F.concat(F.lit("sp|"), name, F.lit("|E"), key)).when(key % 6 == 3, F.concat(F.lit("s@@tr|Q"), key, F.lit("|"), name)).when(key % 6 == 4, F.concat(F.lit("0_"), key)).otherwise(F.concat(F.lit("x@@y@@"), name))
    mapping = orders.filter("o_orderkey % 6 = 4").select(F.concat(F.lit("0_"), key).alias("internal"), F.concat(name, F.lit(" some words")).alias("original"))
    return families.resolve_members(orders.select(member.alias("member")), mapping, orders.select(name.alias("protein_id")))


@query("src13_resource_membership_scan", f"WITH {B.cte('group_memberships')} SELECT run_id, group_type, hierarchy_node, group_id, protein_id FROM group_memberships WHERE group_type = 'HOG' AND protein_id % 9 <> 2")
def src13(spark: SparkSession, d: str) -> DataFrame:
    rows = B.frame(spark, d, "group_memberships").withColumn("member", F.concat(F.lit("m"), "protein_id"))
    aliases = table(spark, d, "orders").select(F.concat(F.lit("m"), "o_orderkey").alias("member"), F.when(F.col("o_orderkey") % 9 != 2, F.col("o_orderkey")).alias("protein_id"))
    return scans.resource_members(rows.drop("protein_id"), aliases, "HOG", "N0")


@query("src14_group_context", f"""
    WITH {B.cte('group_memberships')}, s AS (SELECT 'RUN1' AS run_id, 'HOG' AS group_type, 'N0' AS hierarchy_node, 'HOG' || c_custkey
    AS group_id, c_acctbal AS mean_copies FROM customer) SELECT s.*, CASE WHEN c_custkey % 3 = 0 THEN 'DONE' ELSE '' END AS
    computation_status, CASE WHEN c_custkey % 3 = 0 THEN c_custkey / 1e1 END AS median_distance
    FROM s JOIN customer ON group_id = 'HOG' || c_custkey WHERE group_id IN (SELECT group_id
    FROM group_memberships WHERE group_type = 'HOG')""")
def src14(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer")
    key = [F.lit("RUN1").alias("run_id"), F.lit("HOG").alias("group_type"), F.lit("N0").alias("hierarchy_node"), F.concat(F.lit("HOG"), "c_custkey").alias("group_id")]
    distances = customer.filter("c_custkey % 3 = 0").select(*key, F.lit("DONE").alias("computation_status"), (F.col("c_custkey") / 10).alias("median_distance"))
    return scans.group_context(B.frame(spark, d, "group_memberships").filter("group_type = 'HOG'"), customer.select(*key, F.col("c_acctbal").alias("mean_copies")), distances)


@query("src15_structural_alignment_import", """
    SELECT 'K' || o_custkey AS comparison_universe_id, r AS protein_a_id, o_orderkey AS protein_b_id, 'US-align' AS comparison_tool,
    CASE WHEN o_orderkey % 5 = 0 THEN 'FAILED' ELSE 'COMPLETE' END AS comparison_status, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey %
    100 / 1e2 END AS tm_score, round(CASE WHEN o_orderkey % 5 > 0 THEN least(1, (o_orderkey % 90 + 30) / (50 + r % 40)) END, 7) AS
    coverage_a, round(CASE WHEN o_orderkey % 5 > 0 THEN least(1, (o_orderkey % 90 + 30) / (50 + o_orderkey % 40)) END, 7) AS coverage_b
    FROM (SELECT *, min(o_orderkey) OVER (PARTITION BY o_custkey) AS r
    FROM orders) WHERE r <> o_orderkey""")
def src15(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("r"), F.count("*").alias("n"))
    rows = orders.join(first, "o_custkey")
    own, failed = key == F.col("r"), key % 5 == 0
    alignments = rows.select(F.concat(F.lit("K"), "o_custkey").alias("cluster_id"), F.col("r").alias("reference_id"), key.alias("mobile_id"), F.lit("US-align").alias("alignment_tool"), F.when(own, "REFERENCE").when(failed, "FAILED").otherwise("COMPLETE").alias("status"), F.when(~own & ~failed, key % 90 + 30).alias("aligned_length"), F.when(own, 1.0).when(~failed, key % 100 / 100).alias("tm_score"))
    proteins = orders.select(key.alias("protein_id"), (key % 40 + 50).alias("sequence_length"))
    pairs, _ = scans.import_alignments(materialize(alignments, "alignments"), proteins, first.select(F.concat(F.lit("K"), "o_custkey").alias("cluster_id"), F.col("r").alias("reference_id"), F.col("n").alias("aligned_proteins")))
    return r7(pairs, "coverage_a", "coverage_b")


@query("src16_pocket_import", """
    WITH a AS (SELECT 'K' || l_suppkey AS k, l_orderkey AS r, l_orderkey + 1 AS m, l_returnflag AS tool, l_quantity > 25 AS p,
    l_discount > 0.05 AS c FROM lineitem WHERE l_linestatus = 'F' AND l_orderkey IN (SELECT o_orderkey
    FROM orders) AND l_orderkey + 1 IN (SELECT o_orderkey FROM orders)), f AS (SELECT *, 'SAME_3D_POCKET_POSITION' AS n
    FROM a WHERE p UNION ALL SELECT *, 'CONSERVED_3D_POCKET' FROM a
    WHERE c) SELECT DISTINCT unnest([r, m]) AS protein_id, 'STRUCTURAL_POCKET' AS feature_type, k || ':' || n AS feature_id,
    concat_ws('|', k, tool, r, m) AS evidence_reference FROM f""")
def src16(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    rows = lines.select(F.concat(F.lit("K"), "l_suppkey").alias("cluster_id"), F.col("l_returnflag").alias("alignment_tool"), F.col("l_orderkey").alias("reference_id"), (F.col("l_orderkey") + 1).alias("mobile_id"), F.when(F.col("l_linestatus") == "F", " assessed").otherwise("FAILED").alias("status"), (F.col("l_quantity") > 25).alias("same_position"), (F.col("l_discount") > 0.05).alias("conserved"))
    return scans.pocket_features(rows, table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id")))


@query("src17_group_summary_import", """
    SELECT 'K' || c_custkey AS cluster_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, '') AS alignment_tools,
    c_nationkey::BIGINT AS members, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS mean_score
    FROM customer""")
def src17(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(F.concat(F.lit("K"), "c_custkey").alias("cluster_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("alignment_tools"), F.col("c_nationkey").cast("string").alias("members"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal").cast("string")).alias("mean_score"))
    return scans.group_summaries(rows, ["cluster_id", "alignment_tools"], ["members"], ["mean_score"], ["cluster_id"])


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("src18_search_hit_reduce", f"""
    WITH h AS (
        SELECT *, l_orderkey % 200 AS q, l_suppkey AS t, (l_partkey % 100) / 1e2 AS qt, (l_orderkey % 100) / 1e2 AS tt, l_quantity::BIGINT AS al
        FROM lineitem WHERE l_orderkey % 200 <> l_suppkey
    ),
    p AS (SELECT *, least(q, t) AS a, greatest(q, t) AS b, least(qt, tt) AS tm, 20 + q % 30 AS ql, 20 + t % 30 AS tl FROM h),
    r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY tm DESC, {", ".join(_LINE)}) AS k FROM p)
    SELECT a AS protein_a_id, b AS protein_b_id, tm AS tm_score, round(least(1, al / CASE WHEN q <= t THEN ql ELSE tl END), 7) AS coverage_a,
        round(least(1, al / CASE WHEN q <= t THEN tl ELSE ql END), 7) AS coverage_b
    FROM r WHERE k = 1""")
def src18(spark: SparkSession, d: str) -> DataFrame:
    q, t = F.col("l_orderkey") % 200, F.col("l_suppkey")
    hits = table(spark, d, "lineitem").select(
        F.struct(*_LINE).alias("row"),
        q.alias("query_id"),
        t.alias("target_id"),
        (F.col("l_partkey") % 100 / 100).alias("query_tm"),
        (F.col("l_orderkey") % 100 / 100).alias("target_tm"),
        F.col("l_quantity").cast("long").alias("aligned"),
        (q % 30 + 20).alias("query_length"),
        (t % 30 + 20).alias("target_length"),
    )
    return r7(scans.reduce_hits(hits).drop("aligned"), "coverage_a", "coverage_b")


@query("src19_parquet_projected_scan", "SELECT o_orderkey, o_orderstatus, NULL::DOUBLE AS o_weight FROM orders")
def src19(spark: SparkSession, d: str) -> DataFrame:
    return scans.projected_scan(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus"], {"o_weight": "double"})


@query("src20_audit_scan_typed", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS score, event_id % 2 = 0 AS matched, event_type FROM events")
def src20(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.col("value").cast("string")).alias("score"), F.when(F.col("event_id") % 2 == 0, "True").otherwise("FALSE").alias("matched"), "event_type")
    return scans.typed_scan(text, {"event_id": "bigint", "score": "double", "matched": "boolean", "event_type": "string"})


@query("src21_cluster_export_import", f"WITH {B.SEQUENCES} SELECT DISTINCT protein_id AS sequence_id, sequence FROM sequences WHERE source = 'src3' UNION SELECT protein_id, sequence FROM sequences WHERE source <> 'src3'")
def src21(spark: SparkSession, d: str) -> DataFrame:
    rows = B.sequences(spark, d).withColumn("sequence", F.concat(F.lit(" "), F.lower("sequence"), F.lit("*")))
    return scans.import_cluster(rows.unionByName(rows), "protein_id", "sequence")[0]


_TABLE = """
    h AS (SELECT o_orderkey AS protein_id, 'PF' || lpad((o_custkey % 900)::VARCHAR, 5, '0') AS domain_id, o_custkey % 20 + 1 AS start,
    o_custkey % 20 + 11 AS stop FROM orders WHERE o_orderstatus <> 'P')"""


@query("src22_tool_annotation_scans", f"""
    WITH {_TABLE} SELECT protein_id, 'ASSESSED_WITH_HIT' AS assessment_status, domain_id, start, stop
    FROM h UNION ALL SELECT o_orderkey, 'ASSESSED_NO_HIT', NULL, NULL, NULL
    FROM orders WHERE o_orderstatus = 'P'""")
def src22(spark: SparkSession, d: str) -> DataFrame:
    orders, cust = table(spark, d, "orders"), F.col("o_custkey")
    fields = [F.lit("name"), F.concat(F.lit("PF"), F.lpad((cust % 900).cast("string"), 5, "0"), F.lit(".7")), F.lit("100"), F.col("o_orderkey"), *[F.lit("-")] * 13, cust % 20 + 1, cust % 20 + 11, F.lit("1"), F.lit("2"), F.lit("0.9"), F.lit("some words here")]
    lines = orders.filter("o_orderstatus <> 'P'").select(F.concat_ws("  ", *[f.cast("string") for f in fields]).alias("value")).unionByName(orders.limit(1).select(F.lit("# a remark").alias("value")))
    proteins = orders.select(F.col("o_orderkey").cast("string").alias("protein_id"), F.lit(40).alias("sequence_length"))
    return scans.domain_table(lines, proteins).select(F.col("protein_id").cast("long").alias("protein_id"), "assessment_status", "domain_id", "start", "stop")


@query("src22_domain_annotations", f"WITH {B.SEQUENCES} SELECT protein_id AS sequence_id, 'T' AS authority, 'A' || protein_id % 7 AS accession, 1 AS start, 3 AS stop FROM sequences")
def src22_domains(spark: SparkSession, d: str) -> DataFrame:
    rows = B.sequences(spark, d).select(F.col("protein_id").cast("string").alias("sequence_id"), "sequence")
    lines = rows.select(F.concat_ws("\t", "sequence_id", F.upper(F.md5(F.col("sequence").cast("binary"))), F.length("sequence").cast("string"), F.lit("T"), F.concat(F.lit("A"), F.col("sequence_id").cast("long") % 7), F.lit("what"), F.lit("1"), F.lit("3"), F.lit("0.5"), F.lit("T"), F.lit("today")).alias("value"))
    return scans.domain_annotations(lines, rows).select(F.col("sequence_id").cast("long").alias("sequence_id"), "authority", "accession", "start", "stop")


@query("src23_region_annotation_scan", 'SELECT c_mktsegment AS comparison_id, o_orderkey::VARCHAR AS protein_id, o_custkey % 9 + 1 AS start, o_custkey % 9 + 5 AS "end", o_orderstatus AS region_type, o_custkey % 100 / 1e2 AS q_value, o_custkey % 7 / 1e1 AS prevalence_difference FROM orders JOIN customer ON o_custkey = c_custkey')
def src23(spark: SparkSession, d: str) -> DataFrame:
    cust = F.col("o_custkey")
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), cust == F.col("c_custkey"))
    values = [F.col("c_mktsegment"), F.col("o_orderkey"), cust % 9 + 1, cust % 9 + 5, F.col("o_orderstatus"), F.col("o_orderkey"), cust % 100 / 100, cust % 7 / 10, F.lit("orders")]
    return scans.region_annotations(rows.select(*[v.cast("string").alias(c) for v, c in zip(values, scans.REGION_COLUMNS, strict=True)])).select("comparison_id", "protein_id", "start", "end", "region_type", "q_value", "prevalence_difference")


@query("src25_flexible_column_view", "SELECT o_orderkey AS sequence_id, o_custkey AS cluster_id, NULL::VARCHAR AS note FROM orders")
def src25(spark: SparkSession, d: str) -> DataFrame:
    return scans.flexible_columns(table(spark, d, "orders"), {"sequence_id": ("SEQID", "O_OrderKey"), "cluster_id": ("o_custkey", "f2"), "note": ("remark",)}, ["note"])


# -- consolidation ---------------------------------------------------------------------------------------------------


@query("agg14_sequence_consolidation", """
    WITH a AS (SELECT o_custkey AS protein_id, 'SEQ' || o_custkey AS sequence, o_orderpriority AS group_id, CASE WHEN o_orderkey % 3 =
    0 THEN '' ELSE o_orderstatus END AS species, CASE o_orderkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '0' WHEN 2 THEN NULL ELSE 'True' END
    AS cand FROM orders) SELECT protein_id, any_value(sequence) AS sequence, length(any_value(sequence)) AS sequence_length,
    sha256(any_value(sequence)) AS sequence_sha256, string_agg(DISTINCT group_id, '|'
    ORDER BY group_id) AS group_id, coalesce(string_agg(DISTINCT nullif(species, ''), '|'
    ORDER BY nullif(species, '')), '') AS species, string_agg(DISTINCT CASE cand WHEN 'yes' THEN 'TRUE' WHEN 'True' THEN 'TRUE' WHEN
    '0' THEN 'FALSE' ELSE 'UNKNOWN' END, '|' ORDER BY CASE cand WHEN 'yes' THEN 'TRUE' WHEN 'True' THEN 'TRUE' WHEN '0' THEN 'FALSE'
    ELSE 'UNKNOWN' END) AS flag_states FROM a GROUP BY 1""")
def agg14(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("protein_id"), F.concat(F.lit(" seq"), "o_custkey").alias("sequence"), F.col("o_orderpriority").alias("group_id"), F.when(key % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("species"), F.when(key % 4 == 0, "yes").when(key % 4 == 1, "0").when(key % 4 == 3, "True").alias("cand"))
    return consolidation.consolidate_sequences(rows, ["group_id", "species"], "cand")


@query("agg15_domain_consolidation", """WITH h AS (SELECT l_orderkey AS protein_id, CASE WHEN l_linenumber < 4 THEN 'Pfam' ELSE 'Other' END AS db, 'PF' || l_partkey % 90 AS domain_id, l_returnflag AS family, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus ELSE '' END AS role FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
    g AS (SELECT protein_id, count_if(db = 'Pfam') AS n, coalesce(string_agg(DISTINCT CASE WHEN db = 'Pfam' THEN domain_id END, '|' ORDER BY CASE WHEN db = 'Pfam' THEN domain_id END), '') AS domains, string_agg(DISTINCT family, '|' ORDER BY family) AS families, coalesce(string_agg(DISTINCT nullif(role, ''), '|' ORDER BY nullif(role, '')), '') AS roles FROM h GROUP BY 1)
    SELECT o_orderkey AS protein_id, CASE WHEN coalesce(n, 0) > 0 THEN 'ASSESSED_WITH_HIT' WHEN o_orderstatus <> 'P' THEN 'ASSESSED_NO_HIT' ELSE 'NOT_ASSESSED' END AS assessment_status, coalesce(domains, '') AS domains, coalesce(families, '') AS families, coalesce(roles, '') AS roles, o_orderpriority AS details FROM orders LEFT JOIN g ON protein_id = o_orderkey""")
def agg15(spark: SparkSession, d: str) -> DataFrame:
    orders, line = table(spark, d, "orders"), F.col("l_linenumber")
    hits = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.when(line < 4, "Pfam").otherwise("Other").alias("source_database"), F.concat(F.lit("PF"), F.col("l_partkey") % 90).alias("domain_id"), F.lit("").alias("domain_name"), line.alias("start"), (line + 5).alias("stop"), F.lit(1.0).alias("score"), F.col("l_returnflag").alias("family"), F.when(line % 2 == 0, F.col("l_linestatus")).otherwise("").alias("role"))
    summaries = orders.select(F.col("o_orderkey").alias("protein_id"), F.when(F.col("o_orderstatus") != "P", "available ").otherwise("none").alias("availability"), F.lit(0).alias("declared_hits"), F.col("o_orderpriority").alias("detail"))
    return consolidation.consolidate_domains(orders.select(F.col("o_orderkey").alias("protein_id"), F.lit(50).alias("sequence_length")), hits, summaries)[1]


@query("agg16_structure_consolidation", """
    WITH a AS (SELECT l_orderkey AS protein_id, min('dir' || l_linenumber || '/m' || l_orderkey || '.pdb') AS coordinate_path,
    sha256('model ' || l_orderkey) AS coordinate_sha256 FROM lineitem
    WHERE l_linenumber < 5 AND l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey) SELECT protein_id, 'WF_' || substr(sha256(protein_id || chr(9) || coordinate_sha256), 1, 24) AS structure_id,
    coordinate_path, coordinate_sha256, CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey * 37 % 1000 / 1e1 END AS mean_confidence, CASE
    WHEN o_orderkey % 9 = 0 THEN 'INELIGIBLE_CONFIDENCE_UNAVAILABLE' WHEN o_orderkey * 37 % 1000 / 1e1 < 70 THEN
    'INELIGIBLE_LOW_CONFIDENCE' ELSE 'ELIGIBLE' END AS analysis_eligibility_status
    FROM a JOIN orders ON o_orderkey = protein_id""")
def agg16(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    assets = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("protein_id"), F.concat(F.lit("dir"), "l_linenumber", F.lit("/m"), "l_orderkey", F.when(F.col("l_linenumber") < 5, ".pdb").otherwise(".json")).alias("path"), F.upper(F.sha2(F.concat(F.lit("model "), "l_orderkey"), 256)).alias("sha256"))
    quality = orders.select(key.alias("protein_id"), F.when(key % 9 > 0, key * 37 % 1000 / 10).alias("mean_confidence"))
    return consolidation.consolidate_structures(assets, quality, orders.select(key.alias("protein_id")))


_SOURCES = """
    s1 AS (SELECT DISTINCT l_orderkey AS protein_id, p_brand AS feature_id, 'A' AS src, CASE WHEN l_orderkey % 4 = 0 THEN 'FAILED' ELSE
    'DERIVED' END AS evidence_status FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_returnflag = 'A'), s2 AS (SELECT DISTINCT l_orderkey AS protein_id, p_brand AS feature_id, 'N' AS src, CASE WHEN l_orderkey
    % 5 = 0 THEN 'not_assessed' ELSE 'DERIVED' END AS evidence_status
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N')"""


@query("set01_feature_merge", f"""
    WITH {_SOURCES}, u AS (SELECT *, 0 AS k FROM s1 UNION ALL SELECT *, 1
    FROM s2) SELECT protein_id, feature_id, arg_max(src, k) AS src, arg_max(evidence_status, k) AS evidence_status
    FROM u WHERE upper(evidence_status) NOT IN ('FAILED', 'NOT_ASSESSED', 'INPUT_UNAVAILABLE', 'EXCLUDED')
    GROUP BY 1, 2""")
def set01(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    one = lambda flag, n, bad: lines.filter(F.col("l_returnflag") == flag).select(F.col("l_orderkey").alias("protein_id"), F.col("p_brand").alias("feature_id"), F.lit(flag).alias("src"), F.when(F.col("l_orderkey") % n == 0, bad).otherwise("DERIVED").alias("evidence_status")).distinct()
    return consolidation.merge_features([one("A", 4, "FAILED"), one("N", 5, "not_assessed")], ["protein_id", "feature_id"])


@query("set02_structure_merge", f"WITH {B.cte('structures')} SELECT structure_id, structure_source FROM structures")
def set02(spark: SparkSession, d: str) -> DataFrame:
    rows = B.frame(spark, d, "structures").select("structure_id", "structure_source")
    return consolidation.merge_unique([rows.filter("structure_id % 2 = 0"), rows.filter("structure_id % 2 = 1")], ["structure_id"], "structures in two sources")


@query("set03_complete_domain_assessments", f"""
    WITH {B.HITS}, k AS (SELECT DISTINCT protein_id, authority FROM hits
    WHERE start <= 2) SELECT o_orderkey AS protein_id, a.authority AS domain_authority, CASE WHEN k.protein_id IS NULL THEN
    'NOT_ASSESSED' ELSE 'ASSESSED_WITH_HIT' END AS assessment_status
    FROM orders CROSS JOIN (SELECT DISTINCT authority FROM k) a LEFT
    JOIN k ON k.protein_id = o_orderkey AND k.authority = a.authority""")
def set03(spark: SparkSession, d: str) -> DataFrame:
    known = B.domain_hits(spark, d).filter("start <= 2").select("protein_id", F.col("authority").alias("domain_authority"), F.lit("ASSESSED_WITH_HIT").alias("assessment_status")).distinct()
    return consolidation.complete_assessments(table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id")), known)


@query("prj04_acquisition_outcome", """
    WITH a AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN NULL ELSE 200 END AS h, CASE
    o_custkey % 5 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS m, CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey * 37 % 1000 / 1e1
    END AS c FROM orders), s AS (SELECT o_orderkey, CASE WHEN h = 404 THEN 'MODEL_NOT_AVAILABLE' WHEN h IS NULL OR h <> 200 THEN
    'FAILED' WHEN NOT m THEN 'SEQUENCE_MISMATCH' WHEN m IS NULL THEN 'ACQUIRED_SEQUENCE_UNVERIFIED' WHEN c IS NULL THEN
    'ACQUIRED_CONFIDENCE_UNAVAILABLE' WHEN c < 70 THEN 'ACQUIRED_LOW_CONFIDENCE' ELSE 'ACQUIRED' END AS acquisition_status
    FROM a) SELECT *, CASE acquisition_status WHEN 'ACQUIRED' THEN 'ELIGIBLE' WHEN 'ACQUIRED_LOW_CONFIDENCE' THEN
    'INELIGIBLE_LOW_CONFIDENCE' WHEN 'ACQUIRED_CONFIDENCE_UNAVAILABLE' THEN 'INELIGIBLE_CONFIDENCE_UNAVAILABLE' WHEN
    'ACQUIRED_SEQUENCE_UNVERIFIED' THEN 'INELIGIBLE_SEQUENCE_UNVERIFIED' WHEN 'SEQUENCE_MISMATCH' THEN 'INELIGIBLE_SEQUENCE_MISMATCH'
    ELSE 'INELIGIBLE_COORDINATE_UNAVAILABLE' END AS analysis_eligibility_status
    FROM s""")
def prj04(spark: SparkSession, d: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, d, "orders").select(key, F.when(key % 10 == 0, 404).when(key % 10 == 1, 500).when(key % 10 > 2, 200).alias("http_status"), F.when(cust % 5 == 0, False).when(cust % 5 > 1, True).alias("sequence_match"), F.when(key % 7 > 0, key * 37 % 1000 / 10).alias("mean_confidence"))
    return consolidation.acquisition_outcome(rows).select("o_orderkey", "acquisition_status", "analysis_eligibility_status")


@query("prj13_canonical_projection", f"""
    WITH {B.HITS} SELECT protein_id, string_agg(DISTINCT domain_id, '|'
    ORDER BY domain_id) AS domain_ids, coalesce(CASE WHEN protein_id % 2 = 0 THEN 'p' || protein_id END, '') AS path
    FROM hits GROUP BY 1""")
def prj13(spark: SparkSession, d: str) -> DataFrame:
    rows = B.domain_hits(spark, d).groupBy("protein_id").agg(F.array_sort(F.collect_set("domain_id")).alias("domain_ids")).withColumn("path", F.when(F.col("protein_id") % 2 == 0, F.concat(F.lit("p"), "protein_id")))
    return consolidation.canonical_projection(rows, ["protein_id", "domain_ids", "path"], ["domain_ids"], ["path"])


@query("fea02_domain_features", f"""
    WITH {B.HITS} SELECT protein_id, CASE WHEN authority = 'A' THEN 'PFAM_DOMAIN' ELSE 'DOMAIN' END AS feature_type, CASE WHEN
    authority = 'A' THEN 'Pfam' ELSE authority END || ':' || domain_id AS feature_id, start, start + 4 AS stop
    FROM hits""")
def fea02(spark: SparkSession, d: str) -> DataFrame:
    return consolidation.domain_features(_hits(spark, d))


def _hits(spark: SparkSession, d: str) -> DataFrame:
    rows = B.domain_hits(spark, d)
    return rows.select("protein_id", F.when(F.col("authority") == "A", "Pfam").otherwise(F.col("authority")).alias("domain_authority"), "domain_id", "start", (F.col("start") + 4).alias("stop"))


@query("fea03_domain_architecture", f"""
    WITH {B.HITS} SELECT protein_id, CASE WHEN authority = 'A' THEN 'Pfam' ELSE authority END AS domain_authority,
    string_agg(domain_id, '>' ORDER BY start, domain_id) AS architecture
    FROM (SELECT DISTINCT * FROM hits) GROUP BY 1, 2""")
def fea03(spark: SparkSession, d: str) -> DataFrame:
    return consolidation.domain_architecture(_hits(spark, d))


@query("fea04_domain_sequences", f"WITH {B.SEQUENCES} SELECT protein_id, substr(sequence, (protein_id % 50 + 1)::INT, 20) AS domain_sequence FROM sequences")
def fea04(spark: SparkSession, d: str) -> DataFrame:
    rows = B.sequences(spark, d)
    hits = rows.select("protein_id", F.lit("A").alias("domain_authority"), F.lit("D").alias("domain_id"), (F.col("protein_id") % 50 + 1).alias("start"), (F.col("protein_id") % 50 + 20).alias("stop"))
    return consolidation.domain_sequences(hits, rows).select("protein_id", "domain_sequence")


# -- families ----------------------------------------------------------------------------------------------------------


@query("jon11_id_resolution", """WITH a AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'S' || o_orderkey WHEN 1 THEN 'sp|S' || o_orderkey || '|E' WHEN 2 THEN 'old' || o_orderkey WHEN 3 THEN 'none' || o_orderkey ELSE o_orderkey::VARCHAR END AS input_id FROM orders),
    m AS (SELECT *, CASE WHEN o_orderkey % 5 = 3 THEN NULL ELSE 'S' || o_orderkey END AS sid, 'C' || o_orderkey % 40 AS c FROM a) SELECT input_id, sid AS alias, sid AS sequence_id, CASE WHEN sid IS NOT NULL THEN c END AS cluster_id, CASE WHEN sid IS NOT NULL AND o_orderkey % 40 < 30 THEN o_orderkey % 40 + 1 END AS member_count, CASE WHEN sid IS NULL THEN NULL WHEN o_orderkey % 5 = 2 THEN 'DECLARED_BRIDGE' ELSE 'EXACT_ALIAS' END AS mapping_evidence,
        CASE WHEN sid IS NULL THEN 'UNMATCHED' WHEN o_orderkey % 40 < 30 THEN 'MAPPED' ELSE 'MAPPED_UNINDEXED' END AS status FROM m""")
def jon11(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    name = F.concat(F.lit("S"), key)
    inputs = orders.select(F.when(key % 5 == 0, name).when(key % 5 == 1, F.concat(F.lit("sp|"), name, F.lit("|E"))).when(key % 5 == 2, F.concat(F.lit("old"), key)).when(key % 5 == 3, F.concat(F.lit("none"), key)).otherwise(key.cast("string")).alias("input_id"))
    clusters = spark.range(30).select(F.concat(F.lit("C"), "id").alias("cluster_id"), (F.col("id") + 1).alias("member_count"))
    bridge = orders.select(F.concat(F.lit("old"), key).alias("input_id"), name.alias("sequence_id"))
    return families.resolve_ids(inputs, orders.select(name.alias("sequence_id"), F.concat(F.lit("C"), key % 40).alias("cluster_id")), clusters, ["S"], bridge)


@query("jon12_cluster_retrieval", "SELECT o_orderkey AS sequence_id, o_custkey AS cluster_id FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey < 5)")
def jon12(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("sequence_id"), F.col("o_custkey").alias("cluster_id"))
    wanted = [r["cluster_id"] for r in rows.filter("sequence_id < 5").select("cluster_id").distinct().collect()]  # the clusters that are asked for
    return families.retrieve_clusters(rows, rows.groupBy("cluster_id").agg(F.count("*").alias("member_count")), wanted)


@query("jon13_representative_hits", f"""
    WITH {B.SEARCH} SELECT member, seed, line, bitscore, CASE WHEN o_orderkey IS NULL THEN 'HIT_UNINDEXED' ELSE 'HIT_INDEXED' END AS
    status FROM search LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON member = o_orderkey""")
def jon13(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("member"), F.lit(True).alias("there"))
    rows = B.search_hits(spark, d).join(index, "member", "left").select("member", "seed", "line", "bitscore", F.when(F.col("there"), "HIT_INDEXED").otherwise("HIT_UNINDEXED").alias("status"))
    return rows.orderBy(F.desc("bitscore"), "member", "seed", "line")


_SCREEN = f"""
    {B.SEARCH}, fam AS (SELECT o_orderkey AS sequence_id, o_custkey % 300 AS sequence_sha256, o_orderstatus
    FROM orders), h AS (SELECT member AS sequence_id, seed, bitscore
    FROM search WHERE identity >= 95), best AS (SELECT sequence_id, arg_min(seed, (-bitscore, seed)) AS best_seed_id
    FROM h GROUP BY 1)"""


@query("jon14_candidate_screen_audit", f"""
    WITH {_SCREEN}, ok AS (SELECT b.*, f.sequence_sha256 FROM best b
    JOIN fam f USING (sequence_id) WHERE o_orderstatus <> 'P'), first AS (SELECT sequence_sha256, min(sequence_id) AS kept
    FROM ok GROUP BY 1) SELECT f.sequence_id, ok.best_seed_id, CASE WHEN ok.sequence_id = first.kept THEN 'SELECTED' WHEN
    ok.sequence_id IS NOT NULL THEN 'EXACT_SEQUENCE_DUPLICATE' WHEN best.sequence_id IS NOT NULL THEN 'TAXONOMY_FILTERED_OR_UNKNOWN'
    ELSE 'NO_RETAINED_HIT' END AS selection_status FROM fam f LEFT
    JOIN best USING (sequence_id) LEFT JOIN ok ON ok.sequence_id = f.sequence_id
    LEFT JOIN first ON first.sequence_sha256 = f.sequence_sha256""")
def jon14(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    family = orders.select(F.col("o_orderkey").alias("sequence_id"), (F.col("o_custkey") % 300).alias("sequence_sha256"))
    hits = B.search_hits(spark, d).filter("identity >= 95").select(F.col("member").alias("sequence_id"), F.col("seed").alias("seed_id"), "bitscore")
    return families.screen_audit(family, hits, orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("sequence_id")))


@query("win03_best_hit_dedupe", f"""
    WITH {_SCREEN}, ok AS (SELECT b.*, f.sequence_sha256 FROM best b
    JOIN fam f USING (sequence_id)) SELECT min(sequence_id) AS sequence_id, arg_min(best_seed_id, sequence_id) AS best_seed_id
    FROM ok GROUP BY sequence_sha256""")
def win03(spark: SparkSession, d: str) -> DataFrame:
    family = table(spark, d, "orders").select(F.col("o_orderkey").alias("sequence_id"), (F.col("o_custkey") % 300).alias("sequence_sha256"))
    hits = B.search_hits(spark, d).filter("identity >= 95").select(F.col("member").alias("sequence_id"), F.col("seed").alias("seed_id"), "bitscore")
    return families.screen_audit(family, hits).filter("selection_status = 'SELECTED'").select("sequence_id", "best_seed_id")


@query("jon15_hit_threshold_filter", """
    WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, 100 * (1 - l_discount) AS pident, l_tax AS evalue, l_linenumber AS qstart,
    l_linenumber + l_quantity::INT - 1 AS qend, 60 AS qlen, 1 AS sstart, l_quantity::INT AS send, 55 AS slen
    FROM lineitem), c AS (SELECT *, 100 * (abs(qend - qstart) + 1) / qlen AS q, 100 * (abs(send - sstart) + 1) / slen AS s
    FROM h) SELECT l_orderkey, l_linenumber, l_partkey, round(q, 7) AS query_coverage, round(s, 7) AS subject_coverage
    FROM c WHERE pident >= 92.5 AND q >= 50 AND s >= 50 AND evalue <= 0.05""")
def jon15(spark: SparkSession, d: str) -> DataFrame:
    line, n = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    hits = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_tax").alias("evalue"), line.alias("qstart"), (line + n - 1).alias("qend"), F.lit(60).alias("qlen"), F.lit(1).alias("sstart"), n.alias("send"), F.lit(55).alias("slen"))
    return r7(families.threshold_hits(hits, 92.5, 50, 0.05).select("l_orderkey", "l_linenumber", "l_partkey", "query_coverage", "subject_coverage"), "query_coverage", "subject_coverage")


_CONTEXT = """
    ctx AS (SELECT o_orderkey AS sequence_id, CASE WHEN o_orderkey % 50 = 3 THEN 'bad' WHEN o_orderkey % 4 = 0 THEN sha256('old ' ||
    o_orderkey) ELSE sha256('seq ' || o_orderkey) END AS sequence_sha256, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'G' || o_custkey %
    30 END AS source_group, CASE WHEN o_orderkey % 60 = 1 THEN '0x' WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_custkey % 90 +
    1)::VARCHAR END AS reviewed_taxon_id FROM orders), seqs AS (SELECT o_orderkey AS sequence_id, sha256('seq ' || o_orderkey) AS
    sequence_sha256 FROM orders WHERE o_orderstatus <> 'P')"""


def _context(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    now, old = F.sha2(F.concat(F.lit("seq "), key), 256), F.sha2(F.concat(F.lit("old "), key), 256)
    context = orders.select(key.alias("sequence_id"), F.when(key % 50 == 3, "bad").when(key % 4 == 0, old).otherwise(now).alias("sequence_sha256"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("G"), F.col("o_custkey") % 30)).alias("source_group"), F.when(key % 60 == 1, "0x").when(key % 3 != 0, (F.col("o_custkey") % 90 + 1).cast("string")).alias("reviewed_taxon_id"))
    return context, orders.filter("o_orderstatus <> 'P'").select(key.alias("sequence_id"), now.alias("sequence_sha256"))


@query("jon16_context_carry", f"WITH {_CONTEXT} SELECT c.* FROM ctx c JOIN seqs USING (sequence_id, sequence_sha256)")
def jon16(spark: SparkSession, d: str) -> DataFrame:
    return families.carry_context(*_context(spark, d))


@query("val13_context_check", f"""
    WITH {_CONTEXT}, b AS (SELECT * FROM ctx UNION ALL SELECT * FROM ctx
    WHERE sequence_id % 70 = 2) SELECT sequence_id, CASE WHEN NOT regexp_full_match(sequence_sha256, '[0-9a-f]{{64}}') THEN
    'BAD_DIGEST' ELSE 'BAD_TAXON' END AS problem FROM b WHERE NOT regexp_full_match(sequence_sha256, '[0-9a-f]{{64}}') OR NOT
    regexp_full_match(coalesce(reviewed_taxon_id, '1'), '[1-9][0-9]*')
    UNION ALL SELECT sequence_id, 'REPEATED_ID' FROM b GROUP BY 1
    HAVING count(*) > 1""")
def val13(spark: SparkSession, d: str) -> DataFrame:
    context = _context(spark, d)[0]
    return families.context_violations(context.unionByName(context.filter("sequence_id % 70 = 2")))


@query("agg43_context_summary", f"""
    WITH {_CONTEXT}, m AS (SELECT c.* FROM ctx c JOIN seqs USING (sequence_id, sequence_sha256)) SELECT (SELECT
    string_agg(source_group, '|' ORDER BY source_group) FROM (SELECT DISTINCT source_group
    FROM m WHERE source_group <> '' ORDER BY 1 LIMIT 12)) AS source_groups, (SELECT count(*)
    FROM m) AS matched_rows, (SELECT count(*) FROM seqs) AS output_sequences""")
def agg43(spark: SparkSession, d: str) -> DataFrame:
    return families.context_summary(*_context(spark, d))


@query("jon28_context_for_alignment", "SELECT o_orderkey AS sequence_id, sha256(replace(o_orderpriority, '-', '') || o_orderkey) AS sequence_sha256 FROM orders WHERE o_orderkey % 3 = 0")
def jon28(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    aligned = orders.select(key.alias("sequence_id"), F.concat(F.lit("--"), "o_orderpriority", F.lit("-"), key, F.lit("---")).alias("sequence"))
    own = F.concat(F.regexp_replace("o_orderpriority", "-", ""), key)
    context = orders.select(key.alias("sequence_id"), F.sha2(F.when(key % 3 == 0, own).otherwise(F.concat("o_orderpriority", F.lit("-"), key)), 256).alias("sequence_sha256"))
    return families.aligned_context(context, aligned)


@query("jon17_hog_members", f"""
    WITH {B.cte('group_memberships')} SELECT protein_id, species_label, CASE WHEN o_orderstatus <> 'P' THEN 'SEQ' || protein_id END AS
    sequence FROM group_memberships JOIN orders ON o_orderkey = protein_id
    WHERE group_type = 'OG' AND group_id = 'OG5'""")
def jon17(spark: SparkSession, d: str) -> DataFrame:
    proteins = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("protein_id"), F.concat(F.lit("SEQ"), "o_orderkey").alias("sequence"))
    return families.group_members(B.frame(spark, d, "group_memberships"), proteins, {"run_id": "RUN1", "group_type": "OG", "hierarchy_node": "", "group_id": "OG5"}, cap=2_000_000_000)


@query("jon17_hog_search", f"WITH {B.cte('group_memberships')} SELECT DISTINCT group_id, run_id, hierarchy_node FROM group_memberships WHERE group_type = 'HOG' AND contains(lower(group_id), 'og12') ORDER BY 1 LIMIT 50")
def jon17_search(spark: SparkSession, d: str) -> DataFrame:
    return families.search_groups(B.frame(spark, d, "group_memberships"), " Og12")


@query("jon18_hog_snapshot", """
    WITH o AS (SELECT *, o_orderkey % 4 AS k, o_custkey % 6 AS s FROM orders
    WHERE o_orderstatus <> 'P') SELECT o_orderkey AS protein_id, sha256('SEQ' || o_orderkey) AS sequence_sha256, 'L' || s AS
    released_species, CASE WHEN k = 0 AND s > 1 THEN NULL WHEN k = 0 THEN 'by id' WHEN s > 1 THEN 'by label ' || s END AS
    reviewed_species, CASE WHEN k = 0 AND s > 1 THEN NULL WHEN k = 0 THEN 1 WHEN s > 1 THEN s END AS reviewed_taxon_id
    FROM o""")
def jon18(spark: SparkSession, d: str) -> DataFrame:
    orders, key, s = table(spark, d, "orders"), F.col("o_orderkey"), F.col("o_custkey") % 6
    members = orders.select(key.alias("protein_id"), F.concat(F.lit("L"), s).alias("species_label"), F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("SEQ"), key)).alias("sequence"))
    by_id = orders.filter("o_orderkey % 4 = 0").select(key.alias("sequence_id"), F.lit("by id").alias("reviewed_species"), F.lit(1).cast("long").alias("reviewed_taxon_id"))
    by_label = orders.select(s.alias("s")).distinct().filter("s > 1").select(F.concat(F.lit("L"), "s").alias("released_species"), F.concat(F.lit("by label "), "s").alias("reviewed_species"), F.col("s").alias("reviewed_taxon_id"))
    return families.group_snapshot(members, by_id, by_label)


@query("jon26_prior_pairs_compare", """
    SELECT 'r' || l_suppkey AS reference_model_sha256, 'm' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS
    mobile_model_sha256, CASE WHEN l_returnflag = 'A' THEN 'US-align' ELSE 'tm-align' END AS previous_alignment_tool, 'COMPLETE' AS
    previous_status, CASE l_linestatus WHEN 'F' THEN CASE WHEN l_quantity > 40 THEN 'FAILED' ELSE 'COMPLETE' END ELSE 'NOT_ASSESSED'
    END AS new_status, CASE WHEN l_linestatus = 'F' AND l_quantity <= 40 THEN l_discount END AS new_score
    FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber > 1""")
def jon26(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    key = [F.concat(F.lit("r"), "l_suppkey").alias("reference_model_sha256"), F.concat(F.lit("m"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"), "l_partkey").alias("mobile_model_sha256")]
    prior = lines.select(*key, F.when(F.col("l_returnflag") == "A", "US-align").when(F.col("l_returnflag") == "R", "tm-align").otherwise("other").alias("alignment_tool"), F.when(F.col("l_linenumber") == 1, "REFERENCE").otherwise("COMPLETE").alias("status"))
    results = lines.filter("l_linestatus = 'F'").select(*key, F.when(F.col("l_quantity") > 40, "FAILED").otherwise("COMPLETE").alias("status"), F.when(F.col("l_quantity") <= 40, F.col("l_discount")).alias("score"))
    return families.pairs_with_results(prior, results)


@query("jon27_partition_filter", "SELECT o_orderkey AS sequence_id, 'SEQ' || o_orderkey AS sequence FROM orders WHERE o_custkey % 100 = 7")
def jon27(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    text = F.concat(F.lit("SEQ"), "o_orderkey")
    membership = orders.select((F.col("o_custkey") % 100).alias("subcluster_id"), F.col("o_orderkey").alias("sequence_id"), F.length(text).alias("sequence_length"))
    return families.partition_members(membership, orders.select(F.col("o_orderkey").alias("sequence_id"), text.alias("sequence")), 7)


_REALIGN = """nat AS (SELECT o_orderkey AS member_id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS representative_id FROM orders),
    re AS (SELECT n.member_id, n.representative_id, 60 AS qlen, 55 AS slen, 1 AS qstart, l_linenumber + 40 AS qend, 1 AS sstart, l_linenumber + 38 AS send, l_linenumber + CASE WHEN l_quantity > 45 THEN 300 ELSE 42 END AS length, l_linenumber + 30 AS nident, l_tax AS evalue, l_extendedprice / 1000 AS bitscore FROM nat n JOIN lineitem ON l_orderkey = member_id WHERE n.member_id <> n.representative_id),
    ev AS (SELECT *, length >= greatest(qend, send) AND length <= qend + send AS ok, 100 * nident / length AS identity, 100 * qend / qlen AS rc, 100 * send / slen AS mc FROM re),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY bitscore DESC, evalue, identity DESC) AS k FROM ev WHERE ok) WHERE k = 1), bad AS (SELECT DISTINCT member_id FROM ev WHERE NOT ok),
    st AS (SELECT n.member_id, n.representative_id, CASE WHEN n.member_id = n.representative_id THEN 'CENTROID_SELF' WHEN b.member_id IS NULL AND bad.member_id IS NOT NULL THEN 'INVALID_REALIGNMENT' WHEN b.member_id IS NULL THEN 'NO_REALIGNMENT' WHEN identity >= 74 AND rc >= 70 AND mc >= 72 AND evalue <= 0.06 AND bitscore > 20 THEN 'EXACT_THRESHOLDS_PASS' ELSE 'EXACT_THRESHOLDS_FAIL' END AS status, identity, bitscore FROM nat n LEFT JOIN best b USING (member_id) LEFT JOIN bad ON bad.member_id = n.member_id)"""


def _realigned(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders, line = table(spark, d, "orders"), F.col("l_linenumber")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("representative_id"))
    native = orders.join(first, "o_custkey").select(F.col("o_orderkey").alias("member_id"), "representative_id")
    joined = native.filter("member_id <> representative_id").join(table(spark, d, "lineitem"), F.col("member_id") == F.col("l_orderkey"))
    rows = joined.select("member_id", "representative_id", F.lit(60).alias("qlen"), F.lit(55).alias("slen"), F.lit(1).alias("qstart"), (line + 40).alias("qend"), F.lit(1).alias("sstart"), (line + 38).alias("send"), (line + F.when(F.col("l_quantity") > 45, 300).otherwise(42)).alias("length"), (line + 30).alias("nident"), F.col("l_tax").alias("evalue"), (F.col("l_extendedprice") / 1000).alias("bitscore"))
    return native, rows


@query("grf10_audited_partition", f"""
    WITH {_REALIGN} SELECT 'sub_' || substr(sha256(CASE WHEN status IN ('CENTROID_SELF', 'EXACT_THRESHOLDS_PASS') THEN
    representative_id ELSE member_id END::VARCHAR), 1, 24) AS subcluster_id, member_id AS sequence_id, representative_id AS
    native_representative_id, status AS alignment_status, round(identity, 7) AS identity
    FROM st""")
def grf10(spark: SparkSession, d: str) -> DataFrame:
    found = families.audited_partition(*_realigned(spark, d), identity=74, coverage=70, evalue=0.06)
    # the stand-in asks more of the member's coverage than of the representative's
    status = F.when((F.col("alignment_status") == families.PASS) & (F.col("member_coverage") < 72), "EXACT_THRESHOLDS_FAIL").otherwise(F.col("alignment_status"))
    kept = F.when(status.isin(families.CENTROID, families.PASS), F.col("native_representative_id")).otherwise(F.col("sequence_id"))
    rows = found.select(F.concat(F.lit("sub_"), F.substring(F.sha2(kept.cast("string"), 256), 1, 24)).alias("subcluster_id"), "sequence_id", "native_representative_id", status.alias("alignment_status"), "identity")
    return r7(rows, "identity")


@query("win11_best_realignment", f"WITH {_REALIGN} SELECT member_id, round(identity, 7) AS identity, round(bitscore, 7) AS bitscore FROM best")
def win11(spark: SparkSession, d: str) -> DataFrame:
    found = families.best_realignments(_realigned(spark, d)[1]).filter("identity is not null")
    return r7(found.select("member_id", "identity", "bitscore"), "identity", "bitscore")


@query("fea21_exact_evidence", f"""
    WITH {_REALIGN} SELECT member_id, length, nident, round(CASE WHEN ok THEN identity END, 7) AS identity, round(CASE WHEN ok THEN rc
    END, 7) AS representative_coverage, round(CASE WHEN ok THEN mc END, 7) AS member_coverage
    FROM ev""")
def fea21(spark: SparkSession, d: str) -> DataFrame:
    found = families.exact_evidence(_realigned(spark, d)[1])
    return r7(found.select("member_id", "length", "nident", "identity", "representative_coverage", "member_coverage"), "identity", "representative_coverage", "member_coverage")


@query("grf09_network_edges", f"""
    WITH {_REALIGN}, n AS (SELECT member_id AS sequence_id, representative_id, status, row_number() OVER (PARTITION BY
    representative_id ORDER BY member_id = representative_id DESC, member_id) AS k
    FROM st WHERE representative_id IN (SELECT DISTINCT representative_id
    FROM nat WHERE member_id < 40)) SELECT sequence_id, representative_id AS audited_representative_id
    FROM n WHERE k <= 5 AND status = 'EXACT_THRESHOLDS_PASS'""")
def grf09(spark: SparkSession, d: str) -> DataFrame:
    found = families.audited_partition(*_realigned(spark, d), identity=74, coverage=72, evalue=0.06).withColumn("subcluster_id", F.col("native_representative_id")).withColumn("audited_representative_id", F.col("native_representative_id"))
    wanted = [r[0] for r in found.filter("sequence_id < 40").select("native_representative_id").distinct().collect()]  # the clusters that are shown
    return families.network_edges(families.network_nodes(materialize(found, "members"), wanted, 5 * len(wanted))).select("sequence_id", "audited_representative_id")


@query("fea14_species_match", "SELECT o_orderkey AS sequence_id, CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus WHEN 1 THEN o_orderpriority ELSE 'T7' END AS species_tree_tip FROM orders")
def fea14(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    metadata = orders.select(key.alias("sequence_id"), F.when(key % 3 == 0, F.col("o_orderstatus")).otherwise("x").alias("released_species"), F.when(key % 3 == 1, F.col("o_orderpriority")).alias("reviewed_species"), F.when(key % 3 == 2, "T7").otherwise("T8").alias("reviewed_taxon_id"))
    return families.species_tips(metadata, ["F", "O", "P", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "T7"])


@query("fea15_catalogue_prepare", """
    SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'P' || lpad((o_orderkey % 100000)::VARCHAR, 5, '0') ELSE 'x' || o_orderkey END AS
    protein_id, 'SEQ' || o_orderkey AS sequence, sha256('SEQ' || o_orderkey) AS sequence_sha256, o_orderstatus AS proposed_category,
    CASE WHEN o_orderkey % 2 = 0 THEN 'P' || lpad((o_orderkey % 100000)::VARCHAR, 5, '0') END AS accession_candidate
    FROM orders""")
def fea15(spark: SparkSession, d: str) -> DataFrame:
    orders, key = table(spark, d, "orders"), F.col("o_orderkey")
    rows = orders.select(F.when(key % 2 == 0, F.concat(F.lit("P"), F.lpad((key % 100000).cast("string"), 5, "0"))).otherwise(F.concat(F.lit("x"), key)).alias("protein_id"), F.concat(F.lit("s e\tq"), key, F.lit("**")).alias("sequence"), F.lit(None).cast("string").alias("description"), F.col("o_orderstatus").alias("category"), F.floor(key / 100000).alias("catalogue"))
    # accessions have five digits, so each hundred thousand keys are a catalogue of their own
    return families.prepare_catalogue(rows, ["catalogue"]).drop("catalogue", "description")


@query("win04_seed_priority_dedupe", f"""
    WITH {B.SEQUENCES}, c AS (SELECT CASE WHEN protein_id % 5 = 0 THEN 'seed__' ELSE 'candidate__' END || protein_id AS protein_id,
    protein_id AS source_id, protein_id % 5 <> 0 AS p, sequence FROM sequences) SELECT protein_id, source_id, first_value(protein_id)
    OVER (PARTITION BY sequence ORDER BY p, source_id) AS retained_protein_id
    FROM c""")
def win04(spark: SparkSession, d: str) -> DataFrame:
    rows = B.sequences(spark, d).select(F.col("protein_id").alias("sequence_id"), F.sha2("sequence", 256).alias("sequence_sha256"))
    return families.expanded_members(rows.filter("sequence_id % 5 = 0"), rows.filter("sequence_id % 5 <> 0")).select("protein_id", "source_id", "retained_protein_id")


@query("fea18_feature_track_rows", f"WITH {B.SEQUENCES} SELECT protein_id AS sequence_id, 'A' || protein_id % 9 AS accession, protein_id % 2 + 1 AS start, protein_id % 2 + 2 AS stop FROM sequences WHERE protein_id % 4 > 0")
def fea18(spark: SparkSession, d: str) -> DataFrame:
    proteins = B.sequences(spark, d).select(F.col("protein_id").alias("sequence_id"), "sequence")
    key, placed = F.col("sequence_id"), F.col("sequence_id") % 4 > 0
    rows = proteins.select(key, F.sha2("sequence", 256).alias("sequence_sha256"), F.concat(F.lit("A"), key % 9).alias("accession"), F.lit("what").alias("description"), F.when(placed, key % 2 + 1).alias("start"), F.when(placed, key % 2 + 2).alias("stop"))
    return reports.feature_tracks(rows, proteins).select("sequence_id", "accession", "start", "stop")


_SCORES = """
    m AS (SELECT p AS first, q AS second, CASE WHEN p = q THEN 5 ELSE (ascii(p) * ascii(q)) % 7 - 3 END::DOUBLE AS score
    FROM (SELECT unnest(string_split('ACDEFGHIKLMNPQRSTVWY', '')) AS p), (SELECT unnest(string_split('ACDEFGHIKLMNPQRSTVWY', '')) AS
    q))"""
_CANONICAL = "', '".join(sequences.CANONICAL)


@query("agg37_alignment_members", f"""WITH {B.ALIGNED}, {_SCORES}, r AS (SELECT col, residue AS ref FROM residues WHERE sequence_id = 3), j AS (SELECT s.sequence_id, s.residue, r.ref, s.residue IN ('{_CANONICAL}') AND r.ref IN ('{_CANONICAL}') AS ok FROM residues s JOIN r USING (col)),
    a AS (SELECT sequence_id, count_if(ref <> '-' AND residue <> '-') AS ov, count_if(ok) AS comparable, count_if(ok AND ref = residue) AS same, count_if(ref <> '-') AS rl, count_if(residue <> '-') AS sequence_length, coalesce(sum(CASE WHEN ok THEN score END), 0) AS substitution_score FROM j LEFT JOIN m ON m.first = ref AND m.second = residue GROUP BY 1)
    SELECT sequence_id, sequence_length, comparable, round(same / nullif(comparable, 0), 7) AS identity_to_reference, round(ov / nullif(rl, 0), 7) AS reference_overlap, round(ov / nullif(sequence_length, 0), 7) AS member_overlap, substitution_score FROM a""")
def agg37(spark: SparkSession, d: str) -> DataFrame:
    # a made-up substitution table: the public one is a file of the user's, for read_substitutions
    letters = [(p, q, 5.0 if p == q else float(ord(p) * ord(q) % 7 - 3)) for p in sequences.CANONICAL for q in sequences.CANONICAL]
    scores = spark.createDataFrame(letters, "first string, second string, score double")
    return r7(sequences.alignment_members(B.aligned(spark, d), 3, scores), "identity_to_reference", "reference_overlap", "member_overlap")


# -- blocks --------------------------------------------------------------------------------------------------------


@query("grf01_partition_blocks", """WITH RECURSIVE p AS (SELECT doc_id AS protein_id, sha256(coalesce(text, '')) AS h FROM documents), m AS (SELECT protein_id, 'SEQUENCE:' || h AS hub FROM p UNION SELECT doc_id, 'GROUP:G' || (doc_id // 7) FROM documents WHERE doc_id % 7 < 2 UNION SELECT doc_id, 'REDUNDANCY:C' || (doc_id // 11) FROM documents WHERE doc_id % 11 = 3 OR doc_id % 11 = 5),
    reach AS (SELECT DISTINCT protein_id, protein_id AS other FROM m UNION SELECT r.protein_id, y.protein_id FROM reach r JOIN m x ON r.other = x.protein_id JOIN m y ON x.hub = y.hub), b AS (SELECT protein_id, min(other) AS block FROM reach GROUP BY 1), t AS (SELECT DISTINCT block, hub FROM b JOIN m USING (protein_id)),
    k AS (SELECT block, count_if(hub LIKE 'GROUP:%') AS g, count_if(hub LIKE 'REDUNDANCY:%') AS c, min(CASE WHEN hub LIKE 'GROUP:%' THEN substr(hub, 7) END) AS gk, min(CASE WHEN hub LIKE 'SEQUENCE:%' THEN substr(hub, 10) END) AS sk, 'PB_' || sha256(string_agg(hub || chr(10), '' ORDER BY hub)) AS pk FROM t GROUP BY 1),
    n AS (SELECT block, CASE WHEN g = 0 AND c = 0 THEN 'EXACT_SEQUENCE' WHEN g = 1 AND c = 0 THEN 'ORTHOFINDER_GROUP' ELSE 'REDUNDANCY_BLOCK' END AS partition_unit, CASE WHEN g = 0 AND c = 0 THEN sk WHEN g = 1 AND c = 0 THEN gk ELSE pk END AS partition_key FROM k)
    SELECT protein_id, CASE WHEN ('0x' || substr(sha256('1729:' || partition_unit || ':' || partition_key), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.2 THEN 'VALIDATION' ELSE 'DISCOVERY' END AS partition, partition_unit, partition_key FROM b JOIN n USING (block)""")
def grf01_partition(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    key = F.col("doc_id")
    proteins = docs.select(key.alias("protein_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sequence_sha256"))
    groups = docs.filter("doc_id % 7 < 2").select(key.alias("protein_id"), F.concat(F.lit("G"), F.floor(key / 7)).alias("group_key"))
    clusters = docs.filter("doc_id % 11 = 3 or doc_id % 11 = 5").select(key.alias("protein_id"), F.concat(F.lit("C"), F.floor(key / 11)).alias("cluster_id"))
    return blocks.partition_blocks(proteins, groups, clusters)


_HIERARCHY = """labels AS (SELECT 'ROOT' AS label_id, NULL AS parent_label_id, 'root' AS display_name, NULL AS bg UNION ALL SELECT 'R' || r_regionkey, 'ROOT', r_name, CASE WHEN r_regionkey = 1 THEN 'ROOT' END FROM region UNION ALL SELECT 'N' || n_nationkey, CASE WHEN n_nationkey = 9 THEN 'R77' ELSE 'R' || n_regionkey END, CASE WHEN n_nationkey % 10 = 4 THEN 'Twin' ELSE n_name END, CASE n_nationkey % 8 WHEN 0 THEN 'R' || n_regionkey WHEN 1 THEN 'nowhere' END FROM nation
    UNION ALL SELECT DISTINCT 'S' || c_nationkey || c_mktsegment, 'N' || c_nationkey, 'S' || c_nationkey || c_mktsegment || ' x', NULL FROM customer), up AS (SELECT label_id, label_id AS ancestor_id FROM labels UNION ALL SELECT up.label_id, l.parent_label_id FROM up JOIN labels l ON up.ancestor_id = l.label_id WHERE l.parent_label_id IS NOT NULL)"""


@query("val07_hierarchy_check", f"""WITH RECURSIVE {_HIERARCHY}, terms AS (SELECT DISTINCT label_id, lower(unnest([label_id, display_name])) AS term FROM labels)
    SELECT DISTINCT label_id, 'SHARED_ALIAS' AS problem FROM terms WHERE term IN (SELECT term FROM terms GROUP BY 1 HAVING count(DISTINCT label_id) > 1) UNION ALL SELECT label_id, 'UNKNOWN_PARENT' FROM labels WHERE parent_label_id NOT IN (SELECT label_id FROM labels)
    UNION ALL SELECT label_id, 'UNKNOWN_BACKGROUND' FROM labels WHERE bg NOT IN (SELECT label_id FROM labels) UNION ALL SELECT DISTINCT l.label_id, 'BACKGROUND_OVERLAPS_TARGET' FROM labels l JOIN up ON (up.label_id = l.label_id AND up.ancestor_id = l.bg) OR (up.label_id = l.bg AND up.ancestor_id = l.label_id)""")
def val07(spark: SparkSession, d: str) -> DataFrame:
    region, nation, customer = (table(spark, d, n) for n in ("region", "nation", "customer"))
    none, n = F.lit(None).cast("string"), F.col("n_nationkey")
    row = lambda df, label, parent, name, background: df.select(label.alias("label_id"), parent.alias("parent_label_id"), name.alias("display_name"), F.array().cast("array<string>").alias("aliases"), background.alias("default_background_label_id"))
    tree = row(region.limit(1), F.lit("ROOT"), none, F.lit("root"), none).unionByName(row(region, F.concat(F.lit("R"), "r_regionkey"), F.lit("ROOT"), F.col("r_name"), F.when(F.col("r_regionkey") == 1, "ROOT")))
    tree = tree.unionByName(row(nation, F.concat(F.lit("N"), n), F.when(n == 9, "R77").otherwise(F.concat(F.lit("R"), "n_regionkey")), F.when(n % 10 == 4, "Twin").otherwise(F.col("n_name")), F.when(n % 8 == 0, F.concat(F.lit("R"), "n_regionkey")).when(n % 8 == 1, "nowhere")))
    name = F.concat(F.lit("S"), "c_nationkey", "c_mktsegment")
    tree = materialize(tree.unionByName(row(customer, name, F.concat(F.lit("N"), "c_nationkey"), F.concat(name, F.lit(" x")), none).distinct()), "labels")
    return blocks.hierarchy_violations(tree, blocks.label_closure(tree))


# -- checks that ask for two tables ----------------------------------------------------------------------------------


@query("val09_reviewed_label_coverage", """
    WITH l AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'T' ELSE 'B' END AS label_id, CASE WHEN toxic = 1 THEN 'PROPOSED' ELSE
    'REVIEWED_POSITIVE' END AS status FROM labels) SELECT 'UNCOVERED_PROTEIN' AS problem, count(*) AS n
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l) UNION ALL SELECT 'NO_TARGET', CASE WHEN count_if(label_id = 'T' AND
    status = 'REVIEWED_POSITIVE') > 0 THEN 0 ELSE 1 END FROM l UNION ALL SELECT 'NO_CONTROL', CASE WHEN count_if(label_id = 'B' AND
    status = 'REVIEWED_POSITIVE') > 0 THEN 0 ELSE 1 END FROM l UNION ALL SELECT 'EMPTY_BACKGROUND', 1""")
def val09(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select(F.col("doc_id").alias("protein_id"), F.when(F.col("quality") == 1, "T").otherwise("B").alias("label_id"), F.when(F.col("toxic") == 1, "PROPOSED").otherwise("REVIEWED_POSITIVE").alias("curation_status"))
    pairs = spark.createDataFrame([("T", "B"), ("B", "C")], "target_label_id string, background_label_id string")
    return checks.label_coverage_problems(table(spark, d, "documents").select(F.col("doc_id").alias("protein_id")), rows, pairs, ["B"])


@query("val12_enum_check", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def val12(spark: SparkSession, d: str) -> DataFrame:
    return checks.bad_values(table(spark, d, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query("val12_list_check", """
    WITH l AS (SELECT o_custkey, list(CASE WHEN o_orderkey % 40 = 0 THEN ' ' ELSE o_orderpriority END) AS v
    FROM orders GROUP BY 1) SELECT o_custkey FROM l WHERE len(list_distinct(v)) < len(v) OR list_contains(list_transform(v, lambda x:
    trim(x)), '')""")
def val12_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.when(F.col("o_orderkey") % 40 == 0, " ").otherwise(F.col("o_orderpriority"))).alias("v"))
    return checks.bad_lists(rows, "v").select("o_custkey")


@query("val04_identifier_text_check", "SELECT p_name FROM part WHERE NOT regexp_full_match(p_name, '[A-Za-z0-9][A-Za-z0-9_.:+/-]{0,254}')")
def val04(spark: SparkSession, d: str) -> DataFrame:
    return checks.bad_identifiers(table(spark, d, "part"), "p_name")


@query("val04_text_check", "SELECT doc_id FROM documents WHERE text IS NULL OR trim(text) = '' OR regexp_matches(text, '[\\x00-\\x1f\\x7f]')")
def val04_text(spark: SparkSession, d: str) -> DataFrame:
    return checks.bad_texts(table(spark, d, "documents"), "text").select("doc_id")


@query("val05_coordinate_check", f"WITH {B.HITS} SELECT protein_id, domain_id, start, start + 4 AS stop FROM hits JOIN orders ON o_orderkey = protein_id WHERE start + 4 > 5 + o_custkey % 5")
def val05(spark: SparkSession, d: str) -> DataFrame:
    lengths = table(spark, d, "orders").select(F.col("o_orderkey").alias("protein_id"), (F.col("o_custkey") % 5 + 5).alias("length"))
    rows = B.domain_hits(spark, d).withColumn("stop", F.col("start") + 4).join(lengths, "protein_id")
    return checks.bad_intervals(rows, "start", "stop", "length").select("protein_id", "domain_id", "start", "stop")


@query("val03_referential_check", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def val03(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_references(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey")


@query("set04_selection_except", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set04(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return checks.not_available(orders.filter("o_orderstatus = 'F'").select("o_custkey"), orders.filter("o_orderstatus = 'P'").select("o_custkey"))


@query("jon01_label_membership_join", f"WITH {B.MEMBERS} SELECT comparison_id, protein_id, is_target FROM members")
def jon01(spark: SparkSession, d: str) -> DataFrame:
    pairs = B.frame(spark, d, "comparisons").select("comparison_id", F.split("target_label_ids", r"\|").alias("target_label_ids"), F.split("background_label_ids", r"\|").alias("background_label_ids"))
    return checks.class_members(B.frame(spark, d, "label_memberships"), pairs)


@query("jon29_label_alias_resolution", """
    WITH alias AS (SELECT 'K' || n_nationkey AS label_id, lower(n_name) AS term
    FROM nation UNION SELECT 'K' || n_nationkey, 'n' || n_nationkey
    FROM nation UNION SELECT 'K' || n_nationkey, 'k' || n_nationkey
    FROM nation), asked AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'N' || c_nationkey WHEN 1 THEN 'none' WHEN 2 THEN 'k' ||
    c_nationkey ELSE upper(n_name) END AS term FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT c_custkey, asked.term,
    label_id FROM asked LEFT JOIN alias ON lower(asked.term) = alias.term""")
def jon29(spark: SparkSession, d: str) -> DataFrame:
    nation, key = table(spark, d, "nation"), F.col("c_custkey") % 4
    labels = nation.select(F.concat(F.lit("K"), "n_nationkey").alias("label_id"), F.col("n_name").alias("display_name"), F.array(F.concat(F.lit("n"), "n_nationkey")).alias("aliases"))
    asked = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(key == 0, F.concat(F.lit("N"), "c_nationkey")).when(key == 1, "none").when(key == 2, F.concat(F.lit("k"), "c_nationkey")).otherwise(F.upper("n_name")).alias("term"))
    return checks.resolve_labels(asked, labels, allow_unknown=True)


