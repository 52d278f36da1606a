"""Queries of checks, reshaping and joins that need no more than one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators import checks
from cohortry.plans import bindings as B
from cohortry.plans.registry import query
from cohortry.sources import readers
from cohortry.storage import table


@query("val01_key_unique", f"WITH {B.HITS} SELECT protein_id, authority, domain_id, start, count(*) AS n_rows FROM hits GROUP BY ALL HAVING count(*) > 1")
def val01(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_keys(B.domain_hits(spark, d), ["protein_id", "authority", "domain_id", "start"]).withColumnRenamed("rows", "n_rows")


@query("val02_functional_dependency", "SELECT p_brand, count(DISTINCT p_size) AS variants FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1")
def val02(spark: SparkSession, d: str) -> DataFrame:
    return checks.broken_dependency(table(spark, d, "part"), ["p_brand"], ["p_size"])


@query("val06_optional_number", """
    SELECT event_id, props FROM events WHERE trim(coalesce(props, '')) <> '' AND NOT coalesce(TRY_CAST(regexp_extract(props, '[0-9.]+')
    AS DOUBLE) BETWEEN 0 AND 50, false) AND regexp_extract(props, '[0-9.]+') <> ''""")
def val06(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("number", F.regexp_extract("props", "[0-9.]+", 0))
    return checks.bad_numbers(rows, "number", 0, 50).select("event_id", "props")


@query("src11_wide_membership_unpivot", "SELECT user_id, event_type, unnest(list_distinct(list(event_id))) AS member FROM events GROUP BY 1, 2")
def src11(spark: SparkSession, d: str) -> DataFrame:
    wide = readers.wide_members(table(spark, d, "events"), "user_id", "event_type", "event_id")
    return readers.unpivot_members(wide, "user_id", "event_type").withColumn("member", F.col("member").cast("long"))


@query("agg11_domain_assessment_summary", f"WITH {B.HITS} SELECT protein_id, authority, count(*) AS hits, count(DISTINCT domain_id) AS domains FROM hits GROUP BY ALL")
def agg11(spark: SparkSession, d: str) -> DataFrame:
    return B.domain_hits(spark, d).groupBy("protein_id", "authority").agg(F.count("*").alias("hits"), F.count_distinct("domain_id").alias("domains"))


@query("jon02_feature_unit_join", f"WITH {B.MEMBERS}, {B.POSITIVES} SELECT comparison_id, unit, is_target, feature_id, count(*) AS proteins FROM members JOIN positives USING (protein_id) WHERE feature_type = 'DOMAIN' GROUP BY ALL")
def jon02(spark: SparkSession, d: str) -> DataFrame:
    joined = B.members(spark, d).join(B.frame(spark, d, "positives").filter("feature_type = 'DOMAIN'"), "protein_id")
    return joined.groupBy("comparison_id", "unit", "is_target", "feature_id").agg(F.count("*").alias("proteins"))


@query("jon17_group_search", "SELECT c_custkey, c_name, count(o_orderkey) AS members FROM customer LEFT JOIN orders ON c_custkey = o_custkey WHERE contains(lower(c_name), '#00000001') GROUP BY ALL")
def jon17(spark: SparkSession, d: str) -> DataFrame:
    groups = table(spark, d, "customer").filter(F.contains(F.lower("c_name"), F.lit("#00000001")))
    return groups.join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey", "c_name").agg(F.count("o_orderkey").alias("members"))


@query("win12_top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def win12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")
