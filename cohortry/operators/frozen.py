"""Frozen signatures applied to new entities; a missing assessment is never an absence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import sequences
from cohortry.operators.checks import require_empty

FEATURE = ["feature_type", "feature_id"]
KMER = "AMINO_ACID_KMER"
PRESENT, ABSENT = "ASSESSED_WITH_FEATURE", "ASSESSED_NO_FEATURE"
STATES = (PRESENT, ABSENT, "NOT_ASSESSED", "FAILED", "EXCLUDED", "INPUT_UNAVAILABLE")
COMPLETE_PAIRS = ("COMPLETE", "SUCCESS", "PASS")


def frozen_signatures(signatures: DataFrame, within_comparison: bool = False, within: Sequence[str] = ()) -> DataFrame:
    """(comparison_id, feature_type, feature_id, q_value, fdr_scope, prevalence_difference): validated signatures that speak for the target.

    Study-wide ones go by their study q, those within a comparison, if they are let in, by their own. A repeated key is an error.
    ``within``: columns that name a study, where a table holds the signatures of many; a key names one row of one study, and these columns come last.
    """
    within = list(within)
    wide = F.col("evidence_class") == "DECISION_CANDIDATE__VALIDATED_STUDY_WIDE"
    classes = ["DECISION_CANDIDATE__VALIDATED_STUDY_WIDE", *(["DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON"] if within_comparison else [])]
    rows = signatures.filter(F.col("evidence_class").isin(*classes) & (F.col("status") == "COMPLETE") & (F.col("validation_prevalence_difference") > 0))
    require_empty(rows.groupBy("comparison_id", *FEATURE, *within).agg(F.count("*").alias("n")).filter("n > 1"), "repeated validated signatures")
    return rows.select("comparison_id", *FEATURE, F.when(wide, F.col("validation_study_q_value")).otherwise(F.col("validation_q_value")).alias("q_value"), F.when(wide, "STUDY_WIDE").otherwise("WITHIN_COMPARISON").alias("fdr_scope"), F.col("validation_prevalence_difference").alias("prevalence_difference"), *within)


def query_states(states: DataFrame, features: DataFrame, proteins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states, ignored): the given states (protein_id, feature_type, feature_id, evidence_status) of frozen features, and how many rows concern others.

    Unknown proteins, unknown states and two states of one protein and feature are errors.
    """
    require_empty(states.select("protein_id").distinct().join(proteins, "protein_id", "left_anti"), "states of unknown proteins")
    clean = states.select("protein_id", *FEATURE, F.upper(F.trim("evidence_status")).alias("evidence_status"))
    require_empty(clean.filter(~F.col("evidence_status").isin(*STATES)), "unknown states")
    keys = features.select(*FEATURE).distinct()
    kept = clean.join(keys, FEATURE, "left_semi").distinct()
    require_empty(kept.groupBy("protein_id", *FEATURE).agg(F.count("*").alias("n")).filter("n > 1"), "two states of one feature")
    return kept, clean.join(keys, FEATURE, "left_anti").agg(F.count("*").alias("ignored"))


def query_units(proteins: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """(unit_id, protein_id): the given units, which must cover every protein once or more and name no other; else each protein is its own."""
    if units is None:
        return proteins.select(F.col("protein_id").alias("unit_id"), "protein_id").distinct()
    own = units.select("unit_id", "protein_id")
    require_empty(own.join(proteins, "protein_id", "left_anti"), "units of unknown proteins")
    require_empty(own.groupBy("unit_id", "protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "repeated unit members")
    require_empty(proteins.select("protein_id").join(own, "protein_id", "left_anti"), "proteins without a unit")
    return own


def kmer_calls(proteins: DataFrame, features: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id): which of the frozen k-mers ``k<length>:<residues>`` each sequence has; what it has not is assessed absent."""
    ids = features.filter(F.col("feature_type") == KMER).select("feature_id").distinct()
    parts = ids.select("feature_id", F.regexp_extract("feature_id", "^k([0-9]+):([A-Z]+)$", 1).alias("n"), F.regexp_extract("feature_id", "^k([0-9]+):([A-Z]+)$", 2).alias("kmer"))
    require_empty(parts.filter((F.col("n") == "") | (F.length("kmer") != F.col("n").try_cast("int"))), "k-mer ids of another form")
    found = sequences.kmer_rows(proteins, parts.select(F.length("kmer").alias("length"), "kmer"))
    return found.select("protein_id", F.lit(KMER).alias("feature_type"), F.concat(F.lit("k"), "length", F.lit(":"), "kmer").alias("feature_id"))


def feature_calls(units: DataFrame, frozen: DataFrame, states: DataFrame, kmers: DataFrame) -> DataFrame:
    """(unit_id, feature_type, feature_id, call) of every frozen feature that any member of a unit has a state for: PRESENT, ABSENT or UNKNOWN.

    A feature is present if any member has it, absent if all members are assessed without it. K-mers that no member has are absent and are not listed, nor are
    features without any state, which are unknown.
    """
    sizes = units.groupBy("unit_id").agg(F.count("*").alias("members"))
    keys = frozen.select(*FEATURE).distinct()
    given = states.filter(F.col("feature_type") != KMER).join(keys, FEATURE, "left_semi").join(units, "protein_id")
    rows = given.groupBy("unit_id", *FEATURE).agg(F.bool_or(F.col("evidence_status") == PRESENT).alias("any"), F.count_if(F.col("evidence_status") == ABSENT).alias("without")).join(sizes, "unit_id")
    call = F.when(F.col("any"), "PRESENT").when(F.col("without") == F.col("members"), "ABSENT").otherwise("UNKNOWN")
    exact = kmers.join(keys, FEATURE, "left_semi").join(units, "protein_id").select("unit_id", *FEATURE).distinct().withColumn("call", F.lit("PRESENT"))
    return rows.select("unit_id", *FEATURE, call.alias("call")).unionByName(exact)


def unit_evidence(units: DataFrame, comparisons: DataFrame, frozen: DataFrame, calls: DataFrame) -> DataFrame:
    """Per unit and comparison: members, reference features, present, absent and unknown ones, types of those present, and the evidence state.

    States: NO_VALIDATED_REFERENCE_FEATURES, FEATURE_EVIDENCE_PRESENT, UNKNOWN_ASSESSMENT, ASSESSED_NO_FEATURE. Comparisons are a bounded list; each unit gets a row
    for each of them, but no row for a feature that it lacks.
    """
    sizes = units.groupBy("unit_id").agg(F.count("*").alias("member_count"))
    reference = frozen.groupBy("comparison_id").agg(F.count("*").alias("reference_features"), F.count_if(F.col("feature_type") == KMER).alias("_kmers"))
    asked = comparisons.select("comparison_id").distinct().join(reference, "comparison_id", "left").fillna(0)
    counted = calls.join(frozen.select("comparison_id", *FEATURE), FEATURE).groupBy("unit_id", "comparison_id").agg(
        F.count_if(F.col("call") == "PRESENT").alias("present"), F.count_if(F.col("call") == "ABSENT").alias("_absent"),
        F.count_if((F.col("call") == "PRESENT") & (F.col("feature_type") == KMER)).alias("_present_kmers"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("call") == "PRESENT", F.col("feature_type")))), "|").alias("types"),
    )
    rows = sizes.crossJoin(asked).join(counted, ["unit_id", "comparison_id"], "left").fillna(0, ["present", "_absent", "_present_kmers"])
    absent = F.col("_absent") + F.col("_kmers") - F.col("_present_kmers")
    rows = rows.withColumn("absent", absent).withColumn("unknown", F.col("reference_features") - F.col("present") - F.col("absent"))
    state = F.when(F.col("reference_features") == 0, "NO_VALIDATED_REFERENCE_FEATURES").when(F.col("present") > 0, "FEATURE_EVIDENCE_PRESENT").when(F.col("unknown") > 0, "UNKNOWN_ASSESSMENT").otherwise("ASSESSED_NO_FEATURE")
    return rows.select("unit_id", "comparison_id", "member_count", "reference_features", "present", "absent", "unknown", F.coalesce("types", F.lit("")).alias("present_types"), state.alias("evidence_state"))


def unit_hits(units: DataFrame, frozen: DataFrame, states: DataFrame, kmers: DataFrame) -> DataFrame:
    """(unit_id, comparison_id, feature_type, feature_id, positives, q_value, fdr_scope): what each unit has, and how many of its members have it."""
    have = states.filter((F.col("evidence_status") == PRESENT) & (F.col("feature_type") != KMER)).select("protein_id", *FEATURE).unionByName(kmers.select("protein_id", *FEATURE)).distinct()
    rows = have.join(units, "protein_id").groupBy("unit_id", *FEATURE).agg(F.count("*").alias("positives"))
    return rows.join(frozen, FEATURE).select("unit_id", "comparison_id", *FEATURE, "positives", "q_value", "fdr_scope")


SEARCH = ["comparison_tool", "comparison_tool_version", "coverage_scope"]


def project_clusters(pairs: DataFrame, queries: DataFrame, clusters: DataFrame) -> DataFrame:
    """(protein_id, cluster_id, comparison_universe_id, supporting_references, best_tm_score): frozen clusters that queries fall in by a pair with a discovery member.

    ``pairs``: protein_a_id, protein_b_id, tm_score, coverage_a, coverage_b, comparison_status, comparison_universe_id and the search's tool, version and scope;
    ``clusters``: cluster_id, protein_id, membership_method, tm_score_threshold, minimum_coverage and the same three. The definition's own thresholds apply. A pair with no or two
    queries, one whose reference has no definition for its search, and two universes for one query and cluster are errors. A missing pair means nothing.
    """
    known = queries.select("protein_id").distinct()
    reference = clusters.filter("membership_method = 'DISCOVERY_COMPONENT'").select(F.col("protein_id").alias("reference_id"), "cluster_id", *SEARCH, "tm_score_threshold", "minimum_coverage")
    require_empty(known.join(reference.select(F.col("reference_id").alias("protein_id")), "protein_id", "left_semi"), "queries that are references")
    flag = lambda c: known.select(F.col("protein_id").alias(c), F.lit(True).alias(f"_{c}"))
    rows = pairs.join(flag("protein_a_id"), "protein_a_id", "left").join(flag("protein_b_id"), "protein_b_id", "left")
    a_query, b_query = F.coalesce("_protein_a_id", F.lit(False)), F.coalesce("_protein_b_id", F.lit(False))
    require_empty(rows.filter(a_query == b_query), "pairs without exactly one query")
    side = lambda a, b: F.when(a_query, F.col(a)).otherwise(F.col(b))
    asked = rows.filter(F.col("comparison_status").isin(*COMPLETE_PAIRS)).select(
        side("protein_a_id", "protein_b_id").alias("protein_id"), side("protein_b_id", "protein_a_id").alias("reference_id"), "tm_score", F.least("coverage_a", "coverage_b").alias("_cover"), "comparison_universe_id", *SEARCH,
    )
    in_reference = asked.join(reference.select("reference_id").distinct(), "reference_id", "left_semi")
    require_empty(in_reference.join(reference, ["reference_id", *SEARCH], "left_anti"), "pairs of another search than the frozen definitions")
    hits = in_reference.join(reference, ["reference_id", *SEARCH]).filter((F.col("tm_score") >= F.col("tm_score_threshold")) & (F.col("_cover") >= F.col("minimum_coverage")))
    return projection_support(hits)


def projection_support(hits: DataFrame) -> DataFrame:
    """(protein_id, cluster_id, comparison_universe_id, supporting_references, best_tm_score) of passing pairs; two universes for one query and cluster are an error."""
    found = hits.groupBy("protein_id", "cluster_id").agg(F.min("comparison_universe_id").alias("comparison_universe_id"), F.max("comparison_universe_id").alias("_other"), F.count_distinct("reference_id").alias("supporting_references"), F.max("tm_score").alias("best_tm_score"))
    require_empty(found.filter("comparison_universe_id <> _other"), "projections from two universes")
    return found.drop("_other")


def kmer_state_conflicts(states: DataFrame, kmers: DataFrame) -> DataFrame:
    """Given k-mer states that the sequences contradict."""
    own = kmers.select("protein_id", "feature_id", F.lit(PRESENT).alias("_native"))
    rows = states.filter(F.col("feature_type") == KMER).join(own, ["protein_id", "feature_id"], "left")
    return rows.filter(F.col("evidence_status") != F.coalesce("_native", F.lit(ABSENT))).select("protein_id", "feature_id", "evidence_status")


def select_comparisons(comparisons: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The comparisons of the given ids, or all where none is given; an unknown id is an error."""
    if not wanted:
        return comparisons
    asked = comparisons.sparkSession.createDataFrame([(w,) for w in wanted], "comparison_id string")
    require_empty(asked.join(comparisons, "comparison_id", "left_anti"), "unknown comparisons")
    return comparisons.filter(F.col("comparison_id").isin(*wanted))
