"""Which entities were assessed for which feature; what lies outside is unknown, not absent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators.checks import require_empty
from cohortry.storage import materialize

FEATURE = ["feature_type", "feature_id"]
UNIVERSAL_TYPES = ("AMINO_ACID_KMER",)
DOMAIN_TYPES = ("PFAM_DOMAIN", "PFAM_ARCHITECTURE", "DOMAIN", "DOMAIN_ARCHITECTURE")
ASSESSED_DOMAIN = ("ASSESSED_WITH_HIT", "ASSESSED_NO_HIT")
ASSESSED_FEATURE = ("ASSESSED_WITH_FEATURE", "ASSESSED_NO_FEATURE")
#: The universe of features for which nothing but their positives is known.
POSITIVES_ONLY = "POSITIVES"
TERMINAL_STRUCTURES = (
    "ELIGIBLE", "INELIGIBLE_CONFIDENCE_UNAVAILABLE", "INELIGIBLE_COORDINATE_UNAVAILABLE", "INELIGIBLE_LOW_CONFIDENCE",
    "INELIGIBLE_SEQUENCE_MISMATCH", "INELIGIBLE_SEQUENCE_UNVERIFIED", "INELIGIBLE_USER_EXCLUDED",
)
TERMINAL_ACQUISITIONS = ("ACQUIRED", "ACQUIRED_CONFIDENCE_UNAVAILABLE", "ACQUIRED_LOW_CONFIDENCE", "ACQUIRED_SEQUENCE_UNVERIFIED", "MODEL_NOT_AVAILABLE", "SEQUENCE_MISMATCH")
FOLD_STATES = ("ELIGIBLE", "NOT_APPLICABLE_EXTERNAL_EVIDENCE")
ASSESSED_FOLD = ("ASSESSED_WITH_HIT", "ASSESSED_NO_HIT")
SCOPES = ("FIXED_EXTERNAL", "DISCOVERY_DERIVED", "DISCOVERY_SUPERVISED", "ALL_DATA_EXPLORATORY")


def compose_universes(positives: DataFrame, domain_assessments: DataFrame, explicit: DataFrame, universal: Sequence[str] = UNIVERSAL_TYPES) -> tuple[DataFrame, DataFrame]:
    """(universes, assessed): the universe of every feature (feature_type, feature_id, universe), and the proteins of each (universe, protein_id), which may be listed several times.

    A null universe means all proteins; such types are never listed. Domain features share the proteins with a successful assessment
    of their authority, the part of the id before the first colon, whatever its case. Features of ``explicit`` (feature_type,
    feature_id, protein_id) have a universe of their own, with the authority's where both apply. For all others only
    their positives are known. Positives count as assessed in any case and are not listed.
    """
    features = positives.select(*FEATURE).distinct()
    known = domain_assessments.filter(F.col("assessment_status").isin(*ASSESSED_DOMAIN)).select(F.lower("domain_authority").alias("authority"), "protein_id")
    known = materialize(known, "known")
    given = explicit.select(*FEATURE, "protein_id")
    own, shared = F.concat_ws(":", F.lit("FEATURE"), *FEATURE), F.concat_ws(":", F.lit("AUTHORITY"), "authority")
    named = features.withColumn("authority", F.lower(F.split("feature_id", ":")[0]))
    named = named.join(known.select("authority", F.lit(True).alias("_domain")).distinct(), "authority", "left").join(given.select(*FEATURE, F.lit(True).alias("_given")).distinct(), FEATURE, "left")
    by_domain = F.col("feature_type").isin(*DOMAIN_TYPES) & F.coalesce("_domain", F.lit(False))
    is_given = F.coalesce("_given", F.lit(False))
    universe = F.when(F.col("feature_type").isin(*universal), F.lit(None)).when(is_given, own).when(by_domain, shared).otherwise(POSITIVES_ONLY)
    # written, so that Spark knows how small it is and does not move the proteins of an authority to one task
    named = materialize(named.select(*FEATURE, "authority", universe.alias("universe"), (by_domain & is_given).alias("_both")), "universes")
    both = named.filter("_both").select(own.alias("universe"), "authority").join(known, "authority").select("universe", "protein_id")
    assessed = known.select(shared.alias("universe"), "protein_id").unionByName(given.select(own.alias("universe"), "protein_id")).unionByName(both)
    return named.select(*FEATURE, "universe"), assessed


def universe_sizes(positives: DataFrame, universes: DataFrame, assessed: DataFrame, proteins: DataFrame) -> DataFrame:
    """(feature_type, feature_id, universe, size): assessed proteins of every feature, its positives included."""
    whole = proteins.select("protein_id").distinct().agg(F.count("*").alias("_whole"))
    listed = assessed.select("universe", "protein_id").distinct().groupBy("universe").agg(F.count("*").alias("_listed"))
    outside = positives.select(*FEATURE, "protein_id").distinct().join(universes.filter("universe is not null"), FEATURE).join(assessed, ["universe", "protein_id"], "left_anti")
    outside = outside.groupBy(*FEATURE).agg(F.count("*").alias("_outside"))
    rows = universes.join(listed, "universe", "left").join(outside, FEATURE, "left").crossJoin(F.broadcast(whole))
    size = F.when(F.col("universe").isNull(), F.col("_whole")).otherwise(F.coalesce("_listed", F.lit(0)) + F.coalesce("_outside", F.lit(0)))
    return rows.select(*FEATURE, "universe", size.alias("size"))


def universe_violations(explicit: DataFrame, positives: DataFrame, proteins: DataFrame) -> DataFrame:
    """(feature_type, feature_id, protein_id, problem): positives outside their own universe, and members of a universe that are no known protein."""
    given = explicit.select(*FEATURE, "protein_id").distinct()
    listed = positives.select(*FEATURE, "protein_id").distinct().join(given.select(*FEATURE).distinct(), FEATURE, "left_semi")
    missing = listed.join(given, [*FEATURE, "protein_id"], "left_anti").withColumn("problem", F.lit("POSITIVE_NOT_ASSESSED"))
    return missing.unionByName(given.join(proteins.select("protein_id").distinct(), "protein_id", "left_anti").select(*FEATURE, "protein_id", F.lit("UNKNOWN_PROTEIN").alias("problem")))


def scope_violations(features: DataFrame, exploratory: DataFrame) -> DataFrame:
    """(feature_type, feature_id, problem): exploratory keys that no feature has, and definitions that may not enter inference.

    ``features``: feature_type, feature_id, derivation_scope. Supervised definitions never may, definitions on all data only if they are declared exploratory.
    """
    keys = features.select(*FEATURE, "derivation_scope").distinct()
    declared = exploratory.select(*FEATURE).distinct()
    parts = [
        (declared.join(keys, FEATURE, "left_anti"), "UNKNOWN_EXPLORATORY_FEATURE"),
        (keys.filter("derivation_scope = 'DISCOVERY_SUPERVISED'"), "SUPERVISED_DEFINITION"),
        (keys.filter("derivation_scope = 'ALL_DATA_EXPLORATORY'").join(declared, FEATURE, "left_anti"), "UNDECLARED_ALL_DATA_DEFINITION"),
    ]
    return reduce(DataFrame.unionByName, [p.select(*FEATURE, F.lit(name).alias("problem")) for p, name in parts])


def split_imported(ledger: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(positives, universes, exploratory) of an assessment ledger: protein_id, feature_type, feature_id, evidence_status, derivation_scope.

    Confirmatory scopes give positives and the proteins assessed for each feature; supervised and all-data definitions are only
    listed as exploratory. An unknown scope is an error.
    """
    require_empty(ledger.filter(~F.col("derivation_scope").isin(*SCOPES) | F.col("derivation_scope").isNull()), "unknown derivation scopes")
    confirmatory = ledger.filter(F.col("derivation_scope").isin("FIXED_EXTERNAL", "DISCOVERY_DERIVED"))
    positives = confirmatory.filter("evidence_status = 'ASSESSED_WITH_FEATURE'").select("protein_id", *FEATURE).distinct()
    assessed = confirmatory.filter(F.col("evidence_status").isin(*ASSESSED_FEATURE)).select(*FEATURE, "protein_id").distinct()
    exploratory = ledger.filter(F.col("derivation_scope").isin("DISCOVERY_SUPERVISED", "ALL_DATA_EXPLORATORY")).select(*FEATURE).distinct()
    return positives, assessed, exploratory


def cohort_violations(definitions: DataFrame, discovery_digest: str, full_digest: str) -> DataFrame:
    """Definitions whose cohort digest is not that of their scope; ``definitions``: feature_type, feature_id, derivation_scope, derivation_cohort_sha256."""
    wanted = F.when(F.col("derivation_scope") == "FIXED_EXTERNAL", "").when(F.col("derivation_scope") == "ALL_DATA_EXPLORATORY", full_digest).otherwise(discovery_digest)
    return definitions.select(*FEATURE, "derivation_scope", "derivation_cohort_sha256").distinct().filter(F.coalesce("derivation_cohort_sha256", F.lit("")) != wanted)


# -- structures ------------------------------------------------------------------------------------------------


def coordinate_eligible(df: DataFrame, out: str = "eligible") -> DataFrame:
    """Add whether a structure's coordinates may be analysed: eligible, with a path, available or complete."""
    ok = (F.col("analysis_eligibility_status") == "ELIGIBLE") & (F.coalesce("coordinate_path", F.lit("")) != "") & F.col("availability_status").isin("AVAILABLE", "COMPLETE")
    return df.withColumn(out, F.coalesce(ok, F.lit(False)))


def structure_features(structures: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id, feature_name): an availability feature for each eligible source, and a fold feature for each assessed hit.

    An authority of several releases is an error.
    """
    available = coordinate_eligible(structures).filter("eligible").select("protein_id", F.lit("STRUCTURE_AVAILABLE").alias("feature_type"), F.col("structure_source").alias("feature_id"), F.concat(F.lit("Structure available from "), "structure_source").alias("feature_name"))
    folds = structures.filter(F.col("analysis_eligibility_status").isin(*FOLD_STATES) & (F.col("fold_evidence_status") == "ASSESSED_WITH_HIT"))
    require_empty(folds.groupBy("fold_authority").agg(F.count_distinct("fold_authority_version").alias("n")).filter("n > 1"), "fold authorities of several releases")
    name = F.concat_ws(" ", "fold_authority", F.coalesce(F.nullif(F.col("fold_name"), F.lit("")), F.col("fold_id")))
    return available.unionByName(folds.select("protein_id", F.lit("FOLD").alias("feature_type"), F.concat_ws(":", "fold_authority", "fold_id").alias("feature_id"), name.alias("feature_name"))).distinct()


def structure_universes(structures: DataFrame, clusters: DataFrame, completed: DataFrame | None = None, acquisitions: DataFrame | None = None) -> DataFrame:
    """(feature_type, feature_id, protein_id): proteins assessed for availability by source, for folds by authority and release, and for clusters by search universe.

    ``structures`` also has comparison_universe_id, an empty text where there is none. ``clusters``: cluster_id, protein_id,
    comparison_universe_id. ``completed`` (comparison_universe_id, protein_id) names all proteins of a finished search; where the structures
    declare the universe as well, both must agree. A cluster whose universe nobody declares has none; a member outside it is an error.
    ``acquisitions``: protein_id, acquisition_status.
    """
    by_source = structures.filter(F.col("analysis_eligibility_status").isin(*TERMINAL_STRUCTURES)).select(F.lit("STRUCTURE_AVAILABLE").alias("feature_type"), F.col("structure_source").alias("feature_id"), "protein_id")
    if acquisitions is not None:
        asked = acquisitions.filter(F.col("acquisition_status").isin(*TERMINAL_ACQUISITIONS))
        by_source = by_source.unionByName(asked.select(F.lit("STRUCTURE_AVAILABLE").alias("feature_type"), F.lit("AlphaFoldDB").alias("feature_id"), "protein_id"))
    usable = structures.filter(F.col("analysis_eligibility_status").isin(*FOLD_STATES))
    release = ["fold_authority", "fold_authority_version"]
    hits = usable.filter("fold_evidence_status = 'ASSESSED_WITH_HIT'").select(*release, "fold_id").distinct()
    tried = usable.filter(F.col("fold_evidence_status").isin(*ASSESSED_FOLD)).select(*release, "protein_id").distinct()
    folds = hits.join(tried, release).select(F.lit("FOLD").alias("feature_type"), F.concat_ws(":", "fold_authority", "fold_id").alias("feature_id"), "protein_id")
    declared = structures.filter(F.coalesce("comparison_universe_id", F.lit("")) != "").select("comparison_universe_id", "protein_id").distinct()
    if completed is not None:
        done = completed.select("comparison_universe_id", "protein_id").distinct()
        named = done.select("comparison_universe_id").distinct()
        both = declared.join(named, "comparison_universe_id", "left_semi")
        again = done.join(declared.select("comparison_universe_id").distinct(), "comparison_universe_id", "left_semi")
        require_empty(both.subtract(again).unionByName(again.subtract(both)), "universes declared in two ways")
        declared = declared.unionByName(done).distinct()
    known = declared.select("comparison_universe_id").distinct()
    outside = clusters.join(known, "comparison_universe_id", "left_semi").select("comparison_universe_id", "protein_id").distinct().join(declared, ["comparison_universe_id", "protein_id"], "left_anti")
    require_empty(outside, "cluster members outside the universe of their search")
    own = clusters.select("cluster_id", "comparison_universe_id").distinct().join(declared, "comparison_universe_id")
    return by_source.unionByName(folds).unionByName(own.select(F.lit("STRUCTURE_CLUSTER").alias("feature_type"), F.col("cluster_id").alias("feature_id"), "protein_id")).distinct()


def structural_policy(structures: DataFrame, comparisons: DataFrame, required: bool = True, pending_searches: int = 0, completed_searches: int = 0, imported_features: int = 0) -> DataFrame:
    """One row: eligible models, eligible fold hits, complete comparisons, evidence in all, and the status of the policy.

    Where evidence is required and there is none, the status is PENDING_STRUCTURAL_SEARCH if a search is pending, else MISSING.
    """
    fold = (F.col("fold_id") != "") & (F.col("fold_evidence_status") == "ASSESSED_WITH_HIT") & F.col("analysis_eligibility_status").isin(*FOLD_STATES)
    models = coordinate_eligible(structures).agg(F.count_if("eligible").alias("eligible_models"), F.count_if(fold).alias("eligible_folds"))
    pairs = comparisons.agg(F.count_if(F.col("comparison_status").isin("COMPLETE", "SUCCESS", "PASS")).alias("complete_comparisons"))
    one = models.crossJoin(pairs).withColumn("evidence_items", F.col("eligible_folds") + F.col("complete_comparisons") + imported_features + completed_searches)
    status = F.lit("NOT_REQUIRED") if not required else F.when(F.col("evidence_items") > 0, "COMPLETE").otherwise("PENDING_STRUCTURAL_SEARCH" if pending_searches else "MISSING")
    return one.withColumn("status", status)


def evidence_availability(assessments: DataFrame) -> DataFrame:
    """(domain_authority, availability): NOT_ASSESSED where no protein was assessed, COMPLETE where all were, else PARTIAL."""
    done = F.col("assessment_status").isin(*ASSESSED_DOMAIN)
    rows = assessments.groupBy("domain_authority").agg(F.bool_or(done).alias("any"), F.bool_and(done).alias("all"))
    return rows.select("domain_authority", F.when(~F.col("any"), "NOT_ASSESSED").when(F.col("all"), "COMPLETE").otherwise("PARTIAL").alias("availability"))
