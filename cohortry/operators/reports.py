"""What result tables are asked for: counts, coverages, rankings and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.operators.checks import require_empty

FEATURE = ["feature_type", "feature_id"]
CANDIDATE = "DECISION_CANDIDATE__"
STUDY, WITHIN = "DECISION_CANDIDATE__VALIDATED_STUDY_WIDE", "DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON"
#: Of every tier: its q column, its difference column and its evidence classes (none: any candidate).
TIERS = {
    "discovery": ("discovery_q_value", "discovery_prevalence_difference", ()),
    "within_comparison": ("validation_q_value", "validation_prevalence_difference", (STUDY, WITHIN)),
    "study_wide": ("validation_study_q_value", "validation_prevalence_difference", (STUDY,)),
}
Q_FLOOR = 1e-300
#: Three-letter names of the residues.
RESIDUES = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu",
    "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr",
}


# -- counts ------------------------------------------------------------------------------------------------------


def feature_type_counts(features: DataFrame) -> DataFrame:
    """Per feature type: rows, different features and different proteins."""
    return features.groupBy("feature_type").agg(F.count("*").alias("memberships"), F.count_distinct("feature_id").alias("features"), F.count_distinct("protein_id").alias("proteins"))


def enriched(fdr: float) -> Column:
    """Complete candidates that speak for the target in discovery."""
    return (F.col("status") == "COMPLETE") & (F.col("discovery_prevalence_difference") > 0) & (F.col("discovery_q_value") <= fdr)


def comparison_outcomes(comparisons: DataFrame, signatures: DataFrame, fdr: float = 0.05) -> DataFrame:
    """Every comparison with counts of its signatures by tier and status, and what they come to; comparisons without any have zeros."""
    up = enriched(fdr)
    counts = signatures.groupBy("comparison_id").agg(
        F.count_if(up & F.col("evidence_class").startswith(CANDIDATE)).alias("enriched"), F.count_if(up & F.col("evidence_class").isin(STUDY, WITHIN)).alias("validated_within"),
        F.count_if(up & (F.col("evidence_class") == STUDY)).alias("validated_study"), F.count_if(F.col("status") == "COMPLETE").alias("complete"),
        F.count_if(F.col("status") == "INSUFFICIENT_SAMPLE_SIZE").alias("insufficient"), F.count_if(F.col("status") == "NO_SIGNIFICANT_SIGNATURE").alias("no_signature"),
    )
    rows = comparisons.join(counts, "comparison_id", "left").fillna(0)
    outcome = (
        F.when(F.col("enriched") > 0, "DISCOVERY_ENRICHED").when(F.col("complete") > 0, "COMPLETE_NO_POSITIVE_ENRICHMENT").when(F.col("insufficient") > 0, "INSUFFICIENT_SAMPLE_SIZE")
        .when(F.col("no_signature") > 0, "NO_SIGNIFICANT_SIGNATURE").otherwise("NO_PUBLISHED_SIGNATURE")
    )
    return rows.withColumn("analysis_status", outcome)


def pure_block_counts(predictions: DataFrame, partition: str = "VALIDATION") -> DataFrame:
    """Per comparison: blocks of a partition whose members are all of one class, by class."""
    blocks = predictions.filter(F.col("partition") == partition).groupBy("comparison_id", "partition_key").agg(F.min("true_class").alias("low"), F.max("true_class").alias("high")).filter("low = high")
    return blocks.groupBy("comparison_id").agg(F.count_if(F.col("low") == "TARGET").alias("target_blocks"), F.count_if(F.col("low") == "BACKGROUND").alias("background_blocks"))


def label_coverage(labels: DataFrame, memberships: DataFrame) -> DataFrame:
    """Every label with the number of different proteins that have it."""
    counts = memberships.groupBy("label_id").agg(F.count_distinct("protein_id").alias("observed_proteins"))
    return labels.join(counts, "label_id", "left").fillna(0, ["observed_proteins"])


def role_coverage(labels: DataFrame, memberships: DataFrame) -> DataFrame:
    """Different proteins by component role of their labels; labels without a role do not count."""
    roles = labels.filter(F.coalesce("component_role", F.lit("")) != "").select("label_id", "component_role")
    return memberships.join(F.broadcast(roles), "label_id").groupBy("component_role").agg(F.count_distinct("protein_id").alias("proteins"))


def structure_sources(structures: DataFrame) -> DataFrame:
    """Models and their mean confidence, to two places, by source and states."""
    by = ["structure_source", "availability_status", "analysis_eligibility_status", "fold_evidence_status"]
    return structures.groupBy(*by).agg(F.count("*").alias("models"), F.round(F.avg("mean_confidence"), 2).alias("mean_confidence"))


def fold_counts(structures: DataFrame) -> DataFrame:
    """Different proteins by fold."""
    return structures.filter(F.coalesce("fold_id", F.lit("")) != "").groupBy("fold_authority", "fold_id", "fold_name").agg(F.count_distinct("protein_id").alias("proteins"))


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Per structure cluster: members of discovery, projected ones, all, and edges."""
    return clusters.groupBy("cluster_id").agg(
        F.max("reference_member_count").alias("discovery_members"), F.count_if(F.col("membership_method") == "VALIDATION_PROJECTION").alias("projected_members"),
        F.max("member_count").alias("total_members"), F.max("edge_count").alias("discovery_edges"),
    )


def score_density(comparisons: DataFrame, width: int = 20) -> DataFrame:
    """Comparisons by tool, in bins of 1/``width`` of the smaller coverage and of the score."""
    bin_of = lambda c: F.round(F.floor(c * width) / width, 2)
    rows = comparisons.filter("tm_score is not null and coverage_a is not null and coverage_b is not null")
    return rows.groupBy("comparison_tool", bin_of(F.least("coverage_a", "coverage_b")).alias("minimum_coverage_bin"), bin_of(F.col("tm_score")).alias("tm_score_bin")).agg(F.count("*").alias("comparisons"))


def assessment_coverage(assessments: DataFrame) -> DataFrame:
    """Different features and proteins of a ledger by type, state and scope."""
    return assessments.groupBy("feature_type", "evidence_status", "derivation_scope").agg(F.count_distinct("feature_id").alias("features"), F.count_distinct("protein_id").alias("proteins"))


def domain_coverage(assessments: DataFrame, states: Sequence[str] = ("ASSESSED_WITH_HIT", "ASSESSED_NO_HIT", "NOT_ASSESSED", "FAILED")) -> DataFrame:
    """Proteins by domain authority, a column for each state."""
    return assessments.groupBy("domain_authority").pivot("assessment_status", list(states)).agg(F.count(F.lit(1))).fillna(0)


def curation_coverage(assignments: DataFrame) -> DataFrame:
    """Different proteins and assignments by curation status."""
    return assignments.groupBy("curation_status").agg(F.count_distinct("protein_id").alias("proteins"), F.count("*").alias("assignments"))


def acquisition_coverage(acquisitions: DataFrame) -> DataFrame:
    """Proteins and their mean confidence, to two places, by acquisition status."""
    return acquisitions.groupBy("acquisition_status").agg(F.count("*").alias("proteins"), F.round(F.avg("mean_confidence"), 2).alias("mean_confidence"))


def block_summary(associations: DataFrame) -> DataFrame:
    """The largest block counts of each comparison and partition."""
    return associations.groupBy("comparison_id", "partition").agg(F.max("target_blocks").alias("target_blocks"), F.max("background_blocks").alias("background_blocks"))


def orthology_metrics(memberships: DataFrame, partitions: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row: different groups (by run, type, node and id), different blocks, and clusters of near-redundancy."""
    group = F.struct("run_id", "group_type", "hierarchy_node", "group_id")
    one = memberships.agg(F.count_distinct(group).alias("groups")).crossJoin(partitions.agg(F.count_distinct("partition_key").alias("blocks")))
    return one.crossJoin(clusters.filter("cluster_type = 'NEAR_REDUNDANCY'").agg(F.count_distinct("cluster_id").alias("near_redundancy_clusters")))


def partition_units(partitions: DataFrame) -> DataFrame:
    """Proteins and blocks by partition and kind of unit."""
    return partitions.groupBy("partition", "partition_unit").agg(F.count("*").alias("proteins"), F.count_distinct("partition_key").alias("blocks"))


def direct_label_counts(memberships: DataFrame, top: int = 40) -> DataFrame:
    """The labels that most proteins have directly."""
    return memberships.filter("membership_source = 'DIRECT'").groupBy("label_id").agg(F.count("*").alias("proteins")).orderBy(F.desc("proteins"), "label_id").limit(top)


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): rows by equal bins from ``low`` to ``high``; bin 0 lies below, the last above, and ``high`` itself is in the last but one."""
    at = F.when(F.col(value) == high, F.lit(bins)).otherwise(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)))
    return df.filter(F.col(value).isNotNull()).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_values, rows): different texts that are not empty, and all rows, of each column; one pass over the table."""
    some = df.agg(*[F.count_distinct(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(f"d{k}") for k, c in enumerate(columns)], F.count("*").alias("rows"))
    return some.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{k}").alias("distinct_values")) for k, c in enumerate(columns)])).alias("z"), "rows").select("z.column", "z.distinct_values", "rows")


# -- signatures --------------------------------------------------------------------------------------------------


def tier_signatures(signatures: DataFrame, tier: str, fdr: float = 0.05) -> DataFrame:
    """The signatures that reach an evidence tier, by its q, then falling difference, type and id."""
    q, difference, classes = TIERS[tier]
    kind = F.col("evidence_class").isin(*classes) if classes else F.col("evidence_class").startswith(CANDIDATE)
    return signatures.filter((F.col(q) <= fdr) & (F.col(difference) > 0) & (F.col("status") == "COMPLETE") & kind).orderBy(q, F.desc(difference), *FEATURE)


def plot_points(signatures: DataFrame) -> DataFrame:
    """Signatures with a q in [0, 1] and an effect in [-1, 1]: the negative logarithm of q, and whether q was raised to the least that is drawn."""
    q, effect = F.col("discovery_q_value"), F.col("discovery_prevalence_difference")
    rows = signatures.filter(q.between(0, 1) & ~F.isnan(q) & effect.between(-1, 1) & ~F.isnan(effect))
    return rows.withColumns({"q_clipped": q < Q_FLOOR, "negative_log10_q": -F.log10(F.greatest(q, F.lit(Q_FLOOR)))})


def ranked_signatures(signatures: DataFrame, comparisons: Sequence[str], top: int, limit: int = 5000, fdr: float = 0.05) -> DataFrame:
    """The best ``top`` enriched candidates of each of the comparisons, ranked by q (null last), falling effect and key; ``limit`` rows in all."""
    rows = signatures.filter(F.col("comparison_id").isin(*comparisons) & enriched(fdr) & F.col("evidence_class").startswith(CANDIDATE))
    rank = F.row_number().over(Window.partitionBy("comparison_id").orderBy(F.asc_nulls_last("discovery_q_value"), F.desc("discovery_prevalence_difference"), *FEATURE))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top).orderBy("rank", "comparison_id").limit(limit)


def top_signatures(signatures: DataFrame, n: int = 100) -> DataFrame:
    """The first signatures by study-wide held-out q, then held-out q, then discovery q, nulls last."""
    return signatures.orderBy(*[F.asc_nulls_last(c) for c in ("validation_study_q_value", "validation_q_value", "discovery_q_value")], "comparison_id", *FEATURE).limit(n)


def top_prevalence(signatures: DataFrame, n: int = 25) -> DataFrame:
    """The signatures of the largest discovery effects, whatever their sign."""
    return signatures.filter("status = 'COMPLETE'").orderBy(F.desc(F.abs("discovery_prevalence_difference")), "comparison_id", *FEATURE).limit(n)


def top_contributions(explanations: DataFrame, n: int = 30, value: str = "log_odds_contribution") -> DataFrame:
    """The features of the largest mean absolute contribution (or coefficient), with it."""
    means = explanations.groupBy(*FEATURE).agg(F.avg(F.abs(value)).alias("mean_absolute"))
    return means.orderBy(F.desc("mean_absolute"), *FEATURE).limit(n)


def signature_view(signatures: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Signatures with the display name of their comparison."""
    return signatures.join(comparisons.select("comparison_id", "display_name"), "comparison_id", "left")


def validation_of_signatures(associations: DataFrame, signatures: DataFrame) -> DataFrame:
    """The association rows, of both partitions, of every feature that is a signature."""
    return associations.join(signatures.select("comparison_id", *FEATURE).distinct(), ["comparison_id", *FEATURE])


def feature_text(features: DataFrame) -> DataFrame:
    """Add what a feature means (explanation) and a short label; k-mers are written out residue by residue.

    ``features``: feature_type, feature_id, feature_name.
    """
    kind, key = F.col("feature_type"), F.col("feature_id")
    name = F.coalesce(F.nullif(F.col("feature_name"), F.lit("")), key)
    motif = F.regexp_extract(key, "^k([0-9]+):([A-Z]+)$", 2)
    good = (kind == "AMINO_ACID_KMER") & (motif != "") & (F.length(motif).cast("string") == F.regexp_extract(key, "^k([0-9]+):([A-Z]+)$", 1))
    names = F.create_map(*[F.lit(x) for pair in RESIDUES.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(motif, ""), lambda r: F.coalesce(names[r], r)), "-")
    explanation = (
        F.when(good, F.concat(F.lit("The exact residues "), motif, F.lit(" ("), spelled, F.lit(") somewhere in a protein."))).when(kind == "AMINO_ACID_KMER", "An exact short run of residues somewhere in a protein.")
        .when(kind == "STRUCTURE_CLUSTER", "A cluster of whole models of similar structure.").when(kind.isin("PFAM_DOMAIN", "DOMAIN"), F.concat(F.lit("A sequence domain: "), name, F.lit(".")))
        .when(kind.isin("PFAM_ARCHITECTURE", "DOMAIN_ARCHITECTURE"), "The domains of a protein in their order.").when(kind.isin("FOLD", "STRUCTURE_FOLD"), F.concat(F.lit("The fold of a whole model: "), name, F.lit("."))).otherwise(name)
    )
    label = F.when(good, F.concat_ws(" ", motif, spelled)).when(kind == "STRUCTURE_CLUSTER", F.concat(F.lit("Model cluster "), key)).otherwise(F.substring(F.concat_ws(" ", name, key), 1, 75))
    return features.withColumns({"explanation": explanation, "label": label})


# -- lookups -----------------------------------------------------------------------------------------------------


def select_by_key(df: DataFrame, key: str, value: object, order: Sequence[str]) -> DataFrame:
    """The rows of one key in order."""
    return df.filter(F.col(key) == value).orderBy(*order)


def filtered_features(features: DataFrame, types: Sequence[str] = (), protein: object = None, text: str = "", cap: int = 250_000) -> DataFrame:
    """Features of given types, of a protein, or whose id or name holds a text, in order; one filter at least, and more rows than ``cap`` are an error."""
    if not types and protein is None and not text:
        raise ValueError("give a filter")
    rows = features
    if types:
        rows = rows.filter(F.col("feature_type").isin(*types))
    if protein is not None:
        rows = rows.filter(F.col("protein_id") == protein)
    if text:
        rows = rows.filter(F.contains("feature_id", F.lit(text)) | F.contains("feature_name", F.lit(text)))
    if rows.limit(cap + 1).count() > cap:
        raise ValueError(f"more than {cap} rows; filter further")
    return rows.orderBy("protein_id", *FEATURE, *[c for c in ("start", "stop") if c in features.columns])


def bounded_preview(df: DataFrame, order: Sequence[str], rows: int, skip: int = 0, most: int = 5000) -> DataFrame:
    """A page of a table in order; pages hold 1 to ``most`` rows."""
    if not 1 <= rows <= most or skip < 0:
        raise ValueError(f"a page holds 1 to {most} rows")
    return df.orderBy(*order).offset(skip).limit(rows)


def seed_proteins(proteins: DataFrame, tables: dict[str, tuple[DataFrame, str]], selection: str, values: Sequence[object], cap: int = 1000) -> DataFrame:
    """The proteins that a selection names: through ``tables[selection]``, a table of protein ids and the column of the values.

    A value that the table lacks, no protein, and more than ``cap`` of them are errors.
    """
    rows, column = tables[selection]
    found = rows.filter(F.col(column).isin(*values))
    known = {r[0] for r in found.select(column).distinct().collect()}
    if missing := sorted(str(v) for v in values if v not in known):
        raise ValueError(f"unknown values: {missing[:10]}")
    chosen = proteins.join(found.select("protein_id").distinct(), "protein_id", "left_semi")
    n = chosen.limit(cap + 1).count()
    if not 0 < n <= cap:
        raise ValueError(f"a selection of 1 to {cap} proteins is needed")
    return chosen.orderBy("protein_id")


def enriched_intervals(features: DataFrame, signatures: DataFrame, comparison: str, tier: str = "discovery", fdr: float = 0.05) -> DataFrame:
    """(protein_id, feature_type, feature_id, start, stop, q_value, difference): features with a place, and k-mers, that are signatures of a comparison in a tier."""
    q, difference, _ = TIERS[tier]
    chosen = tier_signatures(signatures, tier, fdr).filter(F.col("comparison_id") == comparison).select(*FEATURE, F.col(q).alias("q_value"), F.col(difference).alias("difference"))
    placed = features.filter((F.col("feature_type") == "AMINO_ACID_KMER") | (F.col("start").isNotNull() & F.col("stop").isNotNull()))
    return placed.select("protein_id", *FEATURE, "start", "stop").join(chosen, FEATURE)


def model_proteins(structures: DataFrame, memberships: DataFrame, labels: Sequence[str], top: int = 5000) -> DataFrame:
    """(protein_id, model_confidence): proteins of the labels that have coordinates, the most confident first."""
    rows = structures.filter(F.coalesce("coordinate_path", F.lit("")) != "").join(memberships.filter(F.col("label_id").isin(*labels)).select("protein_id").distinct(), "protein_id", "left_semi")
    return rows.groupBy("protein_id").agg(F.max("mean_confidence").alias("model_confidence")).orderBy(F.desc_nulls_last("model_confidence"), "protein_id").limit(top)


def partners(comparisons: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, partner_id, comparison_tool, tm_score): the comparisons of some proteins, whichever end they are."""
    columns = ["comparison_tool", "tm_score"]
    both = comparisons.select(F.col("protein_a_id").alias("protein_id"), F.col("protein_b_id").alias("partner_id"), *columns).unionByName(comparisons.select(F.col("protein_b_id").alias("protein_id"), F.col("protein_a_id").alias("partner_id"), *columns))
    return both.join(proteins.select("protein_id").distinct(), "protein_id", "left_semi")


def kmer_intervals(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, feature_id, start, stop) of every occurrence of the k-mers ``k<length>:<residues>`` of some feature rows in the sequences; ids of another form give none."""
    motif = F.regexp_extract("feature_id", "^k[0-9]+:([A-Z]+)$", 1)
    good = rows.select("protein_id", "feature_id", motif.alias("motif")).filter(F.col("motif") != "").filter(F.regexp_extract("feature_id", "^k([0-9]+):", 1) == F.length("motif").cast("string"))
    joined = good.join(proteins.select("protein_id", "sequence"), "protein_id")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("sequence") - F.length("motif") + 1)), lambda i: F.col("sequence").substr(i, F.length("motif")) == F.col("motif"))
    return joined.select("protein_id", "feature_id", F.explode(starts).alias("start"), "motif").select("protein_id", "feature_id", F.col("start").cast("long").alias("start"), (F.col("start") + F.length("motif") - 1).cast("long").alias("stop"))


def enrichment_track(intervals: DataFrame, proteins: DataFrame, threshold: float = 0.05, floor: float = 1e-8) -> DataFrame:
    """(protein_id, position, q_value, score) of every position: the least q of the positive, significant intervals over it, and a score.

    The score is 0 where there is none, else 0.1 at the threshold rising with the logarithm of q to 1 at ``floor``. Intervals outside the sequence, and those that are not significant, do not count.
    ``intervals``: protein_id, start, stop, q_value, difference; ``proteins``: protein_id, length.
    """
    ok = (F.col("q_value").between(0, threshold)) & (F.col("difference") > 0) & (F.col("start") >= 1) & (F.col("start") <= F.col("stop")) & (F.col("stop") <= F.col("length"))
    covered = intervals.join(proteins.select("protein_id", "length"), "protein_id").filter(ok).select("protein_id", F.explode(F.sequence("start", "stop")).alias("position"), "q_value")
    least = covered.groupBy("protein_id", "position").agg(F.min("q_value").alias("q_value"))
    every = proteins.select("protein_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("length").cast("long"))).alias("position"))
    rows = every.join(least, ["protein_id", "position"], "left")
    low, high = -F.log10(F.lit(threshold)), -F.log10(F.lit(floor))
    scaled = (-F.log10(F.greatest("q_value", F.lit(floor))) - low) / (high - low)
    return rows.withColumn("score", F.when(F.col("q_value").isNull(), 0.0).otherwise(0.1 + 0.9 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled))))


def feature_tracks(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(sequence_id, accession, description, start, stop): rows with a place, of the very sequence they were made for.

    ``rows``: sequence_id, sequence_sha256, accession, description, start, stop; rows of a known id but another sequence, and places outside it, are errors.
    """
    joined = rows.join(proteins.select("sequence_id", F.sha2("sequence", 256).alias("_own"), F.length("sequence").alias("_length")), "sequence_id")
    require_empty(joined.filter(F.col("sequence_sha256") != F.col("_own")), "features of another version of the sequence")
    placed = joined.filter(F.col("start").isNotNull() | F.col("stop").isNotNull())
    require_empty(placed.filter(F.coalesce((F.col("start") < 1) | (F.col("start") > F.col("stop")) | (F.col("stop") > F.col("_length")), F.lit(True))), "features outside the sequence")
    return placed.select("sequence_id", "accession", "description", "start", "stop")
