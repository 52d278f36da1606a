"""Tables of other tools as DataFrames, with the rules that their rows must meet.

Each ``*_violations`` function returns what breaks a rule as rows with a column ``problem``, so a caller may raise, report or filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.operators.checks import require_empty
from cohortry.sources.readers import read_fasta
from cohortry.storage import materialize

DIGEST = "^[0-9a-f]{64}$"
CURATION = ("REVIEWED_POSITIVE", "EVIDENCE_SUPPORTED_POSITIVE", "REVIEWED_NEGATIVE", "PROPOSED", "AMBIGUOUS", "UNMAPPED", "EXCLUDED", "REJECTED")
FEATURE_STATES = ("ASSESSED_WITH_FEATURE", "ASSESSED_NO_FEATURE", "NOT_ASSESSED", "FAILED", "EXCLUDED", "INPUT_UNAVAILABLE")
SCOPES = ("FIXED_EXTERNAL", "DISCOVERY_DERIVED", "DISCOVERY_SUPERVISED", "ALL_DATA_EXPLORATORY")
DOMAIN_STATES = ("ASSESSED_WITH_HIT", "ASSESSED_NO_HIT", "NOT_ASSESSED", "FAILED")
PAIR_STATES = ("COMPLETE", "SUCCESS", "PASS", "FAILED", "NOT_ASSESSED", "INPUT_UNAVAILABLE", "EXCLUDED")
SUCCESS = ("COMPLETE", "SUCCESS", "PASS")


def _first_problem(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """The rows that break a rule, with the first they break; an unknown outcome breaks it too."""
    problem = F.coalesce(*[F.when(F.coalesce(rule, F.lit(True)), name) for name, rule in rules])
    return df.withColumn("problem", problem).filter("problem is not null").select(*keys, "problem")


def _repeated(df: DataFrame, keys: Sequence[str], problem: str, show: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*[F.col(c) if c in keys else F.lit(None).alias(c) for c in show], F.lit(problem).alias("problem"))


def _known(df: DataFrame, key: str, authority: DataFrame, flag: str) -> DataFrame:
    return df.join(authority.select(F.col(key)).distinct().withColumn(flag, F.lit(True)), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


# -- sequences -----------------------------------------------------------------------------------------------------


def read_strict_fasta(spark: SparkSession, path: str, most: int = 100_000) -> DataFrame:
    """(sequence_id, sequence, sequence_length, sequence_sha256) of unaligned proteins: letters but J, no gaps or stops, ``most`` residues, ids once; else an error."""
    rows = read_fasta(spark, path).select(F.col("protein_id").alias("sequence_id"), "sequence", "sequence_length", "sequence_sha256")
    require_empty(strict_fasta_violations(rows, most), "FASTA records")
    return rows


def strict_fasta_violations(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """(sequence_id, problem) of sequence_id, sequence."""
    rules = [("EMPTY_ID", F.coalesce(F.col("sequence_id").cast("string"), F.lit("")) == ""), ("EMPTY_SEQUENCE", F.coalesce("sequence", F.lit("")) == ""), ("BAD_RESIDUE", ~F.col("sequence").rlike("^[A-IK-Z]+$")), ("TOO_LONG", F.length("sequence") > most)]
    return _first_problem(rows, ["sequence_id"], rules).unionByName(_repeated(rows, ["sequence_id"], "REPEATED_ID", ["sequence_id"]))


def read_alignment(spark: SparkSession, path: str) -> DataFrame:
    """(sequence_id, sequence) of an aligned FASTA; rows of different lengths, fewer than two rows, rows of gaps only and repeated ids are errors."""
    rows = read_fasta(spark, path).select(F.col("protein_id").alias("sequence_id"), "sequence")
    require_empty(alignment_violations(rows), "aligned FASTA")
    return rows


def alignment_violations(rows: DataFrame) -> DataFrame:
    """(sequence_id, problem) of aligned rows."""
    rules = [("BAD_RESIDUE", ~F.col("sequence").rlike(r"^[A-IK-Z\-]+$")), ("ONLY_GAPS", F.regexp_replace("sequence", "-", "") == "")]
    found = _first_problem(rows, ["sequence_id"], rules).unionByName(_repeated(rows, ["sequence_id"], "REPEATED_ID", ["sequence_id"]))
    whole = rows.agg(F.count("*").alias("n"), F.count_distinct(F.length("sequence")).alias("widths"))
    none = F.lit(None).cast(rows.schema["sequence_id"].dataType).alias("sequence_id")
    return found.unionByName(whole.filter("n < 2").select(none, F.lit("TOO_FEW_ROWS").alias("problem"))).unionByName(whole.filter("widths > 1").select(none, F.lit("ROWS_OF_DIFFERENT_LENGTH").alias("problem")))


def mean_confidence(files: DataFrame) -> DataFrame:
    """(path, mean_confidence) of model files, one a row (path, content): the mean B-factor of the CA atoms of the first model, null without any.

    Fixed columns; alternate places other than the first, and values outside 0 to 100, do not count.
    """
    first = F.split(F.col("content"), r"(?m)^ENDMDL")[0]
    lines = files.select("path", F.explode(F.split(first, r"\r?\n")).alias("line")).filter(F.col("line").startswith("ATOM") & (F.trim(F.substring("line", 13, 4)) == "CA") & F.substring("line", 17, 1).isin(" ", "A"))
    value = F.trim(F.substring("line", 61, 6)).try_cast("double")
    means = lines.select("path", value.alias("v")).filter(F.col("v").between(0, 100)).groupBy("path").agg(F.avg("v").alias("mean_confidence"))
    return files.select("path").distinct().join(means, "path", "left")


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of text files, one a row."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


# -- tables of a cohort --------------------------------------------------------------------------------------------


def label_violations(rows: DataFrame, proteins: DataFrame, labels: DataFrame) -> DataFrame:
    """(protein_id, label_id, problem) of protein_id, label_id, curation_status."""
    known = _known(_known(rows, "protein_id", proteins, "_p"), "label_id", labels, "_l")
    rules = [("UNKNOWN_PROTEIN", ~F.col("_p")), ("UNKNOWN_LABEL", ~F.col("_l")), ("UNKNOWN_STATUS", ~F.upper(F.trim("curation_status")).isin(*CURATION))]
    return _first_problem(known, ["protein_id", "label_id"], rules).unionByName(_repeated(rows, ["protein_id", "label_id"], "REPEATED_ASSIGNMENT", ["protein_id", "label_id"]))


def ledger_violations(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id, problem) of an assessment ledger: protein_id, feature_type, feature_id, feature_name, start, stop, evidence_status, derivation_scope, feature_definition_sha256, derivation_cohort_sha256.

    ``proteins``: protein_id, sequence_length. Places stand on positive rows only and inside the sequence; digests have 64 digits, the cohort's is empty for fixed definitions; a feature has one
    definition, a protein and feature one state.
    """
    key = ["protein_id", "feature_type", "feature_id"]
    joined = rows.join(proteins.select("protein_id", "sequence_length"), "protein_id", "left")
    s, e, state = F.col("start"), F.col("stop"), F.upper(F.trim("evidence_status"))
    placed = s.isNotNull() | e.isNotNull()
    outside = placed & F.coalesce((s < 1) | (s > e) | (e > F.col("sequence_length")), F.lit(True))
    digest = F.coalesce(F.col("derivation_cohort_sha256"), F.lit(""))
    rules = [
        ("UNKNOWN_PROTEIN", F.col("sequence_length").isNull()), ("UNKNOWN_STATUS", ~state.isin(*FEATURE_STATES)), ("PLACE_OUTSIDE", outside), ("PLACE_WITHOUT_FEATURE", placed & (state != "ASSESSED_WITH_FEATURE")),
        ("UNKNOWN_SCOPE", ~F.col("derivation_scope").isin(*SCOPES)), ("BAD_DEFINITION_DIGEST", ~F.col("feature_definition_sha256").rlike(DIGEST)),
        ("BAD_COHORT_DIGEST", F.when(F.col("derivation_scope") == "FIXED_EXTERNAL", digest != "").otherwise(~digest.rlike(DIGEST))),
    ]
    found = _first_problem(joined, key, rules)
    none = F.lit(None).cast(rows.schema["protein_id"].dataType).alias("protein_id")
    definition = F.struct("feature_name", "derivation_scope", "feature_definition_sha256", "derivation_cohort_sha256")
    several = rows.groupBy("feature_type", "feature_id").agg(F.count_distinct(definition).alias("_n")).filter("_n > 1").select(none, "feature_type", "feature_id", F.lit("SEVERAL_DEFINITIONS").alias("problem"))
    states = rows.groupBy(*key).agg(F.count_distinct(state).alias("_n")).filter("_n > 1").select(*key, F.lit("SEVERAL_STATES").alias("problem"))
    again = rows.groupBy(*key, "start", "stop").agg(F.count("*").alias("_n")).filter("_n > 1").select(*key, F.lit("REPEATED_ROW").alias("problem"))
    return found.unionByName(several).unionByName(states).unionByName(again)


def split_domains(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, assessments) of one table of both: rows with a domain are hits, and each protein and authority has one state and its number of hits.

    ``rows``: protein_id, domain_authority, assessment_status, domain_id, start, stop.
    """
    has = F.coalesce(F.trim("domain_id"), F.lit("")) != ""
    hits = rows.filter(has).select("protein_id", "domain_authority", "domain_id", "start", "stop")
    return hits, rows.groupBy("protein_id", "domain_authority").agg(F.min("assessment_status").alias("assessment_status"), F.count_if(has).alias("hit_count"))


def domain_violations(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, domain_authority, problem) of the same table; ``proteins``: protein_id, sequence_length."""
    key = ["protein_id", "domain_authority"]
    has = F.coalesce(F.trim("domain_id"), F.lit("")) != ""
    joined = rows.join(proteins.select("protein_id", "sequence_length"), "protein_id", "left").withColumn("_has", has)
    hit = F.col("assessment_status") == "ASSESSED_WITH_HIT"
    outside = F.col("_has") & F.coalesce((F.col("start") < 1) | (F.col("start") > F.col("stop")) | (F.col("stop") > F.col("sequence_length")), F.lit(True))
    rules = [
        ("UNKNOWN_PROTEIN", F.col("sequence_length").isNull()), ("UNKNOWN_STATUS", ~F.col("assessment_status").isin(*DOMAIN_STATES)), ("HIT_WITHOUT_DOMAIN", hit & ~F.col("_has")), ("DOMAIN_WITHOUT_HIT", ~hit & F.col("_has")), ("PLACE_OUTSIDE", outside),
    ]
    found = _first_problem(joined, key, rules)
    states = rows.groupBy(*key).agg(F.count_distinct("assessment_status").alias("_n")).filter("_n > 1").select(*key, F.lit("SEVERAL_STATES").alias("problem"))
    again = rows.filter(has).groupBy(*key, "domain_id", "start", "stop").agg(F.count("*").alias("_n")).filter("_n > 1").select(*key, F.lit("REPEATED_HIT").alias("problem"))
    return found.unionByName(states).unionByName(again)


def structure_violations(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(structure_id, problem) of a structure table: availability against path, eligibility against both and confidence, folds against their state, one release an authority."""
    known = _known(rows, "protein_id", proteins, "_p")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    path = text("coordinate_path") != ""
    available = F.col("availability_status").isin("AVAILABLE", "COMPLETE")
    state, fold, confidence = F.col("analysis_eligibility_status"), F.col("fold_evidence_status"), F.col("mean_confidence")
    named = (text("fold_authority") != "") & (text("fold_authority_version") != "")
    rules = [
        ("UNKNOWN_PROTEIN", ~F.col("_p")), ("PATH_AND_STATUS_DIFFER", path != available), ("CONFIDENCE_OUT_OF_RANGE", confidence.isNotNull() & ~confidence.between(0, 100)), ("ELIGIBLE_WITHOUT_FILE", (state == "ELIGIBLE") & ~path),
        ("EXTERNAL_WITH_FILE", (state == "NOT_APPLICABLE_EXTERNAL_EVIDENCE") & path), ("UNAVAILABLE_WITH_FILE", (state == "INELIGIBLE_COORDINATE_UNAVAILABLE") & path), ("LOW_CONFIDENCE_WITHOUT_VALUE", (state == "INELIGIBLE_LOW_CONFIDENCE") & confidence.isNull()),
        ("NO_CONFIDENCE_WITH_VALUE", (state == "INELIGIBLE_CONFIDENCE_UNAVAILABLE") & confidence.isNotNull()), ("HIT_WITHOUT_FOLD", (fold == "ASSESSED_WITH_HIT") & ~((text("fold_id") != "") & named)), ("FOLD_WITHOUT_HIT", (fold != "ASSESSED_WITH_HIT") & ((text("fold_id") != "") | (text("fold_name") != ""))),
        ("ASSESSED_WITHOUT_AUTHORITY", fold.isin("ASSESSED_NO_HIT", "FAILED") & ~named), ("AUTHORITY_WITHOUT_ASSESSMENT", fold.isin("NOT_ASSESSED", "INPUT_UNAVAILABLE") & ((text("fold_authority") != "") | (text("fold_authority_version") != ""))),
    ]
    found = _first_problem(known, ["structure_id"], rules).unionByName(_repeated(rows, ["structure_id"], "REPEATED_ID", ["structure_id"]))
    several = rows.filter(text("fold_authority") != "").groupBy("fold_authority").agg(F.count_distinct("fold_authority_version").alias("_n")).filter("_n > 1").select("fold_authority")
    return found.unionByName(rows.join(several, "fold_authority", "left_semi").select("structure_id", F.lit("SEVERAL_RELEASES").alias("problem")))


def canonical_comparisons(rows: DataFrame) -> DataFrame:
    """Comparisons with the smaller protein first; the coverages follow their ends."""
    keep = F.col("protein_a_id") <= F.col("protein_b_id")
    side = lambda x, y: F.when(keep, F.col(x)).otherwise(F.col(y))
    made = {"protein_a_id": F.least("protein_a_id", "protein_b_id"), "protein_b_id": F.greatest("protein_a_id", "protein_b_id"), "coverage_a": side("coverage_a", "coverage_b"), "coverage_b": side("coverage_b", "coverage_a")}
    return rows.select(*[made[c].alias(c) if c in made else F.col(c) for c in rows.columns])


def comparison_violations(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(source_record_id, problem): self pairs, unknown ends, unknown states, successes without score or coverages, failures with any, values out of range, repeated records."""
    known = _known(_known(rows, "protein_a_id", proteins.select(F.col("protein_id").alias("protein_a_id")), "_a"), "protein_b_id", proteins.select(F.col("protein_id").alias("protein_b_id")), "_b")
    metrics = ["tm_score", "coverage_a", "coverage_b"]
    done = F.col("comparison_status").isin(*SUCCESS)
    missing, there, out = F.lit(False), F.lit(False), F.lit(False)
    for m in metrics:
        missing, there = missing | F.col(m).isNull(), there | F.col(m).isNotNull()
        out = out | F.coalesce(~F.col(m).between(0, 1), F.lit(False))
    rules = [("SELF_PAIR", F.col("protein_a_id") == F.col("protein_b_id")), ("UNKNOWN_PROTEIN", ~F.col("_a") | ~F.col("_b")), ("UNKNOWN_STATUS", ~F.col("comparison_status").isin(*PAIR_STATES)), ("SUCCESS_WITHOUT_METRICS", done & missing), ("FAILURE_WITH_METRICS", ~done & there), ("OUT_OF_RANGE", out)]
    ends = ["protein_a_id", "protein_b_id", "comparison_tool", "source_record_id"]
    again = canonical_comparisons(rows).groupBy(*ends).agg(F.count("*").alias("_n")).filter("_n > 1").select("source_record_id", F.lit("REPEATED_RECORD").alias("problem"))
    return _first_problem(known, ["source_record_id"], rules).unionByName(again)


def redundancy_violations(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, problem) of protein_id, cluster_id, identity_threshold, coverage_threshold: unknown or repeated proteins, thresholds that are missing or outside 0 to 1."""
    known = _known(rows, "protein_id", proteins, "_p")
    rules = [("UNKNOWN_PROTEIN", ~F.col("_p")), ("BAD_IDENTITY", ~F.col("identity_threshold").between(0, 1)), ("BAD_COVERAGE", ~F.col("coverage_threshold").between(0, 1))]
    return _first_problem(known, ["protein_id"], rules).unionByName(_repeated(rows, ["protein_id"], "REPEATED_PROTEIN", ["protein_id"]))


def accession_map(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, accession), upper-cased; unknown proteins and two accessions of one are errors."""
    require_empty(rows.join(proteins, "protein_id", "left_anti"), "accessions of unknown proteins")
    require_empty(rows.groupBy("protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "proteins of several accessions")
    return rows.select("protein_id", F.upper(F.trim("accession")).alias("accession"))


# -- groups --------------------------------------------------------------------------------------------------------


def resource_members(memberships: DataFrame, aliases: DataFrame, group_type: str, node: str, run: str | None = None) -> DataFrame:
    """(run_id, group_type, hierarchy_node, group_id, protein_id): members of one type and node that are a protein by ``aliases`` (member, protein_id); two groups of one protein are an error."""
    rows = memberships.filter((F.col("group_type") == group_type) & (F.col("hierarchy_node") == node))
    if run is not None:
        rows = rows.filter(F.col("run_id") == run)
    key = ["run_id", "group_type", "hierarchy_node", "group_id"]
    found = rows.join(aliases.filter("protein_id is not null"), "member").select(*key, "protein_id").distinct()
    require_empty(found.groupBy("protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "proteins in several groups")
    return found


def group_context(memberships: DataFrame, statistics: DataFrame, distances: DataFrame | None = None) -> DataFrame:
    """Statistics of the groups that have members here, with distance statistics where there are any; a group without statistics is an error.

    Keys: run_id, group_type, hierarchy_node, group_id. Without a distance table its columns median_distance and computation_status are null and empty.
    """
    key = ["run_id", "group_type", "hierarchy_node", "group_id"]
    groups = memberships.select(*key).distinct()
    require_empty(groups.join(statistics, key, "left_anti"), "groups without statistics")
    rows = statistics.join(groups, key, "left_semi")
    if distances is None:
        return rows.withColumns({"computation_status": F.lit(""), "median_distance": F.lit(None).cast("double")})
    return rows.join(distances.select(*key, "computation_status", "median_distance"), key, "left").withColumn("computation_status", F.coalesce("computation_status", F.lit("")))


def import_alignments(rows: DataFrame, proteins: DataFrame, summaries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, universes) of structural alignments against each cluster's reference.

    ``rows``: cluster_id, reference_id, mobile_id, alignment_tool, status, aligned_length, tm_score; ``proteins``: protein_id, sequence_length; ``summaries``: cluster_id, reference_id, aligned_proteins. Rows of unknown proteins are
    left out. A row of the reference against itself must be marked REFERENCE and makes it a member only. Coverage is the aligned length over the protein's, 1 at most. Another reference than declared, other self pairs, successes without
    metrics and failures with any, repeated pairs, and universes of another size than declared are errors.
    """
    length = lambda c, n: proteins.select(F.col("protein_id").alias(c), F.col("sequence_length").alias(n))
    known = rows.join(length("reference_id", "_r"), "reference_id").join(length("mobile_id", "_m"), "mobile_id")
    declared = summaries.select("cluster_id", F.col("reference_id").alias("_reference"), "aligned_proteins")
    joined = known.join(declared, "cluster_id", "left")
    require_empty(joined.filter(F.coalesce(F.col("reference_id") != F.col("_reference"), F.lit(True))), "alignments to another reference than declared")
    own = F.col("reference_id") == F.col("mobile_id")
    require_empty(joined.filter(own & ((F.col("status") != "REFERENCE") | F.col("aligned_length").isNotNull() | (F.coalesce("tm_score", F.lit(0.0)) != 1.0))), "self pairs that are no reference rows")
    done = F.col("status").isin(*SUCCESS)
    metrics = F.col("aligned_length").isNotNull() & F.col("tm_score").isNotNull()
    require_empty(joined.filter(~own & ((done & ~metrics) | (~done & (F.col("aligned_length").isNotNull() | F.col("tm_score").isNotNull())))), "alignments whose metrics contradict their status")
    key = ["cluster_id", "alignment_tool", "reference_id", "mobile_id"]
    pairs = joined.filter(~own)
    require_empty(pairs.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "repeated alignments")
    members = joined.select("cluster_id", F.explode(F.array("reference_id", "mobile_id")).alias("protein_id")).distinct()
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("n")).join(declared, "cluster_id")
    require_empty(sizes.filter("n <> aligned_proteins"), "universes of another size than declared")
    cover = lambda n: F.when(F.col("aligned_length").isNotNull(), F.least(F.lit(1.0), F.col("aligned_length") / F.col(n)))
    made = pairs.select(F.col("cluster_id").alias("comparison_universe_id"), F.col("reference_id").alias("protein_a_id"), F.col("mobile_id").alias("protein_b_id"), F.col("alignment_tool").alias("comparison_tool"), F.col("status").alias("comparison_status"), "tm_score", cover("_r").alias("coverage_a"), cover("_m").alias("coverage_b"))
    return made, members.withColumnRenamed("cluster_id", "comparison_universe_id")


def pocket_features(rows: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id, evidence_reference): the supported pocket properties of assessed pairs, for both ends, once each.

    ``rows``: cluster_id, alignment_tool, reference_id, mobile_id, status, same_position, conserved.
    """
    ids = lambda c: proteins.select(F.col("protein_id").alias(c)).distinct()
    known = rows.filter(F.upper(F.trim("status")).isin("ASSESSED", "COMPLETE", "PASS")).join(ids("reference_id"), "reference_id", "left_semi").join(ids("mobile_id"), "mobile_id", "left_semi")
    names = F.array_compact(F.array(F.when(F.col("same_position"), "SAME_3D_POCKET_POSITION"), F.when(F.col("conserved"), "CONSERVED_3D_POCKET")))
    made = known.select(F.explode(F.array("reference_id", "mobile_id")).alias("protein_id"), "cluster_id", F.concat_ws("|", "cluster_id", "alignment_tool", "reference_id", "mobile_id").alias("evidence_reference"), names.alias("names"))
    return made.select("protein_id", F.lit("STRUCTURAL_POCKET").alias("feature_type"), F.explode("names").alias("name"), "cluster_id", "evidence_reference").select("protein_id", "feature_type", F.concat_ws(":", "cluster_id", "name").alias("feature_id"), "evidence_reference").distinct()


def group_summaries(rows: DataFrame, texts: Sequence[str], counts: Sequence[str], numbers: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Summary rows with typed columns: texts (empty for null), whole numbers from 0 up, and optional numbers; missing or repeated keys and bad counts are errors."""
    made = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts], *[F.col(c).cast("string").try_cast("bigint").alias(c) for c in counts], *[F.col(c).cast("string").try_cast("double").alias(c) for c in numbers])
    bad = F.lit(False)
    for c in counts:
        bad = bad | F.col(c).isNull() | (F.col(c) < 0)
    for c in key:
        bad = bad | (F.col(c) == "")
    require_empty(made.filter(bad), "summary rows")
    require_empty(made.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "repeated summary rows")
    return made


def reduce_hits(hits: DataFrame) -> DataFrame:
    """(protein_a_id, protein_b_id, tm_score, coverage_a, coverage_b, aligned): the best hit of every unordered pair of an all-against-all search; self hits are dropped.

    ``hits``: row, query_id, target_id, query_tm, target_tm, aligned, query_length, target_length. The score is the smaller one, coverages are the aligned length over the protein's, 1 at most, and follow
    their ends. Of equal scores the first row counts, so ``row`` (of any type that has an order) must name a hit; two hits of one pair that share score and row are an error.
    """
    a_query = F.col("query_id") <= F.col("target_id")
    cover = lambda n: F.least(F.lit(1.0), F.col("aligned") / F.col(n))
    side = lambda x, y: F.when(a_query, x).otherwise(y)
    rows = hits.filter(F.col("query_id") != F.col("target_id")).select(
        F.least("query_id", "target_id").alias("protein_a_id"), F.greatest("query_id", "target_id").alias("protein_b_id"),
        F.least("query_tm", "target_tm").alias("tm_score"), "row", F.struct(side(cover("query_length"), cover("target_length")).alias("coverage_a"), side(cover("target_length"), cover("query_length")).alias("coverage_b"), "aligned").alias("h"),
    )
    pair = ["protein_a_id", "protein_b_id"]
    place = F.struct((-F.col("tm_score")).alias("falling"), "row")
    best = materialize(rows.groupBy(*pair).agg(F.min_by(F.struct("tm_score", "row", "h"), place).alias("best")), "best_hits")
    # only hits that tie with the best one in score are looked at again
    level = best.select(*pair, "best.tm_score", "best.row")
    require_empty(rows.join(level, [*pair, "tm_score", "row"]).groupBy(*pair).agg(F.count("*").alias("n")).filter("n > 1"), "search hits that share their row")
    return best.select(*pair, "best.tm_score", "best.h.coverage_a", "best.h.coverage_b", "best.h.aligned")


# -- flexible tables -----------------------------------------------------------------------------------------------


def projected_scan(df: DataFrame, required: Sequence[str], optional: dict[str, str] | None = None, allow_empty: bool = False) -> DataFrame:
    """The required columns and the optional ones (name to type), null where the table lacks them; a missing required one, or no row, is an error. Only these columns are read."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    rows = df.select(*required, *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (optional or {}).items()])
    if not allow_empty and rows.isEmpty():
        raise ValueError("the table is empty")
    return rows


def flexible_columns(df: DataFrame, choices: dict[str, Sequence[str]], optional: Sequence[str] = ()) -> DataFrame:
    """A view with set names: each takes the first of its choices that the table has, whatever their case; null texts where an optional one has none, else an error."""
    own = {c.strip().lower(): c for c in df.columns}
    picked = []
    for name, names in choices.items():
        found = next((own[n.strip().lower()] for n in names if n.strip().lower() in own), None)
        if found is None and name not in optional:
            raise ValueError(f"one of {list(names)} is needed")
        picked.append(F.lit(None).cast("string").alias(name) if found is None else F.col(f"`{found}`").alias(name))
    return df.select(*picked)


def typed_scan(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as bigint, double, boolean (true or false in any case) or string; empty texts are null, any other text that is no such value is an error."""
    made, bad = [], F.lit(False)
    for c, t in types.items():
        text = F.nullif(F.trim(c), F.lit(""))
        value = F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False) if t == "boolean" else F.col(c) if t == "string" else text.try_cast(t)
        if t == "bigint":
            value = F.when(text.rlike(r"^[+-]?[0-9]+$"), value)
        bad = bad | (text.isNotNull() & value.isNull())
        made.append(value.alias(c))
    require_empty(df.filter(bad), "cells of another type")
    return df.select(*made)


def domain_annotations(lines: DataFrame, proteins: DataFrame) -> DataFrame:
    """(sequence_id, authority, accession, description, start, stop, score) of tab-separated domain predictions (value): MD5 and length must be the protein's, places inside it.

    ``proteins``: sequence_id, sequence. Remarks are passed over; anything else that does not fit is an error.
    """
    cells = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"))
    at = lambda k: F.try_element_at("f", F.lit(k + 1))
    rows = cells.select(at(0).alias("sequence_id"), at(1).alias("md5"), at(2).try_cast("bigint").alias("length"), at(3).alias("authority"), at(4).alias("accession"), at(5).alias("description"), at(6).try_cast("bigint").alias("start"), at(7).try_cast("bigint").alias("stop"), at(8).alias("score"))
    own = proteins.select("sequence_id", F.md5(F.col("sequence").cast("binary")).alias("_md5"), F.length("sequence").alias("_length"))
    joined = rows.join(own, "sequence_id", "left")
    good = (F.lower("md5") == F.col("_md5")) & (F.col("length") == F.col("_length")) & (F.col("start") >= 1) & (F.col("start") <= F.col("stop")) & (F.col("stop") <= F.col("_length"))
    require_empty(joined.filter(~F.coalesce(good, F.lit(False))), "domain predictions that do not fit their protein")
    return joined.select("sequence_id", "authority", "accession", "description", "start", "stop", "score")


def orthology_annotations(lines: DataFrame, proteins: DataFrame) -> DataFrame:
    """(sequence_id, accession, description, score) of an annotation table (value) whose heading begins with ``#query``; unknown proteins and rows of another width are errors."""
    head = lines.filter(F.col("value").startswith("#query\t")).select(F.split(F.substring("value", 2, 100_000), "\t").alias("names")).limit(1)
    names = [r["names"] for r in head.collect()]  # one heading
    if not names:
        raise ValueError("the table has no heading")
    cells = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.split("value", "\t", -1).alias("f"))
    require_empty(cells.filter(F.size("f") != len(names[0])), "rows of another width")
    at = lambda name: F.col("f")[names[0].index(name)] if name in names[0] else F.lit("")
    rows = cells.select(at("query").alias("sequence_id"), at("seed_ortholog").alias("accession"), at("Description").alias("description"), at("score").alias("score"))
    require_empty(rows.join(proteins, "sequence_id", "left_anti"), "annotations of unknown proteins")
    return rows


def domain_table(lines: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, assessment_status, domain_id, domain_name, start, stop, score, e_value) of a domain table of blank-separated fields (value); proteins without a hit get a row ASSESSED_NO_HIT.

    ``proteins``: protein_id, sequence_length. Fewer than 22 fields, unknown proteins, places outside them and accessions that are no domain family are errors.
    """
    cells = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.split(F.trim("value"), r"\s+", 23).alias("f"))
    at = lambda k: F.try_element_at("f", F.lit(k + 1))
    rows = cells.select(at(3).alias("protein_id"), F.split(at(1), r"\.")[0].alias("domain_id"), at(0).alias("domain_name"), at(17).try_cast("bigint").alias("start"), at(18).try_cast("bigint").alias("stop"), at(13).alias("score"), at(12).alias("e_value"), F.size("f").alias("_n"))
    joined = rows.join(proteins.select("protein_id", "sequence_length"), "protein_id", "left")
    good = (F.col("_n") >= 22) & (F.col("start") >= 1) & (F.col("start") <= F.col("stop")) & (F.col("stop") <= F.col("sequence_length")) & F.col("domain_id").startswith("PF")
    require_empty(joined.filter(~F.coalesce(good, F.lit(False))), "domain rows that do not fit their protein")
    hits = joined.select("protein_id", F.lit("ASSESSED_WITH_HIT").alias("assessment_status"), "domain_id", "domain_name", "start", "stop", "score", "e_value")
    none = proteins.select("protein_id").join(hits.select("protein_id"), "protein_id", "left_anti").withColumn("assessment_status", F.lit("ASSESSED_NO_HIT"))
    return hits.unionByName(none, allowMissingColumns=True)


REGION_COLUMNS = ("comparison_id", "protein_id", "start", "end", "region_type", "region_id", "q_value", "prevalence_difference", "evidence_source")


def region_annotations(df: DataFrame) -> DataFrame:
    """Region rows of nine text columns, typed; blank cells, unsafe or long texts, places that are none, and numbers out of range are errors."""
    if tuple(df.columns) != REGION_COLUMNS:
        raise ValueError(f"the columns must be {REGION_COLUMNS}")
    numbers = {"start": "bigint", "end": "bigint", "q_value": "double", "prevalence_difference": "double"}
    rows = df.select(*[F.col(c).try_cast(numbers[c]).alias(c) if c in numbers else F.col(c) for c in REGION_COLUMNS], *[F.col(c).alias(f"_{c}") for c in numbers])
    bad = F.lit(False)
    for c in REGION_COLUMNS:
        bad = bad | (F.coalesce(F.trim(F.col(f"_{c}") if c in numbers else F.col(c)), F.lit("")) == "")
        if c not in numbers:
            bad = bad | (F.length(c) > 255) | F.col(c).rlike(r"[<>\x00-\x1f]")
    ok = (F.col("start") >= 1) & (F.col("end") >= F.col("start")) & F.col("q_value").between(0, 1) & F.col("prevalence_difference").isNotNull() & ~F.isnan("prevalence_difference") & (F.abs("prevalence_difference") != float("inf"))
    require_empty(rows.filter(bad | ~F.coalesce(ok, F.lit(False))), "region rows")
    return rows.select(*REGION_COLUMNS)


def import_cluster(rows: DataFrame, key: str, sequence: str, cluster: str | None = None, wanted: object = None) -> tuple[DataFrame, int]:
    """(records, collapsed): (sequence_id, sequence) of an export, equal rows once, and how many rows that took away; two sequences of one id, and no rows, are errors.

    With ``cluster`` and ``wanted`` only that cluster's rows count.
    """
    chosen = rows if cluster is None else rows.filter(F.col(cluster).cast("string") == str(wanted))
    clean = chosen.select(F.col(key).alias("sequence_id"), F.regexp_replace(F.upper(F.regexp_replace(sequence, r"\s", "")), r"\*+$", "").alias("sequence"))
    once = clean.groupBy("sequence_id").agg(F.min("sequence").alias("sequence"), F.max("sequence").alias("_other"), F.count("*").alias("_n"))
    require_empty(once.filter("sequence <> _other"), "two sequences of one id")
    sizes = once.agg(F.sum("_n").alias("rows"), F.count("*").alias("ids")).first()
    if not sizes["ids"]:
        raise ValueError("no rows were chosen")
    return once.select("sequence_id", "sequence"), int(sizes["rows"] - sizes["ids"])
