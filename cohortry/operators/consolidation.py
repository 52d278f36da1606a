"""Many rows of one entity brought to one; conflicts are errors, not choices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators.checks import require_empty

TRUE, FALSE = ("1", "true", "yes"), ("0", "false", "no")
EXCLUDED_STATES = ("FAILED", "NOT_ASSESSED", "INPUT_UNAVAILABLE", "EXCLUDED")
COORDINATES = r"(?i)\.(pdb|cif|mmcif|pdb\.gz|cif\.gz)$"


def joined_set(column: str) -> Column:
    """The different texts of a group that are not empty, sorted, joined by bars."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")))), "|")


def consolidate_sequences(rows: DataFrame, contexts: Sequence[str], flag: str | None = None) -> DataFrame:
    """(protein_id, sequence, sequence_length, sequence_sha256, the contexts, flag_states): one row a protein.

    ``rows``: protein_id, sequence and the context columns; rows without an id are left out, two sequences of one id are an error. ``flag`` is a
    yes-or-no column in whatever spelling; its states are TRUE, FALSE and UNKNOWN.
    """
    clean = rows.filter(F.coalesce(F.trim(F.col("protein_id").cast("string")), F.lit("")) != "").withColumn("sequence", F.upper(F.trim("sequence")))
    require_empty(clean.filter((F.coalesce("sequence", F.lit("")) == "") | F.col("sequence").rlike(r"\s")), "empty sequences, or with white space")
    require_empty(clean.groupBy("protein_id").agg(F.min(F.sha2("sequence", 256)).alias("a"), F.max(F.sha2("sequence", 256)).alias("b")).filter("a <> b"), "two sequences of one protein")
    parts = [joined_set(c).alias(c) for c in contexts]
    if flag:
        text = F.lower(F.trim(F.col(flag).cast("string")))
        state = F.when(text.isin(*TRUE), "TRUE").when(text.isin(*FALSE), "FALSE").otherwise("UNKNOWN")
        parts.append(F.array_join(F.array_sort(F.collect_set(state)), "|").alias("flag_states"))
    made = clean.groupBy("protein_id").agg(F.any_value("sequence").alias("sequence"), *parts)
    return made.select("protein_id", "sequence", F.length("sequence").cast("long").alias("sequence_length"), F.sha2("sequence", 256).alias("sequence_sha256"), *[c for c in made.columns if c not in ("protein_id", "sequence")])


def consolidate_domains(proteins: DataFrame, hits: DataFrame, summaries: DataFrame, database: str = "pfam") -> tuple[DataFrame, DataFrame]:
    """(hits, assessments): different hits of one database, and the state and hints of every protein.

    ``proteins``: protein_id, sequence_length; ``hits``: protein_id, source_database, domain_id, domain_name, start, stop, score, family, role; ``summaries``: protein_id,
    availability, declared_hits, detail. Hits outside the sequence, two forms of one hit, and a summary that declares hits where there are none are errors. A protein with hits is
    ASSESSED_WITH_HIT, one that any summary calls AVAILABLE is ASSESSED_NO_HIT, any other NOT_ASSESSED. Families and roles are gathered from hits of all databases.
    """
    known = hits.join(proteins.select("protein_id", "sequence_length"), "protein_id")
    own = known.filter(F.lower(F.trim("source_database")) == database)
    require_empty(own.filter(F.coalesce((F.col("start") < 1) | (F.col("stop") < F.col("start")) | (F.col("stop") > F.col("sequence_length")), F.lit(True))), "domain hits outside their sequence")
    key = ["protein_id", "domain_id", "start", "stop"]
    named = own.select(*key, F.coalesce(F.nullif(F.trim("domain_name"), F.lit("")), F.col("domain_id")).alias("domain_name"), "score").distinct()
    require_empty(named.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "two forms of one domain hit")
    hints = known.groupBy("protein_id").agg(joined_set("family").alias("families"), joined_set("role").alias("roles"), F.array_join(F.array_sort(F.collect_set(F.when(F.lower(F.trim("source_database")) == database, F.col("domain_id")))), "|").alias("domains"), F.count_if(F.lower(F.trim("source_database")) == database).alias("_hits"))
    told = summaries.groupBy("protein_id").agg(F.bool_or(F.upper(F.trim("availability")) == "AVAILABLE").alias("_available"), F.max(F.coalesce("declared_hits", F.lit(0))).alias("_declared"), joined_set("detail").alias("details"))
    rows = proteins.select("protein_id").join(hints, "protein_id", "left").join(told, "protein_id", "left")
    with_hit, available = F.coalesce("_hits", F.lit(0)) > 0, F.coalesce("_available", F.lit(False))
    require_empty(rows.filter(~with_hit & available & (F.col("_declared") > 0)), "declared hits that are not there")
    state = F.when(with_hit, "ASSESSED_WITH_HIT").when(available, "ASSESSED_NO_HIT").otherwise("NOT_ASSESSED")
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return named, rows.select("protein_id", state.alias("assessment_status"), text("domains"), text("families"), text("roles"), text("details"))


def consolidate_structures(assets: DataFrame, quality: DataFrame, proteins: DataFrame, minimum_confidence: float = 70.0) -> DataFrame:
    """(protein_id, structure_id, coordinate_path, coordinate_sha256, mean_confidence, analysis_eligibility_status): one coordinate file a protein, that of the smallest path.

    ``assets``: protein_id, path, sha256; files of other kinds and unknown proteins are left out, two digests of one protein are an error. ``quality``: protein_id, mean_confidence; two values of
    one protein, or one outside 0 to 100, are errors.
    """
    own = quality.join(proteins.select("protein_id"), "protein_id", "left_semi").select("protein_id", "mean_confidence").distinct()
    require_empty(own.filter(~F.col("mean_confidence").between(0, 100)), "confidences outside 0 to 100")
    require_empty(own.groupBy("protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "two confidences of one protein")
    files = assets.filter(F.coalesce("path", F.lit("")).rlike(COORDINATES)).join(proteins.select("protein_id"), "protein_id", "left_semi").withColumn("sha256", F.lower(F.trim("sha256")))
    require_empty(files.filter(~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))), "coordinate digests of another form")
    require_empty(files.groupBy("protein_id").agg(F.count_distinct("sha256").alias("n")).filter("n > 1"), "two coordinate files of one protein")
    first = files.groupBy("protein_id").agg(F.min("path").alias("coordinate_path"), F.min("sha256").alias("coordinate_sha256"))
    rows = first.join(own, "protein_id", "left")
    state = F.when(F.col("mean_confidence").isNull(), "INELIGIBLE_CONFIDENCE_UNAVAILABLE").when(F.col("mean_confidence") < minimum_confidence, "INELIGIBLE_LOW_CONFIDENCE").otherwise("ELIGIBLE")
    key = F.substring(F.sha2(F.concat(F.col("protein_id").cast("string"), F.lit("\t"), "coordinate_sha256"), 256), 1, 24)
    return rows.select("protein_id", F.concat(F.lit("WF_"), key).alias("structure_id"), "coordinate_path", "coordinate_sha256", "mean_confidence", state.alias("analysis_eligibility_status"))


def merge_features(sources: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """All features of several sources; rows in an excluded state are left out, and of equal keys the row of the last source stays.

    Every source has the columns of ``key`` and evidence_status.
    """
    parts = [s.withColumn("_source", F.lit(k)) for k, s in enumerate(sources)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).filter(~F.upper("evidence_status").isin(*EXCLUDED_STATES))
    rest = [c for c in rows.columns if c not in (*key, "_source")]
    kept = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("_source", *rest)).alias("r"))
    return kept.select(*key, "r.*")


def merge_unique(sources: Sequence[DataFrame], key: Sequence[str], what: str) -> DataFrame:
    """The union of several sources; a key that occurs twice is an error."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    require_empty(rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), what)
    return rows


def complete_assessments(proteins: DataFrame, assessments: DataFrame, most: int = 1000) -> DataFrame:
    """(protein_id, domain_authority, assessment_status): every protein with every authority, NOT_ASSESSED where nothing is known.

    Authorities are a handful of tools; more than ``most`` are an error, as each gives a row for each protein.
    """
    names = assessments.select("domain_authority").distinct()
    if names.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} domain authorities")
    every = proteins.select("protein_id").distinct().crossJoin(F.broadcast(names))
    known = assessments.select("protein_id", "domain_authority", "assessment_status")
    return every.join(known, ["protein_id", "domain_authority"], "left").withColumn("assessment_status", F.coalesce("assessment_status", F.lit("NOT_ASSESSED")))


def domain_architecture(hits: DataFrame) -> DataFrame:
    """(protein_id, domain_authority, architecture): the domains in order of start, end and id, joined by ``>``."""
    ordered = hits.select("protein_id", "domain_authority", "start", "stop", "domain_id").distinct().groupBy("protein_id", "domain_authority").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "domain_id"))).alias("h"))
    return ordered.select("protein_id", "domain_authority", F.array_join(F.transform("h", lambda x: x["domain_id"]), ">").alias("architecture"))


def domain_features(hits: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id, start, stop): PFAM_DOMAIN or DOMAIN, with the id ``authority:domain``."""
    return hits.select("protein_id", F.when(F.lower("domain_authority") == "pfam", "PFAM_DOMAIN").otherwise("DOMAIN").alias("feature_type"), F.concat_ws(":", "domain_authority", "domain_id").alias("feature_id"), "start", "stop")


def domain_sequences(hits: DataFrame, proteins: DataFrame) -> DataFrame:
    """(protein_id, domain_authority, domain_id, start, stop, domain_sequence): the residues of every hit's interval, which counts from 1 and includes its end."""
    rows = hits.join(proteins.select("protein_id", "sequence"), "protein_id")
    return rows.select("protein_id", "domain_authority", "domain_id", "start", "stop", F.col("sequence").substr(F.col("start").cast("int"), (F.col("stop") - F.col("start") + 1).cast("int")).alias("domain_sequence"))


def acquisition_outcome(attempts: DataFrame, minimum_confidence: float = 70.0) -> DataFrame:
    """Add acquisition_status and analysis_eligibility_status to attempts to get a model: http_status, sequence_match, mean_confidence.

    404 means that there is no model, any other answer but 200 that the attempt failed. Another sequence is a mismatch; an unchecked one, a missing and a low confidence are acquired but not eligible.
    """
    ok = F.col("http_status") == 200
    status = (
        F.when(F.col("http_status") == 404, "MODEL_NOT_AVAILABLE").when(~F.coalesce(ok, F.lit(False)), "FAILED").when(~F.col("sequence_match"), "SEQUENCE_MISMATCH")
        .when(F.col("sequence_match").isNull(), "ACQUIRED_SEQUENCE_UNVERIFIED").when(F.col("mean_confidence").isNull(), "ACQUIRED_CONFIDENCE_UNAVAILABLE").when(F.col("mean_confidence") < minimum_confidence, "ACQUIRED_LOW_CONFIDENCE").otherwise("ACQUIRED")
    )
    eligible = (
        F.when(status == "ACQUIRED", "ELIGIBLE").when(status == "ACQUIRED_LOW_CONFIDENCE", "INELIGIBLE_LOW_CONFIDENCE").when(status == "ACQUIRED_CONFIDENCE_UNAVAILABLE", "INELIGIBLE_CONFIDENCE_UNAVAILABLE")
        .when(status == "ACQUIRED_SEQUENCE_UNVERIFIED", "INELIGIBLE_SEQUENCE_UNVERIFIED").when(status == "SEQUENCE_MISMATCH", "INELIGIBLE_SEQUENCE_MISMATCH").otherwise("INELIGIBLE_COORDINATE_UNAVAILABLE")
    )
    return attempts.withColumns({"acquisition_status": status, "analysis_eligibility_status": eligible})


def canonical_projection(df: DataFrame, columns: Sequence[str], sets: Sequence[str] = (), blanks: Sequence[str] = ()) -> DataFrame:
    """The columns of a canonical table in order: list columns joined by bars, and empty texts for null in ``blanks``."""
    made = {c: F.array_join(c, "|") for c in sets} | {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in blanks}
    return df.withColumns(made).select(*columns)
