"""Data-quality checks; each returns the violations as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9_.:+/-]{0,254}$"


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def broken_dependency(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with more than one combination of values."""
    return df.select(*keys, *values).distinct().groupBy(*keys).agg(F.count("*").alias("variants")).filter("variants > 1")


def missing_references(df: DataFrame, key: str, authority: DataFrame, authority_key: str) -> DataFrame:
    return df.select(key).distinct().join(authority.select(F.col(authority_key).alias(key)), key, "left_anti")


def bad_identifiers(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(~F.col(column).rlike(IDENTIFIER) | F.col(column).isNull())


def bad_intervals(df: DataFrame, start: str, end: str, length: str) -> DataFrame:
    """Rows whose interval is half given or not inside 1..length."""
    s, e = F.col(start), F.col(end)
    return df.filter((s.isNull() != e.isNull()) | (s < 1) | (e < s) | (e > F.col(length)))


def bad_numbers(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Non-blank texts that are no finite number in bounds."""
    value = F.col(column).try_cast("double")
    good = value.isNotNull() & ~F.isnan(value) & value.between(low, high)
    return df.filter((F.trim(column) != "") & ~F.coalesce(good, F.lit(False)))


def bad_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(*allowed) | F.col(column).isNull())


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise when a check has found anything."""
    found = violations.take(5)
    if found:
        raise ValueError(f"{what}: {found}")


def bad_texts(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is empty or holds a tab, a line end or another control character."""
    return df.filter(F.col(column).isNull() | (F.trim(column) == "") | F.col(column).rlike(r"[\x00-\x1f\x7f]"))


def bad_lists(df: DataFrame, column: str) -> DataFrame:
    """Rows whose list holds a blank or a repeated item."""
    return df.filter((F.size(F.array_distinct(column)) < F.size(column)) | F.exists(column, lambda x: x.isNull() | (F.trim(x) == "")))


def not_available(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Different requested rows that are not available."""
    return requested.subtract(available)


def class_members(memberships: DataFrame, comparisons: DataFrame) -> DataFrame:
    """(comparison_id, protein_id, is_target): proteins with any target or background label of each comparison; one in both classes is an error.

    ``memberships``: protein_id, label_id; ``comparisons``: comparison_id, target_label_ids and background_label_ids (arrays).
    """
    sides = [comparisons.select("comparison_id", F.explode(c).alias("label_id"), F.lit(t).alias("is_target")) for c, t in (("target_label_ids", True), ("background_label_ids", False))]
    rows = memberships.select("protein_id", "label_id").join(sides[0].unionByName(sides[1]).distinct(), "label_id")
    found = rows.groupBy("comparison_id", "protein_id").agg(F.max("is_target").alias("is_target"), F.min("is_target").alias("_other"))
    require_empty(found.filter("is_target <> _other"), "proteins in both classes of a comparison")
    return found.drop("_other")


def resolve_labels(terms: DataFrame, labels: DataFrame, allow_unknown: bool = False) -> DataFrame:
    """Terms with the label that goes by them, as id, display name or alias, whatever their case; an unknown term is an error unless it is allowed, then its label is null."""
    names = labels.select("label_id", F.explode(F.array_distinct(F.transform(F.concat(F.array("label_id", "display_name"), "aliases"), F.lower))).alias("_term"))
    require_empty(names.groupBy("_term").agg(F.count_distinct("label_id").alias("n")).filter("n > 1"), "terms of several labels")
    found = terms.join(names, F.lower("term") == F.col("_term"), "left").drop("_term")
    if not allow_unknown:
        require_empty(found.filter("label_id is null"), "unknown terms")
    return found


def label_coverage_problems(proteins: DataFrame, assignments: DataFrame, comparisons: DataFrame, controls: Sequence[str], positive: Sequence[str] = ("REVIEWED_POSITIVE", "EVIDENCE_SUPPORTED_POSITIVE")) -> DataFrame:
    """(problem, n): proteins without an assignment, no positive target, no positive control, and positive targets whose background has none.

    ``assignments``: protein_id, label_id, curation_status; ``comparisons``: target_label_id, background_label_id; ``controls``: labels that are controls.
    """
    held = assignments.filter(F.col("curation_status").isin(*positive)).groupBy("label_id").agg(F.count("*").alias("n"))
    targets = comparisons.join(held.withColumnRenamed("label_id", "target_label_id"), "target_label_id")
    empty = targets.join(held.select(F.col("label_id").alias("background_label_id")), "background_label_id", "left_anti")
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n")
    none = lambda df, name: df.agg((F.count("*") == 0).cast("long").alias("n")).select(F.lit(name).alias("problem"), "n")
    uncovered = proteins.select("protein_id").distinct().join(assignments, "protein_id", "left_anti")
    return one(uncovered, "UNCOVERED_PROTEIN").unionByName(none(targets, "NO_TARGET")).unionByName(none(held.filter(F.col("label_id").isin(*controls)), "NO_CONTROL")).unionByName(one(empty, "EMPTY_BACKGROUND"))
