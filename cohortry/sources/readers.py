"""Readers of text formats and reshaping of what they give."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESIDUES = r"^[A-IK-Z*?\-]+$"
#: Members that the cells of one wide row hold, about.
ROW_MEMBERS = 10_000


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(protein_id, description, sequence, sequence_length, sequence_sha256) of a FASTA file.

    Records are parted by Spark's own line separator. Residues are upper-cased, white space and a terminal ``*`` are
    removed. Bad records are kept, for ``fasta_violations`` to name.
    """
    record = F.regexp_replace(F.regexp_replace("value", "^>", ""), r"\s+$", "")
    parts = F.split(record, "\n", 2)
    head, body = F.trim(parts[0]), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    residues = F.regexp_replace(F.upper(F.regexp_replace(body, r"\s", "")), r"\*$", "")
    rows = spark.read.option("lineSep", "\n>").text(path).filter(F.trim("value") != "")
    rows = rows.select(F.split(head, r"\s+", 2)[0].alias("protein_id"), F.coalesce(F.try_element_at(F.split(head, r"\s+", 2), F.lit(2)), F.lit("")).alias("description"), residues.alias("sequence"))
    return rows.withColumns({"sequence_length": F.length("sequence").cast("long"), "sequence_sha256": F.sha2("sequence", 256)})


def fasta_violations(records: DataFrame) -> DataFrame:
    """(protein_id, problem): empty or foreign residues, an internal stop, or a repeated id."""
    problem = F.when(F.col("sequence") == "", "EMPTY").when(F.contains("sequence", F.lit("*")), "INTERNAL_STOP").when(~F.col("sequence").rlike(RESIDUES), "ALPHABET")
    again = records.groupBy("protein_id").agg(F.count("*").alias("n")).filter("n > 1").select("protein_id", F.lit("DUPLICATE").alias("problem"))
    return records.select("protein_id", problem.alias("problem")).filter("problem is not null").unionByName(again)


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str], one_heading: bool = False) -> DataFrame:
    """A headed TSV of text columns; blank cells are empty strings, and a header or width that differs is an error.

    With ``one_heading`` the files are one table, whose first file alone has the heading; it must be there exactly once.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    if one_heading:
        rows = spark.read.csv(path, sep="\t", schema=schema, mode="FAILFAST", quote="")
        heading = F.lit(True)
        for c in columns:
            heading = heading & F.coalesce(F.col(c) == c, F.lit(False))
        if (n := rows.filter(heading).count()) != 1:
            raise ValueError(f"{n} headings in {path}")
        rows = rows.filter(~heading)
    else:
        rows = spark.read.csv(path, sep="\t", header=True, schema=schema, mode="FAILFAST", enforceSchema=False, quote="")
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def wide_members(long: DataFrame, key: str, name: str, member: str) -> DataFrame:
    """A column per name whose cells hold the distinct members, comma-separated; the inverse of ``unpivot_members``.

    A key of more than ``ROW_MEMBERS`` rows gets several wide rows, by a hash of the member, so no cell grows with the table.
    """
    large = long.groupBy(key).agg(F.count(member).alias("_n")).filter(F.col("_n") > ROW_MEMBERS).select(F.col(key).alias("_key"), F.ceil(F.col("_n") / ROW_MEMBERS).alias("_parts"))
    part = F.pmod(F.xxhash64(member), F.coalesce("_parts", F.lit(1)))
    dealt = long.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_part", part)
    return dealt.groupBy(key, "_part").pivot(name).agg(F.array_join(F.collect_set(F.col(member).cast("string")), ", ")).drop("_part")


def unpivot_members(wide: DataFrame, key: str, name: str) -> DataFrame:
    """Long (key, name, member) of a table with a column per species whose cells hold comma-separated members."""
    columns = [c for c in wide.columns if c != key]
    long = wide.unpivot([key], columns, name, "cell")
    return long.select(key, name, F.explode(F.split("cell", ",")).alias("member")).select(key, name, F.trim("member").alias("member")).filter("member <> ''")


def canonical_pairs(df: DataFrame, a: str, b: str, coverage_a: str, coverage_b: str) -> DataFrame:
    """(a, b, coverage_a, coverage_b) with a < b; coverages follow their ends, self pairs are dropped."""
    keep: Column = F.col(a) <= F.col(b)
    swap = lambda x, y: F.when(keep, F.col(x)).otherwise(F.col(y))
    return df.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), swap(coverage_a, coverage_b).alias("coverage_a"), swap(coverage_b, coverage_a).alias("coverage_b"))


def caliper_join(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str, caliper: float) -> DataFrame:
    """(left_id, right_id, caliper): pairs of equal keys whose sizes differ by ``caliper`` doublings at most.

    Sizes fall in bands one caliper wide; a left row meets the bands beside its own, so this is an equi-join.
    """
    doublings = lambda: F.log2(F.col(size) + 1)
    band = F.floor(doublings() / caliper)
    x = left.select(*keys, F.col("protein_id").alias("left_id"), doublings().alias("x"), F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    y = right.select(*keys, F.col("protein_id").alias("right_id"), doublings().alias("y"), band.alias("band"))
    gap = F.abs(F.col("x") - F.col("y"))
    return x.join(y, [*keys, "band"]).filter(gap <= caliper).select("left_id", "right_id", gap.alias("caliper"))
