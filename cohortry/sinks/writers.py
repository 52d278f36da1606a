"""Result tables as Parquet, TSV and FASTA, and the check of what was written."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART_ROWS = 1_000_000
#: Tables of more rows than this are packed.
PLAIN_ROWS = 1_000_000


def write_canonical(df: DataFrame, columns: Sequence[str], path: str, rows: int = PART_ROWS) -> None:
    """Exactly the given columns, in order, as Parquet files of at most ``rows`` rows, packed with zstd. Nothing is copied whole."""
    df.select(*columns).write.option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(path)


def write_tsv(df: DataFrame, columns: Sequence[str], path: str, plain: int = PLAIN_ROWS, order: Sequence[str] = ()) -> None:
    """A TSV table; packed with gzip above ``plain`` rows. Empty texts and nulls are both empty cells; tabs and line ends in a cell are an error of the table.

    Without ``order`` every file has a heading. With it the rows are dealt and sorted by these columns, and the files, in order of their names, are one sorted table with one heading at its start.
    """
    packed = "gzip" if df.limit(plain + 1).count() > plain else "none"
    if not order:
        rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
        rows.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("compression", packed).csv(path)
        return
    keys = [f"_key{k}" for k in range(len(order))]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    lines = df.select(F.lit(1).alias("_rank"), *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)], F.concat_ws("\t", *cells).alias("value"))
    heading = df.sparkSession.createDataFrame([("\t".join(columns),)], "value string").select(F.lit(0).alias("_rank"), *[F.lit(None).cast(lines.schema[k].dataType).alias(k) for k in keys], "value")
    place = ["_rank", *keys, "value"]
    heading.unionByName(lines).repartitionByRange(*place).sortWithinPartitions(*place).select("value").write.option("compression", packed).text(path)


def fasta_text(df: DataFrame, width: int = 0) -> DataFrame:
    """(text) of every record: ``>id description`` and the sequence, in lines of ``width`` residues if it is given; protein_id, description, sequence."""
    head = F.concat(F.lit(">"), F.col("protein_id").cast("string"), F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit(" "), "description")).otherwise(F.lit("")))
    body = F.rtrim(F.regexp_replace("sequence", f"(.{{{width}}})", "$1\n"), F.lit("\n")) if width else F.col("sequence")
    return df.select("protein_id", F.concat(head, F.lit("\n"), body).alias("text"))


def write_fasta(df: DataFrame, path: str, width: int = 0) -> None:
    """FASTA files in order of id; the files, in order of their names, are one sorted table."""
    fasta_text(df, width).repartitionByRange("protein_id").sortWithinPartitions("protein_id").select("text").write.text(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(name, size_bytes, sha256) of the files under a folder, names relative to it; no file is a cell.

    Files are read in pieces that end at newline bytes, by many tasks; the pieces of a file then pass through one digest in their order, a batch at a time. Only a stretch without any newline is held whole.
    A file that begins with a byte order mark, which Spark's reader drops, is an error; files without any byte are not listed, as Spark passes over them.
    """
    root = path.rstrip("/") + "/"
    relative = lambda c: F.element_at(F.split(c, _quoted(root)), -1)
    # only paths and lengths are read here
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(relative(F.col("path")).alias("name"), F.col("length").alias("size_bytes"))
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    pieces = lines.select(relative(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("name"), place.alias("place"), F.col("value").cast("binary").alias("piece"))
    streams = pieces.join(sizes, "name").repartition("name").sortWithinPartitions("name", "place")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, state, seen = None, 0, None, 0

        def closed() -> pa.RecordBatch:
            # the reader drops a newline at the end
            if seen < size:
                state.update(b"\n")
            if size - seen > 1:
                raise ValueError(f"{now}: {size - seen} bytes were not read")
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["name", "sha256"])

        for batch in batches:
            for name, total, piece in zip(batch.column("name").to_pylist(), batch.column("size_bytes").to_pylist(), batch.column("piece"), strict=True):
                if name != now:
                    if now is not None:
                        yield closed()
                    now, size, state, seen = name, total, hashlib.sha256(), 0
                else:
                    state.update(b"\n")
                    seen += 1
                data = piece.as_buffer()
                state.update(data)
                seen += data.size
        if now is not None:
            yield closed()

    found = streams.select("name", "size_bytes", "piece").mapInArrow(digest, "name string, sha256 string")
    return sizes.join(found, "name", "left").select("name", "size_bytes", "sha256")


def _quoted(text: str) -> str:
    return "\\Q" + text.split("://", 1)[-1] + "\\E"


def reconcile(declared: DataFrame, found: DataFrame) -> DataFrame:
    """(name, problem) of a manifest (name, size_bytes, sha256) and an inventory: MISSING, UNDECLARED, SIZE_DIFFERS, DIGEST_DIFFERS; nothing where they agree."""
    a = declared.select("name", F.col("size_bytes").alias("_s"), F.lower("sha256").alias("_d"), F.lit(True).alias("_a"))
    b = found.select("name", F.col("size_bytes").alias("_fs"), F.lower("sha256").alias("_fd"), F.lit(True).alias("_b"))
    problem = F.when(F.col("_b").isNull(), "MISSING").when(F.col("_a").isNull(), "UNDECLARED").when(F.col("_s") != F.col("_fs"), "SIZE_DIFFERS").when(F.col("_d") != F.col("_fd"), "DIGEST_DIFFERS")
    return a.join(b, "name", "full").select("name", problem.alias("problem")).filter("problem is not null")


def inventory_difference(declared: DataFrame, found: DataFrame, key: str = "name") -> DataFrame:
    """(key, side): names of one side that the other lacks, DECLARED_ONLY or FOUND_ONLY."""
    a, b = declared.select(key).distinct(), found.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("DECLARED_ONLY")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("FOUND_ONLY")))
