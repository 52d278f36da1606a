"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a folder of our own in local mode, and an error on a cluster, whose machines share none."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not known and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not known:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


#: Folders that ``new_path`` named, by application.
_named: dict[str, list[str]] = {}


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _named.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """A scope of intermediate tables: those that are written inside are deleted at its end, so results must be written or collected before.

    Outside a scope they stay until the folder is cleared, as results are lazy and may read them at any time.
    """
    named = _named.setdefault(spark.sparkContext.applicationId, [])
    before = len(named)
    try:
        yield
    finally:
        gone = named[before:]
        del named[before:]
        _delete(spark, gone)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends at replicated files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``key``, as many as the session's shuffle partitions; a join by ``key`` then moves the other side only."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", new_path(spark, label)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table. Python workers that this session starts find this package where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    return spark.read.parquet(f"{folder}/{name}.parquet")
