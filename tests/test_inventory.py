"""Digests of files that are read in pieces, and the manifest check over them."""

import hashlib
import os
import random

import pytest

from cohortry import storage
from cohortry.sinks import writers
from cohortry.sources import readers


def test_digests_of_any_bytes(spark, tmp_path):
    rng = random.Random(3)
    files = {
        "empty": b"", "newline": b"\n", "plain": b"abc", "ended": b"abc\n", "several": b"a\n\nb\n\n", "windows": b"a\r\nb\r\n", "binary": rng.randbytes(300_000), "zeros": bytes(5000), "sub/a b+c%d": b"x\ny",
        "long": b"q" * 200_000 + b"\n" + b"r" * 10,
    }
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r["name"]: (r["size_bytes"], r["sha256"]) for r in writers.file_inventory(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items() if data}


def test_a_byte_order_mark_is_refused(spark, tmp_path):
    (tmp_path / "marked").write_bytes(b"\xef\xbb\xbfabc\n")
    with pytest.raises(Exception, match="were not read"):
        writers.file_inventory(spark, str(tmp_path)).collect()


def test_a_sorted_table_has_one_heading(spark, tmp_path):
    rows = [(k * 37 % 500, None if k % 5 == 0 else f"t{k}") for k in range(500)]
    frame = spark.createDataFrame(rows, "k int, t string").repartition(3)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_tsv(frame, ["t", "k"], str(tmp_path / "t"), order=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted((tmp_path / "t").glob("part-*"))
    lines = "".join(f.read_text() for f in files).splitlines()
    assert len(files) > 1 and lines == ["t\tk"] + [f"{t or ''}\t{k}" for k, t in sorted(rows, key=lambda r: r[0])]
    back = readers.read_tsv(spark, str(tmp_path / "t"), ["t", "k"], one_heading=True)
    assert sorted(map(tuple, back.collect())) == sorted((t or "", str(k)) for k, t in rows)
    writers.write_tsv(frame, ["t", "k"], str(tmp_path / "u"))
    with pytest.raises(ValueError, match="headings"):
        readers.read_tsv(spark, str(tmp_path / "u"), ["k", "t"], one_heading=True)


def test_a_scope_deletes_its_tables(spark):
    before = storage.materialize(spark.range(3), "kept")
    with storage.intermediate(spark):
        inside = storage.materialize(spark.range(5), "gone")
        path = inside.inputFiles()[0].rpartition("/")[0].removeprefix("file://").removeprefix("file:")
        assert inside.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path) and before.count() == 3
