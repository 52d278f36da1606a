"""Exact long matches by a logarithmic family of suffix arrays (operator 1)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.joins import spread_join
from cohortry.llm.tables import small_batches
from cohortry.llm.words import mix, text_runs
from cohortry.storage import materialize

LENGTH = 200
#: Bytes of an anchor. Every string of LENGTH bytes has LENGTH - ANCHOR + 1 places for one.
ANCHOR = 40
#: Suffixes of one batch of the family.
BATCH = 8192
#: Suffixes that one task gets on average, and the number under one anchor from which it is split.
TASK_SUFFIXES = 60_000
HOT = 20_000
SLICE = 16
#: String starts that are looked at together; places within them are told apart by 24 bits.
PIECE = 1 << 22


def _anchor_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from every byte that has them."""
    n = len(text) - ANCHOR + 1
    eight = mix(np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text), strides=(1,)).astype(np.uint64))
    k = np.uint64(0xD6E8FEB86659FD93)
    sixteen = eight[:-8] * k + eight[8:]
    thirty_two = (sixteen[:-16] ^ (sixteen[:-16] >> np.uint64(31))) * k + sixteen[16:]
    return mix((thirty_two[:n] ^ (thirty_two[:n] >> np.uint64(29))) * k + eight[32 : 32 + n])


def _stretch_hashes(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of all bytes of each stretch, from the hashes of the ANCHOR bytes at every ANCHOR bytes and at its end."""
    odd = np.uint64(0xD6E8FEB86659FD93)
    total = mix(sizes.astype(np.uint64) * odd + hashes[starts + sizes - ANCHOR])
    live, at = np.arange(len(starts)), 0
    while len(live):
        total[live] = mix(total[live] * odd + hashes[starts[live] + at])
        at += ANCHOR
        live = live[sizes[live] >= at + ANCHOR]
    return total


def stretches(text: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Cut the strings of ``length`` bytes of a run of texts into stretches that share their anchor.

    The anchor of a string is the place in it where the hash is least (the first, of equal ones), so
    equal strings have the same anchor at the same distance. Neighbouring strings mostly share one. Returns
    for each stretch its text's number, the first string's start in the text, the number of strings, the
    anchor's distance from that start, the anchor's hash, and a hash of all bytes of the stretch.
    """
    names = ("row", "lo", "n", "off", "anchor", "content")
    if len(text) > PIECE + length - 1:
        # pieces overlap so that every string lies in one; where a string lies in its piece does not change its anchor
        parts = []
        for a in range(0, len(text) - length + 1, PIECE):
            piece = text[a : a + PIECE + length - 1]
            inner = np.clip(offsets - a, 0, len(piece))
            part = stretches(piece, inner, length)
            part["lo"] = part["lo"] + inner[part["row"]] + a - offsets[part["row"]]
            parts.append(part)
        return {k: np.concatenate([p[k] for p in parts]) for k in names}
    count = len(text) - length + 1
    if count <= 0:
        return {k: np.zeros(0, np.int64) for k in names}
    hashes = _anchor_hashes(text)
    low = np.uint64((1 << 24) - 1)
    least = (hashes & ~low) | (np.arange(len(hashes), dtype=np.uint64) & low)
    width, need = 1, length - ANCHOR + 1
    while 2 * width <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if need > width:
        least = np.minimum(least[: len(least) - (need - width)], least[need - width :])
    start = np.arange(count)
    at = start + (((least & low).astype(np.int64) - start) & int(low))
    inside = np.zeros(count, bool)
    sizes = np.diff(offsets)
    for a, b in zip(offsets[:-1][sizes >= length], offsets[1:][sizes >= length], strict=True):
        inside[a : b - length + 1] = True
    first = inside.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    lo = np.flatnonzero(first)
    n = np.bincount(np.cumsum(first)[inside] - 1, minlength=len(lo))
    row = np.searchsorted(offsets, lo, "right") - 1
    content = _stretch_hashes(hashes, lo, n + length - 1)
    return dict(zip(names, (row, lo - offsets[row], n, at[lo] - lo, hashes[at[lo]].view(np.int64), content.view(np.int64)), strict=True))


class Run:
    """A sparse suffix array: anchored suffixes in the order of what follows and of what precedes (reversed) their anchors."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, n: np.ndarray, right: np.ndarray, left: np.ndarray):
        self.ids, self.off, self.n = ids, off, n
        self.right, self.left = right, left  # fixed-length byte strings by entry
        self.by_right = np.argsort(right, kind="stable")
        self.by_left = np.argsort(left, kind="stable")

    def __len__(self) -> int:
        return len(self.ids)

    def merged(self, other: Run) -> Run:
        """One run of both: two sorted orders are merged, which a stable sort of joined runs does in linear time."""
        out = Run.__new__(Run)
        for k in ("ids", "off", "n", "right", "left"):
            setattr(out, k, np.concatenate([getattr(self, k), getattr(other, k)]))
        for order, value in (("by_right", "right"), ("by_left", "left")):
            both = np.concatenate([getattr(self, order), getattr(other, order) + len(self)])
            setattr(out, order, both[np.argsort(getattr(out, value)[both], kind="stable")])
        return out

    def matches(self, copies: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, string number in the stretch) of the strings of ``length`` bytes that more than one suffix has.

        For each distance of the anchor, suffixes whose bytes agree on both sides as far as the string goes form
        a class, read off the longest common prefixes of neighbours in the two orders.
        """
        common_right, common_left = _common(self.right, self.by_right), _common(self.left, self.by_left)
        right_class, left_class = np.zeros(len(self), np.int64), np.zeros(len(self), np.int64)
        shared = copies[self.ids] > 1
        for before in range(length - ANCHOR + 1):
            live = np.flatnonzero((self.off >= before) & (self.off - self.n < before))
            if not len(live):
                continue
            right_class[self.by_right[1:]] = np.cumsum(common_right < length - before)
            left_class[self.by_left[1:]] = np.cumsum(common_left < before)
            key = right_class[live] * len(self) + left_class[live]
            order = np.argsort(key)
            same = key[order[1:]] == key[order[:-1]]
            hit = shared[live]
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            found = live[hit]
            yield self.ids[found], self.off[found] - before


def _common(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that neighbours in an order have in common from the start."""
    width = keys.dtype.itemsize
    rows = keys.view(np.uint8).reshape(len(keys), width)
    out = np.zeros(max(0, len(keys) - 1), np.int64)
    for k in range(0, len(out), 4096):
        part = order[k : min(k + 4097, len(order))]
        differ = rows[part[1:]] != rows[part[:-1]]
        out[k : k + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return out


class Family:
    """Levels of suffix arrays whose sizes are powers of two of a batch.

    A new batch gets its suffix array, is merge-scanned against every level for strings of ``length``
    bytes that both have (and that it has twice), and then joins the levels; while two levels have
    equal size they are merged, so a suffix takes part in a logarithmic number of merges.
    """

    def __init__(self, length: int = LENGTH, batch: int = BATCH):
        self.length, self.batch = length, batch
        self.levels: dict[int, Run] = {}
        self.marks = np.zeros((0, length - ANCHOR + 1), bool)
        self.copies = np.zeros(0, np.int64)

    def add(self, texts: list[bytes], off: np.ndarray, copies: np.ndarray) -> None:
        """Add a batch of stretches: their bytes, the anchor's distance from the start, and how often each occurs."""
        length, first = self.length, len(self.copies)
        n = np.array([len(t) - length + 1 for t in texts], np.int64)
        right = np.array([t[o : o + length].ljust(length, b"\0") for t, o in zip(texts, off.tolist(), strict=True)], f"S{length}")
        left = np.array([t[:o][::-1].ljust(length, b"\0") for t, o in zip(texts, off.tolist(), strict=True)], f"S{length}")
        self.copies = np.concatenate([self.copies, copies])
        self.marks = np.concatenate([self.marks, np.zeros((len(texts), self.marks.shape[1]), bool)])
        run = Run(np.arange(first, first + len(texts)), off, n, right, left)
        if not self.levels:
            self._scan(run)
        for level in list(self.levels.values()):
            self._scan(run.merged(level))
        size = 1
        while size in self.levels:
            run = run.merged(self.levels.pop(size))
            size *= 2
        self.levels[size] = run

    def _scan(self, run: Run) -> None:
        for ids, string in run.matches(self.copies, self.length):
            self.marks[ids, string] = True


def _spans(marks: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes that the marked strings cover, as runs from the stretch's start."""
    at = np.flatnonzero(marks)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), (at[np.concatenate([cut, [len(at) - 1]])] + length).tolist(), strict=True))


def _stretch_rows(docs: DataFrame, length: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, text, offsets in text_runs(batch.column("bytes"), 1 << 19):
                found = stretches(text, offsets, length)
                row = pa.array(first + found.pop("row"))
                arrays = [batch.column(c).take(row) for c in ("doc_id", "text_hash", "times")]
                kinds = {"lo": pa.int32(), "n": pa.int32(), "off": pa.int32(), "anchor": pa.int64(), "content": pa.int64()}
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(found[k]).cast(t) for k, t in kinds.items()], names=["doc_id", "text_hash", "times", *kinds])

    return small_batches(docs).mapInArrow(scan, "doc_id long, text_hash long, times long, lo int, n int, off int, anchor long, content long")


def _matched(rows: DataFrame, length: int, batch: int, parts: int) -> DataFrame:
    """(content, spans) of the stretches that hold a repeated string; rows: anchor, slice, shift, content, copies, off, bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, names, shifts = Family(length, batch), [], []
        held: list[pa.RecordBatch] = []

        def add(table: pa.Table) -> None:
            names.append(np.array(table["content"]))
            shifts.append(np.array(table["shift"]))
            family.add(table["bytes"].to_pylist(), np.array(table["off"]).astype(np.int64), np.array(table["copies"]).astype(np.int64))

        for some in batches:
            held.append(some)
            while sum(b.num_rows for b in held) >= batch:
                table = pa.Table.from_batches(held)
                add(table.slice(0, batch))
                held = table.slice(batch).to_batches()
        if sum(b.num_rows for b in held):
            add(pa.Table.from_batches(held))
        if names:
            content, shift = np.concatenate(names), np.concatenate(shifts)
            hit = np.flatnonzero(family.marks.any(axis=1))
            for k in range(0, len(hit), 4096):
                part = hit[k : k + 4096]
                spans = [[{"b": int(a + shift[i]), "e": int(e + shift[i])} for a, e in _spans(family.marks[i], length)] for i in part]
                yield pa.RecordBatch.from_arrays([pa.array(content[part]), pa.array(spans, pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())])))], names=["content", "spans"])

    return small_batches(rows.repartition(parts, "anchor", "slice").select("content", "shift", "copies", "off", "bytes")).mapInArrow(scan, "content long, spans array<struct<b:int,e:int>>")


def _different(docs: DataFrame) -> DataFrame:
    """Rows that differ in doc_id or text, with ``times``, how often each stands there; texts move only if any row is repeated."""
    repeated = docs.groupBy("doc_id", "text_hash").agg(F.count("*").alias("times")).filter("times > 1")
    if repeated.isEmpty():
        return docs.withColumn("times", F.lit(1).cast("long"))
    return docs.groupBy("doc_id", "text_hash").agg(F.first("bytes").alias("bytes"), F.count("*").alias("times"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, batch: int = BATCH) -> DataFrame:
    """(doc_id, text_hash, spans): for documents with any, the byte stretches covered by strings of ``length`` bytes that start elsewhere too.

    ``docs`` has doc_id, text_hash and bytes. Strings that are equal have the same anchor, so only anchors
    that occur twice are kept; then equal stretches are counted, and one of each goes to the family of suffix arrays of
    its anchor's partition, with its number of copies. An anchor with very many different stretches is split by the anchor's
    distance from the string's start, which equal strings share. Rows of equal doc_id and text are counted and read once.
    There is a row for each different document. Spans of one document may touch or overlap.
    """
    docs = _different(docs)
    rows = _stretch_rows(docs, length)
    twice = materialize(rows.groupBy("anchor").agg(F.sum("times").alias("c")).filter("c > 1"), "anchors")
    found = materialize(spread_join(rows, twice, "anchor", "c", "left_semi"), "occurrences")
    same = found.groupBy("content").agg(F.sum("times").alias("copies"), F.count("*").alias("rows"), *(F.first(c).alias(c) for c in ("anchor", "doc_id", "text_hash", "lo", "n", "off")))
    same = materialize(same, "stretches")
    hot = materialize(same.groupBy("anchor").agg(F.count("*").alias("m")).filter(F.col("m") > HOT).withColumn("hot", F.lit(True)), "hot")
    low, high = F.floor((F.col("off") - F.col("n") + 1) / SLICE), F.floor(F.col("off") / SLICE)
    cut = spread_join(same, hot, "anchor", "m", "left").withColumn("slice", F.explode(F.when(F.col("hot"), F.sequence(low, high)).otherwise(F.array(F.lit(-1).cast("long")))))
    first = F.when(F.col("slice") < 0, 0).otherwise(F.greatest(F.lit(0), F.col("off") - SLICE * F.col("slice") - SLICE + 1)).cast("int")
    last = F.when(F.col("slice") < 0, F.col("n") - 1).otherwise(F.least(F.col("n") - 1, F.col("off") - SLICE * F.col("slice"))).cast("int")
    cut = cut.withColumn("shift", first).withColumn("size", last - first + length)
    asked = cut.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "slice", "content", "copies", "shift", "lo", "size", (F.col("off") - F.col("shift")).alias("off"))).alias("asked")).withColumnsRenamed({"doc_id": "a_id", "text_hash": "a_hash"})
    read = docs.join(asked, docs["doc_id"].eqNullSafe(F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")))
    taken = F.transform("asked", lambda s: F.struct(s["anchor"].alias("anchor"), s["slice"].alias("slice"), s["content"].alias("content"), s["copies"].alias("copies"), s["shift"].alias("shift"), s["off"].alias("off"), F.substring(F.col("bytes"), s["lo"] + s["shift"] + 1, s["size"]).alias("bytes")))
    stretch = read.select(F.explode(taken).alias("s")).select("s.*")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-same.count() // TASK_SUFFIXES))
    # a stretch of a hot anchor comes back from several slices
    matched = _matched(stretch, length, batch, parts).groupBy("content").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    matched = materialize(matched.join(same.select("content", "rows"), "content"), "matched")
    placed = spread_join(found.select("content", "doc_id", "text_hash", "lo"), matched, "content", "rows")
    return placed.select("doc_id", "text_hash", F.transform("spans", lambda s: F.struct((s["b"] + F.col("lo")).alias("b"), (s["e"] + F.col("lo")).alias("e"))).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, batch: int = BATCH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes concatenated) and kept_sha256.

    A byte is removed when a string of ``length`` bytes that covers it also starts anywhere else in the
    input, the same document included. Null text counts as empty, a null doc_id is kept, and texts shorter
    than ``length`` are never touched. A repeated row is a second place for every string of the first.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    spans = repeated_spans(docs, length, batch).groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans")).withColumnsRenamed({"doc_id": "s_id", "text_hash": "s_hash"})
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash")), "left").select("doc_id", "bytes", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            sizes, removed, counts, kept, digests = [], [], [], [], []
            for data, found in zip(some.column("bytes"), some.column("spans"), strict=True):
                data = data.as_buffer()
                parts, at, gone, runs, reach = [], 0, 0, 0, -1
                if found.is_valid:
                    values = found.values
                    b, e = np.array(values.field("b")), np.array(values.field("e"))
                    for k in np.argsort(b, kind="stable"):
                        if b[k] > reach:
                            parts.append(data[at : int(b[k])])
                            runs += 1
                            gone += int(e[k] - b[k])
                            reach = at = int(e[k])
                        elif e[k] > reach:
                            gone += int(e[k]) - reach
                            reach = at = int(e[k])
                parts.append(data[at:])
                left = b"".join(memoryview(p) for p in parts)
                sizes.append(data.size)
                removed.append(gone)
                counts.append(runs)
                kept.append(left)
                digests.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(digests)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return small_batches(joined).mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
