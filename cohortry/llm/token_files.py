"""Token ids in bit planes (operator 3).

A segment is the image of one file: the ids of consecutive whole documents, cut into blocks of a fixed
number of ids. Every block is transposed into 16 or 32 bit planes (or 2 or 4 byte planes), every plane
is packed with zstandard, and an index stores where each block's planes are. Layout, little endian::

    magic "BPL1" | planes u8 | kind u8 (0 bit, 1 byte) | unused u16 | block ids u32 | ids u64 | blocks u32
    index: for each block and plane the packed length u32
    packed planes, block by block

Segments are rows of a Parquet table beside the documents they hold, so Spark's own reader and writer
carry them to any store, and each can be read alone.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.tables import small_batches
from cohortry.llm.words import WordTable, eights, lowered, text_runs, word_spans

BLOCK_IDS = 16_384
SEGMENT_IDS = 1 << 20
END_ID = 2
#: Kinds of planes.
BIT, BYTE = 0, 1
WORDS_KEPT = 500_000
BYTES_KEPT = 32 << 20

_POINT = np.zeros(256, bool)
_POINT[[44, 46]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_HEAD = struct.Struct("<4sBBHIQI")


def to_planes(ids: np.ndarray, planes: int, kind: int) -> list[bytes]:
    """Bit planes (kind 0), most significant first, or byte planes (kind 1) of unsigned ids."""
    if kind:
        rows = ids.astype(f"<u{planes}").view(np.uint8).reshape(-1, planes)
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(planes)]
    bits = np.unpackbits(ids.astype(f">u{planes // 8}").view(np.uint8).reshape(-1, planes // 8), axis=1)
    return [np.packbits(bits[:, k]).tobytes() for k in range(planes)]


def from_planes(parts: list[bytes], count: int, kind: int) -> np.ndarray:
    planes = len(parts)
    if kind:
        rows = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
        return np.ascontiguousarray(rows).view(f"<u{planes}").ravel().astype(np.uint32)
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count) for p in parts], axis=1)
    return np.packbits(bits, axis=1).view(f">u{planes // 8}").ravel().astype(np.uint32)


def pack(ids: np.ndarray, block_ids: int = BLOCK_IDS, kind: int = BIT, level: int = 1) -> bytes:
    """The file image of some ids below 2**32."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    planes = (4 if wide else 2) * (1 if kind else 8)
    packer = zstandard.ZstdCompressor(level=level)
    blocks = range(0, len(ids), block_ids)
    parts = [packer.compress(p) for i in blocks for p in to_planes(ids[i : i + block_ids], planes, kind)]
    head = _HEAD.pack(b"BPL1", planes, kind, 0, block_ids, len(ids), len(blocks))
    return b"".join([head, np.array([len(p) for p in parts], "<u4").tobytes(), *parts])


def unpack(image: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (all, unless given) of a file image."""
    magic, planes, kind, _, block_ids, count, blocks = _HEAD.unpack_from(image)
    if magic != b"BPL1":
        raise ValueError("not a bit-plane file")
    lengths = np.frombuffer(image, "<u4", blocks * planes, _HEAD.size)
    starts = _HEAD.size + 4 * len(lengths) + np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    reader = zstandard.ZstdDecompressor()
    out = [np.zeros(0, np.uint32)]
    for b in range(first, blocks if last is None else min(last, blocks)):
        at = range(b * planes, (b + 1) * planes)
        out.append(from_planes([reader.decompress(image[starts[k] : starts[k + 1]]) for k in at], min(block_ids, count - b * block_ids), kind))
    return np.concatenate(out)


class Encoder:
    """Ids of texts by a tokenizer file whose pre-tokenizer parts words at ASCII white space.

    Such a tokenizer encodes every blank-separated word on its own, so the ids of a text are those of its
    words one after another. Each new word goes through the library once; up to ``WORDS_KEPT`` words are
    kept, up to ``BYTES_KEPT`` bytes of them, and are found by a 64-bit hash; the bytes are then compared, and a run of texts in which
    two words share a hash is encoded by the library text by text. Where the tokenizer also parts a last full stop or comma from
    a letter before it, words are kept without them; where it lower-cases, words are kept in lower case, except those
    that hold the first character of a special token. All this is tried on probes when a file is opened.
    """

    #: Letters that may make up a plain word: such a word goes to the tokenizer's model without its pre-tokenizer, if probes allow.
    LETTERS = "".join(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        one = self._ids
        if any(one(a + gap + b) != one(a) + one(b) for a in ("ab", "Ab1,", "x.") for b in ("cd", "é|", ".") for gap in (" ", "\n", "\t", "  ", "\r\n")):
            raise ValueError("the tokenizer does not part words at white space")
        self.parts_points = all(one(w + p) == one(w) + one(p) for w in ("ab", "X", "qz") for p in (".", ","))
        self.lowers = all(one(w) == one(w.lower()) for w in ("AB", "aBc", "XyZZy"))
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(re.escape(x) for x in special) or "(?!)")
        self.model = self.tokenizer.model
        normalizer, parter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.normal = normalizer.normalize_str if normalizer else str
        self.parts = (lambda w: [p for p, _ in parter.pre_tokenize_str(w)]) if parter else (lambda w: [w])
        # how the pre-tokenizer writes each letter; whole words of letters must be written letter by letter
        written = {c: self.parts(c) for c in self.LETTERS}
        plain = all(len(p) == 1 for p in written.values()) and self.normal(self.LETTERS) == self.LETTERS and self.parts(self.LETTERS) == ["".join(p[0] for p in written.values())]
        self.written = {ord(c): p[0] for c, p in written.items()} if plain else {}
        self.plain = re.compile(f"[{self.LETTERS}]+" if plain else "(?!)")
        marks = "!$%&()*+,-./:;=?@[]^_`{}~#"
        tailed = plain and self.parts(marks) == [marks] and self.parts(self.LETTERS + marks) == [*self.parts(self.LETTERS), marks]
        self.tailed = re.compile(f"([{self.LETTERS}]+)([{re.escape(marks)}]+)" if tailed else "(?!)")
        self.tails: dict[str, list[int]] = {}
        if any(self._word(w) != one(w) for w in ("ab", "don't", "x-1.5é", "été", "ñu***", "ABc12", "e\u0301a", "İ9")):
            raise ValueError("the tokenizer adds to what its model and pre-tokenizer give")
        self.marks = np.zeros(256, bool)
        self.marks[[x.encode()[0] for x in special if x]] = True
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.words = WordTable()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int32)

    def _word(self, word: str) -> list[int]:
        if self.plain.fullmatch(word):
            return [t.id for t in self.model.tokenize(word.translate(self.written))]
        if self.odd.search(word):
            return self._ids(word)
        if tailed := self.tailed.fullmatch(word):
            tail = self.tails.get(tailed[2])
            if tail is None:
                if len(self.tails) > 10_000:
                    self.tails.clear()
                tail = self.tails[tailed[2]] = [t.id for part in self.parts(self.normal(tailed[2])) for t in self.model.tokenize(part)]
            return self._word(tailed[1]) + tail
        return [t.id for part in self.parts(self.normal(word)) for t in self.model.tokenize(part)]

    def _learn(self, words: list[bytes]) -> None:
        found = [self._word(w.decode()) for w in words]
        at, new = len(self.words), len(words)
        ends = self.ends[at] + np.cumsum([len(x) for x in found])
        while at + new >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.ends[at] : ends[-1]] = [i for x in found for i in x]
        self.ends[at + 1 : at + 1 + new] = ends

    def _folded(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes by which words are kept."""
        if not self.lowers:
            return text
        out, marked = lowered(text), np.flatnonzero(self.marks[text])
        for k in np.unique(np.searchsorted(starts, marked, "right") - 1).tolist():
            out[starts[k] : ends[k]] = text[starts[k] : ends[k]]
        return out

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of a column; null counts as empty."""
        for _, text, offsets in text_runs(column):
            if len(self.words) > WORDS_KEPT or self.words.size > BYTES_KEPT:
                self._clear()
            starts, ends, _ = word_spans(text, offsets)
            if self.parts_points and len(starts):
                point = (ends - starts > 1) & _POINT[text[ends - 1]] & _LETTER[text[ends - 2]]
                split_starts, split_ends = np.repeat(starts, 1 + point), np.repeat(ends, 1 + point)
                # where the second part of each parted word stands
                tails = np.flatnonzero(point) + np.arange(1, int(point.sum()) + 1)
                split_starts[tails] = split_ends[tails] - 1
                split_ends[tails - 1] -= 1
                starts, ends = split_starts, split_ends
            places = self.words.places(eights(self._folded(text, starts, ends)), starts, ends - starts, self._learn)
            if places is None:
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    yield np.array(self._ids(text[a:b].tobytes().decode()), np.uint32)
                continue
            low = self.ends[places]
            counts = self.ends[places + 1] - low
            total = np.concatenate([[0], np.cumsum(counts)])
            ids = self.flat[np.arange(total[-1]) + np.repeat(low - total[:-1], counts)]
            edges = total[np.searchsorted(starts, offsets)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield ids[a:b]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_column(pa.array([text])))


_encoders: dict[str, Encoder] = {}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, kind: int = BYTE, block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS, end_id: int = END_ID) -> None:
    """Encode the whole text of every row, append ``end_id``, and write segments in ascending doc_id order.

    Rows are dealt by range of doc_id, so partitions follow one another; a segment holds whole documents
    and is closed at ``segment_ids`` ids. Null text counts as empty (its only id is ``end_id``), a null
    doc_id stands first, rows of equal doc_id stand in the order of a hash of the text. An empty table
    writes an empty table. Table columns: part, seq, n_ids, ids of documents, their counts, image.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        coder = _encoders[tokenizer]
        keys, held, size, seq = [], [], 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            columns = [[part], [seq], [len(ids)], [keys], [[len(x) for x in held]], [pack(ids, block_ids, kind)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()], strict=True)], names=["part", "seq", "n_ids", "doc_ids", "counts", "image"])

        for batch in batches:
            for key, found in zip(batch.column("doc_id").to_pylist(), coder.encode_column(batch.column("text")), strict=True):
                ids = np.append(found, np.uint32(end_id))
                keys.append(key)
                held.append(ids)
                size += len(ids)
                if size >= segment_ids:
                    yield segment()
                    keys, held, size, seq = [], [], 0, seq + 1
        if held:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    schema = "part int, seq int, n_ids long, doc_ids array<long>, counts array<long>, image binary"
    small_batches(ordered).mapInArrow(encode, schema).write.option("compression", "uncompressed").parquet(path)


def read_tokens(files: DataFrame, ids: bool = False) -> DataFrame:
    """Per document of a written table: doc_id, start, n_tokens, ids_crc32, and with ``ids`` the ids themselves.

    start counts the ids of all documents before it. Bases of partitions and segments come from the
    narrow columns of the table, summed by partition first.
    """
    by_part = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_base"))
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("seg_base")).join(by_part, "part").select("part", "seq", (F.col("part_base") + F.col("seg_base")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                got = unpack(row["image"].as_buffer().to_pybytes()).astype("<u4")
                counts = np.array(row["counts"].as_py(), np.int64)
                ends = np.cumsum(counts)
                spans = list(zip((ends - counts).tolist(), ends.tolist(), strict=True))
                columns = [row["doc_ids"].values, pa.array([row["part"].as_py()] * len(counts), pa.int32()), pa.array([row["seq"].as_py()] * len(counts), pa.int32()), pa.array(ends - counts), pa.array(counts), pa.array([zlib.crc32(got[a:b].tobytes()) for a, b in spans], pa.int64())]
                names = ["doc_id", "part", "seq", "own", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array([got[a:b].astype(np.int64) for a, b in spans], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<long>" if ids else ""
    docs = small_batches(files.select("part", "seq", "doc_ids", "counts", "image")).mapInArrow(decode, "doc_id long, part int, seq int, own long, n_tokens long, ids_crc32 long" + more)
    return docs.join(bases, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
