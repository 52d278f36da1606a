"""Byte-level BPE by a table of distinct words, and back through the pieces of the ids (operator 13).

Spark splits every text before each blank that follows a character other than white space. A byte-level
tokenizer never joins characters across such a place, so the ids of a text are those of its words, one
after another. Documents are gathered in blocks; a block keeps its different words once and, for every
place, the number of the word there. The words of all blocks are dealt into buckets by a hash, each
bucket encodes every different word once, and the ids return to the places of the block.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.llm.tables import small_batches
from cohortry.llm.words import eights, hash_eights
from cohortry.storage import bucketed

#: White space as tokenizers see it (fixed values), and the place before a blank that does not follow any.
SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
EDGE = rf"(?= )(?<=[^{SPACE}])"
#: The same white space in the other syntax of Arrow's patterns.
TRAIL = re.sub(r"\\u(....)", r"\\x{\1}", SPACE)
#: Bytes of text that make up a block, words of a bucket, ids that leave a task and words that are encoded at a time.
BLOCK_BYTES = 16 << 20
BUCKET_WORDS = 1 << 20
IDS_OUT = 1 << 20
ENCODED = 4096


@lru_cache(maxsize=4)
def tokenizer(path: str, special_as_text: bool = False):
    """The tokenizer of a file, without truncation and padding; refused if it does not part words at blanks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = special_as_text

    def one(text: str) -> list[int]:
        return found.encode(text, add_special_tokens=False).ids

    words = ["ab", " Cd", " é.", " 12", "  x", " \n y", " 's", " |"]
    if any(one(a + b) != one(a) + one(b) for a in words for b in words[1:]) or one("  ab") == one(" ") + one("ab"):
        raise ValueError("the tokenizer does not part words at blanks")
    return found


@lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array:
    """The bytes of every id; an id that the vocabulary lacks has none.

    In the byte-level alphabet the printable bytes of Latin-1 stand for themselves, and the others, in their order, for the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for piece, number in vocabulary.items():
        out[number] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return pa.array(out, pa.binary())


def joined(values: pa.Array) -> bytes:
    """All strings of an array, one after another."""
    if not len(values):
        return b""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(values)]), values.cast(pa.large_binary()))
    return pc.binary_join(whole, pa.scalar(b"", pa.large_binary()))[0].as_buffer().to_pybytes()


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers in byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
    """Blocks of rows (doc_id, words) of about ``limit`` bytes: their ids, how many words each has, and all words in order."""
    keys, counts, held, size = [], [], [], 0
    for batch in batches:
        lists = batch.column("words")
        keys.append(batch.column("doc_id"))
        counts.append(pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int32))
        held.append(lists.flatten())
        size += held[-1].nbytes
        if size >= limit:
            yield pa.concat_arrays(keys), np.concatenate(counts), pa.concat_arrays(held)
            keys, counts, held, size = [], [], [], 0
    if held:
        yield pa.concat_arrays(keys), np.concatenate(counts), pa.concat_arrays(held)


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of documents: block, doc_ids, how many words each has, n_words, codes (a number for every place), sizes and bytes of the different words."""
    key = rows.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(key)), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("n_words", T.LongType())]
        + [T.StructField(n, T.BinaryType()) for n in ("codes", "sizes", "bytes")]
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        for block, (keys, counts, places) in enumerate(gathered(batches, BLOCK_BYTES)):
            coded = places.cast(pa.large_binary()).dictionary_encode()
            words = coded.dictionary
            sizes = pc.binary_length(words).to_numpy()
            columns = [[part + block], [keys], [counts], [len(words)], [packed(coded.indices.to_numpy())], [packed(sizes)], [zstandard.compress(joined(words))]]
            types = [pa.int64(), pa.list_(keys.type), pa.list_(pa.int32()), pa.int64(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())

    return small_batches(rows).mapInArrow(gather, schema)


def _strings(sizes: np.ndarray, data: bytes) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _asked(blocks: DataFrame, buckets: int) -> DataFrame:
    """The words of every block by bucket: block, bucket, places (of the words in the block), sizes, bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes, data = numbers(row["sizes"]).astype(np.int64), zstandard.decompress(row["bytes"])
                words, starts = _strings(sizes, data), np.cumsum(sizes) - sizes
                bucket = (hash_eights(eights(np.frombuffer(data, np.uint8)), starts, sizes) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1)) if buckets <= len(order) else np.concatenate([np.flatnonzero(np.diff(bucket[order], prepend=-1)), [len(order)]])
                out = [[], [], [], [], []]
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if a < b:
                        at = order[a:b]
                        cells = row["block"], int(bucket[at[0]]), packed(at), packed(sizes[at]), zstandard.compress(joined(words.take(pa.array(at))))
                        for column, cell in zip(out, cells, strict=True):
                            column.append(cell)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int64(), pa.int64(), *[pa.binary()] * 3], strict=True)], names=["block", "bucket", "places", "sizes", "bytes"])

    return small_batches(blocks.select("block", "sizes", "bytes")).mapInArrow(deal, "block long, bucket long, places binary, sizes binary, bytes binary")


def word_ids(found, words: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each word has, and all ids; ``sizes`` has the bytes of every id.

    The library takes long to hand over a result, so ``ENCODED`` words go to it as one text where they may: a word that begins with a blank, after one that
    ends with another character than white space, begins at an edge. The bytes of the ids then tell which word they are of.
    """
    count = np.zeros(len(words), np.int64)
    flat = [np.zeros(0, np.int64)]
    length = pc.binary_length(words).to_numpy().astype(np.int64)
    apart = pc.or_(pc.invert(pc.starts_with(words, " ")), pc.match_substring_regex(words, rf"[{TRAIL}]\z")).to_numpy(zero_copy_only=False) | (length == 0)
    for a in range(0, len(words), ENCODED):
        some = words[a : a + ENCODED]
        alone = np.flatnonzero(apart[a : a + ENCODED])
        together = np.flatnonzero(~apart[a : a + ENCODED])
        texts = [joined(some.take(pa.array(together))).decode(), *some.take(pa.array(alone)).to_pylist()]
        ids = [e.ids for e in found.encode_batch_fast(texts, add_special_tokens=False)]
        own = np.array(ids[0], np.int64)
        ends = np.cumsum(length[a + together])
        at = np.searchsorted(np.cumsum(sizes[own]), ends, "right")
        count[a + together] = np.diff(at, prepend=0)
        count[a + alone] = [len(x) for x in ids[1:]]
        first = np.zeros(len(some), np.int64)
        first[together] = at - count[a + together]
        first[alone] = len(own) + np.cumsum(count[a + alone]) - count[a + alone]
        every = np.concatenate([own, np.fromiter(chain.from_iterable(ids[1:]), np.int64)])
        flat.append(every[runs(first, count[a : a + ENCODED])])
    return count, np.concatenate(flat)


def _answers(asked: DataFrame, path: str) -> DataFrame:
    """block, places, counts and ids of the words there; every different word of a bucket is encoded once."""

    def encode(group: pa.Table) -> pa.Table:
        sizes = [numbers(x) for x in group.column("sizes").to_pylist()]
        coded = _strings(np.concatenate(sizes), b"".join(map(zstandard.decompress, group.column("bytes").to_pylist()))).dictionary_encode()
        count, flat = word_ids(tokenizer(path), coded.dictionary.cast(pa.large_string()), pc.binary_length(pieces(path)).to_numpy())
        first = np.cumsum(count) - count
        codes, at, counts, ids = coded.indices.to_numpy(), 0, [], []
        for n in map(len, sizes):
            here = codes[at : at + n]
            at += n
            counts.append(packed(count[here]))
            ids.append(packed(flat[runs(first[here], count[here])]))
        return pa.table([group.column("block"), group.column("places"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())], names=["block", "places", "counts", "ids"])

    return asked.groupBy("bucket").applyInArrow(encode, "block long, places binary, counts binary, ids binary")


def runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... as many as count[0], then the same of the next."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and ids (array<int>) of the whole text, as the library's ``encode(text, add_special_tokens=False)`` with the file ``path``.

    Null and empty texts have no ids; null keys and repeated rows are kept; no rows give none; other columns are ignored.
    A block holds 16 MB of text (one text at least), a bucket about a million words, and neither is split in memory further.
    """
    words = F.split(F.coalesce(F.col(text), F.lit("")), EDGE, -1)
    blocks = bucketed(_blocks(docs.select(F.col(key).alias("doc_id"), words.alias("words"))), "block", "words")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    answers = _answers(_asked(blocks, -(-total // BUCKET_WORDS) or 1), path)
    found = answers.groupBy("block").agg(F.collect_list(F.struct("places", "counts", "ids")).alias("found"))
    whole = blocks.select("block", "doc_ids", F.col("counts").alias("words"), "n_words", "codes").join(found, "block").drop("block")
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, words, n_words, codes, found = (batch.column(n)[k] for n in ("doc_ids", "words", "n_words", "codes", "found"))
                count, flat, first, at = np.zeros(n_words.as_py(), np.int64), [], np.zeros(n_words.as_py(), np.int64), 0
                for part in found.as_py():
                    places, own, ids = (numbers(part[n]).astype(np.int64) for n in ("places", "counts", "ids"))
                    count[places], first[places] = own, at + np.cumsum(own) - own
                    flat.append(ids.astype(np.int32))
                    at += len(ids)
                flat, codes = np.concatenate(flat), numbers(codes.as_py())
                edges = np.concatenate([[0], np.cumsum(words.values.to_numpy())])
                at = np.concatenate([[0], np.cumsum(count[codes])])[edges]
                a = 0
                while a < len(keys):
                    b = max(a + 1, int(np.searchsorted(at, at[a] + IDS_OUT, "right")) - 1)
                    here = codes[edges[a] : edges[b]]
                    ids = pa.ListArray.from_arrays(pa.array(at[a : b + 1] - at[a], pa.int32()), pa.array(flat[runs(first[here], count[here])]))
                    yield pa.RecordBatch.from_arrays([keys.values[a:b], ids], names=["doc_id", "ids"])
                    a = b

    return small_batches(whole).mapInArrow(place, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns, and ``decoded``: the text of the ids, as the library's ``decode(ids, skip_special_tokens=False)``.

    Every id is joined with its piece: the table of pieces has a row per id, so its size is bounded by the vocabulary, and a task holds it as an array
    that the ids of a batch index. Null ids give null, ids that the vocabulary lacks give nothing; bytes that are no UTF-8 become replacement characters.
    """
    schema = T.StructType([f for f in encoded.schema if f.name != "decoded"] + [T.StructField("decoded", T.StringType())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        for batch in batches:
            lists = batch.column(ids)
            flat = lists.values.cast(pa.int64())
            known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table)))
            if flat.null_count or not pc.all(known).as_py():
                flat = pc.if_else(pc.fill_null(known, False), flat, len(table))
            taken = pa.concat_arrays([table, pa.array([b""], pa.binary())]).take(flat) if len(flat) else pa.array([], pa.binary())
            whole = pc.binary_join(pa.LargeListArray.from_arrays(lists.offsets.cast(pa.int64()), taken), b"")
            texts = [None if null else data.decode("utf-8", "replace") for data, null in zip(whole.to_pylist(), lists.is_null().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in schema.fieldNames()[:-1]), pa.array(texts, pa.string())], names=schema.fieldNames())

    return small_batches(encoded).mapInArrow(join, schema)
