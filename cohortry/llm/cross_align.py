"""Alignment of two tokenizers over whole documents, with counts of the linked id pairs (operator 12).

Tokens of a byte-level tokenizer (A) and of a piece tokenizer (B) are cut into groups where both end. The
two last tokens of a group are linked. A first pass aligns the documents and counts pairs within each task.
The distinct pairs are dealt into shards, and every shard gets a minimal perfect hash with its keys. Tasks
turn their counts into dense vectors indexed by the hash, and the vectors are summed as a tree. A second
pass aligns the documents again and looks up what their links count; the lookups travel in blocks of
documents, by shard, and only sums per document come back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.llm.bpe_words import EDGE, gathered, joined, numbers, packed, pieces, runs, tokenizer, word_ids
from cohortry.llm.perfect_hash import PerfectHash
from cohortry.llm.tables import small_batches
from cohortry.llm.words import mix
from cohortry.storage import materialize

#: Words that a worker keeps with their alignment, and bytes of text that make up a block.
WORDS_KEPT = 400_000
BLOCK_BYTES = 4 << 20
#: Pairs that a task counts before it hands them on, pairs of a shard, counts of a leaf of the tree, links of a lookup, children of a node.
PAIRS_HELD = 1 << 20
SHARD_PAIRS = 1 << 16
LEAF_ROWS = 1 << 18
LOOKUP_LINKS = 8 << 20
CHILDREN = 8
COMMA, BAR, SEMICOLON = (pa.scalar(x, pa.large_string()) for x in ",|;")


class Aligner:
    """Alignments of words; a word begins at a blank that does not follow white space, the first one at the blank before the text.

    Neither tokenizer joins characters across the beginning of a word, so a text is aligned word by word. A word whose
    pieces do not give its own bytes has no alignment, and a text with such a word has none.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = tokenizer(a_path, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = pieces(a_path)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("a piece joins words")
        self.b_bytes = pa.array([bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)], pa.binary())
        self.a_sizes, self.b_sizes = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (self.a_bytes, self.b_bytes))
        self.decimal = pa.array([str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))], pa.large_string())
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.n_a, self.n_b, self.n_groups, self.first = none, none, none, none
        # the links of all words by the number of their pair, and the pairs by number
        self.links, self.pairs, self.number = none, none, {}
        self.fits, self.text = np.zeros(0, bool), pa.array([], pa.large_string())

    def places(self, words: pa.Array) -> np.ndarray:
        """The number of every word among those kept; new ones are aligned."""
        if len(self.known) > WORDS_KEPT:
            self._clear()
        coded = words.cast(pa.large_string()).dictionary_encode()
        different = coded.dictionary.to_pylist()
        new = [w for w in different if w not in self.known]
        if new:
            self._learn(new)
        found = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        return found[coded.indices.to_numpy()]

    def _learn(self, words: list[str]) -> None:
        n = len(words)
        sides = []
        count, ids = word_ids(self.a, pa.array(words, pa.large_string()), self.a_sizes)
        sides.append((ids, count, self.a_bytes, self.a_sizes))
        # the piece tokenizer puts the blank of a word in front itself, but not of a blank alone, at the end of a text
        lists = self.b.encode([w[1:] for w in words], num_threads=1)
        lists = [x if w != " " else [self.b.piece_to_id("▁")] for x, w in zip(lists, words, strict=True)]
        count = np.fromiter(map(len, lists), np.int64, n)
        sides.append((np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum())), count, self.b_bytes, self.b_sizes))
        own = [w.encode() for w in words]
        length, fits = np.fromiter(map(len, own), np.int64, n), np.ones(n, bool)
        for ids, count, table, sizes in sides:
            given = np.bincount(np.repeat(np.arange(n), count), weights=sizes[ids], minlength=n).astype(np.int64)
            if (given != length).any() or joined(table.take(pa.array(ids))) != b"".join(own):
                ends = np.cumsum(count)
                fits &= [joined(table.take(pa.array(ids[e - c : e]))) == w for e, c, w in zip(ends.tolist(), count.tolist(), own, strict=True)]
        tokens, counts, ends = [], [], []
        for ids, count, _, sizes in sides:
            keep = np.repeat(fits, count)
            tokens.append(ids[keep])
            counts.append(np.where(fits, count, 0))
            ends.append(np.cumsum(sizes[ids[keep]]))
        both = [np.isin(e, o, assume_unique=True) for e, o in (ends, ends[::-1])]
        groups = []
        for ids, mark in zip(tokens, both, strict=True):
            cuts = np.concatenate([[0], np.flatnonzero(mark) + 1])
            groups.append(pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), self.decimal.take(pa.array(ids))), COMMA))
        of = np.repeat(np.arange(n), counts[0])[both[0]]
        n_groups = np.bincount(of, minlength=n)
        cuts = np.concatenate([[0], np.cumsum(n_groups)])
        text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), pc.binary_join_element_wise(*groups, BAR)), SEMICOLON)
        at = len(self.known)
        self.known.update(zip(words, range(at, at + n), strict=True))
        self.first = np.concatenate([self.first, len(self.links) + cuts[:-1]])
        pairs, which = np.unique(tokens[0][both[0]] << 32 | tokens[1][both[1]], return_inverse=True)
        fresh = [p for p in pairs.tolist() if p not in self.number]
        self.number.update(zip(fresh, range(len(self.pairs), len(self.pairs) + len(fresh)), strict=True))
        self.pairs = np.concatenate([self.pairs, np.array(fresh, np.int64)])
        self.links = np.concatenate([self.links, np.fromiter(map(self.number.__getitem__, pairs.tolist()), np.int64, len(pairs))[which]])
        self.n_a, self.n_b, self.n_groups = (np.concatenate(x) for x in ((self.n_a, counts[0]), (self.n_b, counts[1]), (self.n_groups, n_groups)))
        self.fits, self.text = np.concatenate([self.fits, fits]), pa.concat_arrays([self.text, text])


class Block:
    """The aligned documents of a block: ``at`` numbers the words, ``edges`` parts them by document, ``ok`` marks documents with tokens."""

    def __init__(self, aligner: Aligner, counts: np.ndarray, words: pa.Array):
        self.aligner, self.counts = aligner, counts
        self.at = aligner.places(words)
        self.edges = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.ok = (counts > 0) & (self.total(~aligner.fits) == 0)

    def total(self, of_word: np.ndarray) -> np.ndarray:
        """A figure of words, added up by document."""
        sums = np.concatenate([[0], np.cumsum(of_word[self.at], dtype=np.int64)])[self.edges]
        return sums[1:] - sums[:-1]

    def texts(self) -> pa.Array:
        """``a1,a2|b1;a3|b2`` of every document, empty without tokens."""
        text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(self.edges), self.aligner.text.take(pa.array(self.at))), SEMICOLON)
        return pc.if_else(pa.array(self.ok), text, pa.scalar("", pa.large_string()))

    def facts(self) -> list[np.ndarray]:
        """Numbers of tokens of A and B and of groups."""
        return [np.where(self.ok, self.total(x), 0) for x in (self.aligner.n_a, self.aligner.n_b, self.aligner.n_groups)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, number of a pair, how often it is linked there), by document."""
        mine = np.repeat(self.ok, self.counts)
        word = self.at[mine]
        n = self.aligner.n_groups[word]
        doc = np.repeat(np.repeat(np.arange(len(self.counts)), self.counts)[mine], n)
        wide = max(1, len(self.aligner.pairs))
        key, often = np.unique(doc * wide + self.aligner.links[runs(self.aligner.first[word], n)], return_counts=True)
        return key // wide, key % wide, often


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id and the words of a blank and the text; null and empty texts have none."""
    words = F.when(F.length(F.col(text)) > 0, F.split(F.concat(F.lit(" "), F.col(text)), EDGE, -1))
    return small_batches(docs.select(F.col(key).alias("doc_id"), words.alias("words")))


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups and groups, the groups of ids as text (``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts that B's pieces do not give back byte by byte, have no tokens. Repeated rows and null keys are kept; no rows give none.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")], T.StructField("groups", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts, words in gathered(batches, BLOCK_BYTES):
            block = Block(_aligner((a_path, b_path)), counts, words)
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, block.facts()), block.texts().cast(pa.string())], names=schema.fieldNames())

    return _words(docs, key, text).mapInArrow(run, schema)


def _counted(pairs: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, at = np.unique(pairs, return_inverse=True)
    return different, np.bincount(at, weights=often, minlength=len(different)).astype(np.int64)


def _hashed(pairs: np.ndarray) -> np.ndarray:
    return mix(pairs.astype(np.uint64)).view(np.int64)


def pair_counts(words: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The first pass: part, pair (a * 2**32 + b), hash and n, links counted within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        pairs, often = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), part, np.int64)), pa.array(pairs), pa.array(_hashed(pairs)), pa.array(often)], names=["part", "pair", "hash", "n"])

        for _, counts, words in gathered(batches, BLOCK_BYTES):
            block = Block(_aligner(paths), counts, words)
            aligner = block.aligner
            uses = np.bincount(block.at[np.repeat(block.ok, counts)], minlength=len(aligner.fits))
            used = np.flatnonzero(uses)
            n = aligner.n_groups[used]
            # sums of a task stay far below 2**53
            here = np.bincount(aligner.links[runs(aligner.first[used], n)], weights=np.repeat(uses[used], n), minlength=len(aligner.pairs)).astype(np.int64)
            met = np.flatnonzero(here)
            pairs, often = _counted(np.concatenate([pairs, aligner.pairs[met]]), np.concatenate([often, here[met]]))
            if len(pairs) > PAIRS_HELD:
                yield out()
                pairs, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(pairs):
            yield out()

    return words.mapInArrow(run, "part long, pair long, hash long, n long")


def _load(row: dict) -> PerfectHash:
    return PerfectHash.load(row["sizes"], row["bits"], row["keys"])


def pair_index(counts: DataFrame) -> tuple[DataFrame, int]:
    """Per shard: its perfect hash (sizes, bits, keys) and ``counts``, the dense vector of what its pairs count; and the number of shards."""
    distinct = materialize(counts.select("pair", "hash").distinct(), "pairs")
    shards = -(-distinct.count() // SHARD_PAIRS) or 1
    shard = F.pmod(F.col("hash"), F.lit(shards)).alias("shard")

    def build(group: pa.Table) -> pa.Table:
        sizes, bits, keys = PerfectHash.of(group.column("pair").to_numpy()).dump()
        return pa.table([group.column("shard")[:1], pa.array([sizes], pa.list_(pa.int64())), pa.array([bits], pa.binary()), pa.array([keys], pa.binary())], names=["shard", "sizes", "bits", "keys"])

    hashes = materialize(distinct.select(shard, "pair").groupBy("shard").applyInArrow(build, "shard long, sizes array<long>, bits binary, keys binary"), "hashes")
    leaves = -(-counts.count() // (shards * LEAF_ROWS)) or 1

    def dense(rows: pa.Table, index: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.binary())], names=["shard", "leaf", "vector"])
        found = _load(index.to_pylist()[0])
        at = found.find(rows.column("pair").to_numpy())
        if (at < 0).any():
            raise ValueError("a pair is none of the keys")
        vector = np.zeros(len(found.keys), np.int64)
        np.add.at(vector, at, rows.column("n").to_numpy())
        return pa.table([rows.column("shard")[:1], rows.column("leaf")[:1], pa.array([vector.tobytes()], pa.binary())], names=["shard", "leaf", "vector"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.int64) for v in group.column("vector").to_pylist())
        return pa.table([group.column("shard")[:1], group.column("leaf")[:1], pa.array([total.tobytes()], pa.binary())], names=["shard", "leaf", "vector"])

    dealt = counts.select(shard, F.pmod(F.col("part"), F.lit(leaves)).alias("leaf"), "pair", "n").groupBy("shard", "leaf")
    copies = hashes.withColumn("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(leaves - 1).cast("long")))).groupBy("shard", "leaf")
    vectors = dealt.cogroup(copies).applyInArrow(dense, "shard long, leaf long, vector binary")
    while leaves > 1:
        leaves = -(-leaves // CHILDREN)
        vectors = vectors.withColumn("leaf", F.floor(F.col("leaf") / CHILDREN).cast("long")).groupBy("shard", "leaf").applyInArrow(add, "shard long, leaf long, vector binary")
    return materialize(hashes.join(vectors.select("shard", F.col("vector").alias("counts")), "shard"), "index"), shards


def _best(index: DataFrame) -> dict[int, int]:
    """The highest count of every id of B; as many as B's vocabulary has at most."""

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, n = (np.frombuffer(row["keys"], "<u8") & np.uint64(0xFFFFFFFF)).astype(np.int64), np.frombuffer(row["counts"], np.int64)
                order = np.lexsort((n, ids))
                last = np.flatnonzero(np.diff(ids[order], append=-1))
                yield pa.RecordBatch.from_arrays([pa.array(ids[order][last]), pa.array(n[order][last])], names=["b", "n"])

    return {r["b"]: r["n"] for r in index.select("keys", "counts").mapInArrow(most, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).collect()}


def count_links(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256.

    Tokens of A and B that end at one byte are linked; a pair of ids counts how many links of all rows hold it. n_best are the links whose count is the
    highest of their B id, count_sum adds up the counts of the links. Texts without tokens (see ``align``) have zeros and an empty digest. Null keys and repeated rows are
    kept and counted each; no rows give none. Special tokens of A inside a text are text.
    """
    paths, words = (a_path, b_path), _words(docs, key, text)
    counts = materialize(pair_counts(words, paths), "counts")
    index, shards = pair_index(counts)
    links = counts.agg(F.sum("n")).first()[0] or 0
    salts = -(-links // (shards * LOOKUP_LINKS)) or 1
    best = np.zeros(1, np.int64)
    if found := _best(index):
        best = np.zeros(max(found) + 1, np.int64)
        best[list(found)] = list(found.values())
    key_type = docs.schema[key].dataType
    cells = [("block", T.LongType()), ("shard", T.LongType()), ("doc_ids", T.ArrayType(key_type)), ("facts", T.ArrayType(T.ArrayType(T.LongType()))), ("digests", T.ArrayType(T.StringType()))]
    cells += [(n, T.BinaryType()) for n in ("pairs", "at", "often", "docs", "spans")]
    asked_schema = T.StructType([T.StructField(*c) for c in cells])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, arrow = TaskContext.get().partitionId() << 32, to_arrow_schema(asked_schema)

        def row(*values) -> list:
            return [*values, *[None] * (len(arrow) - len(values))]

        for number, (keys, counts, words) in enumerate(gathered(batches, BLOCK_BYTES)):
            block = Block(_aligner(paths), counts, words)
            texts = block.texts()
            digests = [hashlib.sha256(x.as_buffer()).hexdigest() if ok else "" for x, ok in zip(texts, block.ok.tolist(), strict=True)]
            del texts
            # what needs no lookup goes under a shard of its own
            out = [row(part + number, -1, keys, [x.tolist() for x in block.facts()], digests)]
            doc, pair, often = block.links()
            shard = _hashed(block.aligner.pairs) % shards
            order = np.argsort(shard[pair], kind="stable")
            edges = np.searchsorted(shard[pair][order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(edges)).tolist():
                mine = order[edges[s] : edges[s + 1]]
                used = np.bincount(pair[mine], minlength=len(block.aligner.pairs)) > 0
                local = (np.cumsum(used) - 1)[pair[mine]]
                # links stand by document
                heads = np.flatnonzero(np.diff(doc[mine], prepend=-1))
                spans = np.diff(heads, append=len(mine))
                out.append([part + number, s, None, None, None, zstandard.compress(block.aligner.pairs[used].tobytes()), packed(local), packed(often[mine]), packed(doc[mine][heads]), packed(spans)])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], names=arrow.names)

    def look_up(rows: pa.Table, index: pa.Table) -> pa.Table:
        out = {"block": [], "docs": [], "n_best": [], "count_sum": []}
        if rows.num_rows:
            (shard,) = index.to_pylist()
            found, n = _load(shard), np.frombuffer(shard["counts"], np.int64)
            top = n == best[(found.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            for r in rows.to_pylist():
                at = found.find(np.frombuffer(zstandard.decompress(r["pairs"]), np.int64))
                if (at < 0).any():
                    raise ValueError("a pair is none of the keys")
                at, often, spans = at[numbers(r["at"])], numbers(r["often"]).astype(np.int64), numbers(r["spans"]).astype(np.int64)
                starts = np.cumsum(spans) - spans
                out["block"].append(r["block"])
                out["docs"].append(numbers(r["docs"]).tolist())
                out["n_best"].append(np.add.reduceat(often * top[at], starts).tolist())
                out["count_sum"].append(np.add.reduceat(often * n[at], starts).tolist())
        return pa.table([pa.array(out["block"], pa.int64()), *(pa.array(out[k], pa.list_(pa.int64())) for k in ("docs", "n_best", "count_sum"))], names=list(out))

    asked = materialize(words.mapInArrow(ask, asked_schema), "asked")
    salt = F.pmod(F.col("block"), F.lit(salts))
    questions = asked.filter("shard >= 0").select("block", "shard", salt.alias("salt"), "pairs", "at", "often", "docs", "spans").groupBy("shard", "salt")
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).groupBy("shard", "salt")
    sums = questions.cogroup(copies).applyInArrow(look_up, "block long, docs array<long>, n_best array<long>, count_sum array<long>")
    by_doc = sums.select("block", F.explode(F.arrays_zip("docs", "n_best", "count_sum")).alias("s")).groupBy("block", F.col("s.docs").alias("no")).agg(F.sum("s.n_best").alias("n_best"), F.sum("s.count_sum").alias("count_sum"))
    own = asked.filter("shard < 0").select("block", F.posexplode(F.arrays_zip("doc_ids", F.col("facts")[0].alias("n_a"), F.col("facts")[1].alias("n_b"), F.col("facts")[2].alias("n_groups"), "digests")).alias("no", "d"))
    whole = own.withColumn("no", F.col("no").cast("long")).join(by_doc, ["block", "no"], "left")
    return whole.select(
        F.col("d.doc_ids").alias("doc_id"), *(F.col(f"d.{n}").alias(n) for n in ("n_a", "n_b", "n_groups")), F.col("d.n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), F.col("d.digests").alias("groups_sha256"),
    )
