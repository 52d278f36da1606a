"""N-gram Jaccard join by token-combination prefixes (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.tables import small_batches
from cohortry.llm.words import mix, sequence_hash, shingle_hashes, text_runs, word_hashes, word_spans
from cohortry.operators.components import components
from cohortry.storage import materialize

SHINGLE = 3
#: Link when ``100 * shared >= PERCENT * union``.
PERCENT = 90
#: Tokens in more prefixes than this are frequent and are indexed in pairs. A bucket of so many rows costs 5e7 bitmap
#: comparisons, about a second; tokens that near copies share are kept single up to there, as they always come together.
FREQUENT = 10_000
#: Rows of one bucket that are compared in one piece.
PIECE = 1024
#: Rounds in which every class is first tried against its nearest partner of another component.
NEAREST_ROUNDS = 2
#: Up to so many class ids (some tens of MB in memory) are broadcast to fetch their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def prefix_length(n: int, percent: int) -> int:
    """Sets of similarity percent/100 share one token of their prefixes of this length; k more tokens, k + 1 shared."""
    return n - -(-percent * n // 100) + 1


def parity_bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bit for each residue, set when an odd number of elements falls on it; the size is the power of two from n up."""
    bits = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _fold(bitmaps: np.ndarray) -> np.ndarray:
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] ^ bitmaps[:, half:]


def _signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row: size of the shingle set, two digests of it, the extended prefix and the parity bitmap.

    Prefixes are in one total order of all shingles: by falling length of their words, then by hash. Long
    shingles are rare in any language, so prefixes hold rare tokens without a count of all shingles.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, prefixes, bitmaps = [], [], [], [], []
            for _, text, offsets in text_runs(batch.column("text")):
                starts, ends, heads = word_spans(text, offsets)
                words = word_hashes(text, starts, ends)
                grams = shingle_hashes(words, n)
                long = np.minimum(ends - starts, 1000).cumsum()
                spans = long[n - 1 :] - np.concatenate([[0], long[:-n]]) if len(words) >= n else np.zeros(0, np.int64)
                for k in range(len(offsets) - 1):
                    a, b = int(heads[k]), int(heads[k + 1])
                    if b - a >= n:
                        own, first = np.unique(grams[a : b - n + 1], return_index=True)
                        length = spans[a : b - n + 1][first]
                    else:
                        own = np.array([sequence_hash(words[a:b])] if b > a else [], np.uint64)
                        length = np.zeros(len(own), np.int64)
                    sizes.append(len(own))
                    one.append(int(mix(own ^ np.uint64(0x5851F42D)).sum(dtype=np.uint64).astype(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(mix(own ^ np.uint64(0x14057B7E))).astype(np.int64)) if len(own) else 0)
                    reach = min(len(own), prefix_length(len(own), percent) + 1) if len(own) else 0
                    order = np.lexsort((own, -length))[:reach]
                    prefixes.append(own[order].astype(np.int64))
                    bitmaps.append(parity_bitmap(own).tobytes() if len(own) else b"")
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists, pa.array(bitmaps, pa.binary())],
                names=["doc_id", "text_hash", "n", "set_id", "check", "prefix", "bitmap"],
            )

    return small_batches(docs.select("doc_id", "text_hash", "text")).mapInArrow(scan, "doc_id long, text_hash long, n long, set_id long, check long, prefix array<long>, bitmap binary")


def _verified(texts: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole shingle sets.

    Texts travel, not sets: they compress, hashes do not. Shingles go by 64-bit hashes of another seed than those of
    the index, so two shingles pass for one only if both hashes agree.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cohortry.llm.words import shingle_sets

        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(shingle_sets(batch.column("ta"), n, True, 1), shingle_sets(batch.column("tb"), n, True, 1), strict=True):
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    texts = texts.join(wanted, "cid", "left_semi")
    with_a = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
    return small_batches(with_b.select("a", "b", "ta", "tb")).mapInArrow(check, "a long, b long").distinct()


def _labels(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """Classes with ``label``, the smallest class reachable by the edges."""
    found = components(edges).withColumnRenamed("node", "cid").withColumnRenamed("component", "label")
    return classes.join(found, "cid", "left").withColumn("label", F.coalesce("label", "cid"))


class _Bucket:
    """The rows of one bucket piece, by growing set size, with their parity bitmaps as a matrix for each width."""

    def __init__(self, table: pa.Table, percent: int):
        size = np.array(table["n"])
        order = np.argsort(size, kind="stable")
        self.size, self.cid, self.label, self.piece = (np.array(table[k])[order] for k in ("n", "cid", "label", "piece"))
        self.apart = table["left"][0].as_py() != table["right"][0].as_py()
        self.percent = percent
        self.reach = np.searchsorted(self.size, self.size * 100 // percent, "right")
        raw = table["bitmap"].to_pylist()
        width = np.array([len(raw[k]) for k in order])
        self.blocks = []
        for w in np.unique(width):
            here = np.flatnonzero(width == w)
            self.blocks.append((here[0], here[-1] + 1, np.frombuffer(b"".join(raw[order[k]] for k in here), np.uint64).reshape(len(here), -1)))

    def partners(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Later rows of another label that may link with row i, and the bits in which the bitmaps differ.

        Those bits bound the symmetric difference from below, and sets that link differ by
        ``(100 - percent) / (100 + percent)`` of the sum of their sizes at most.
        """
        low, high = i + 1, int(self.reach[i])
        if low >= high:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        differ = np.full(high - low, np.iinfo(np.int64).max // 1000)
        mine = next(m[i - a] for a, b, m in self.blocks if a <= i < b)
        for a, b, matrix in self.blocks:
            x, y = max(a, low), min(b, high)
            if x < y:
                other = matrix[x - a : y - a]
                while other.shape[1] > len(mine):
                    other = _fold(other)
                differ[x - low : y - low] = np.bitwise_count(other ^ mine).sum(axis=1)
        fits = ((100 + self.percent) * differ <= (100 - self.percent) * (self.size[i] + self.size[low:high])) & (self.label[low:high] != self.label[i])
        if self.apart:
            fits &= self.piece[low:high] != self.piece[i]
        at = np.flatnonzero(fits)
        return at + low, differ[at]


def _near_pairs(rows: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """(a, b, differ): pairs of different label in one bucket whose sizes and bitmaps leave a link possible.

    ``rows``: key columns token, other, left, right (the pieces that meet), piece, cid, label, n, bitmap. Pairs are
    looked at inside the task. With ``nearest`` only each row's partner of least difference is returned,
    a row per class and task; otherwise all pairs that remain.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys = None, ["token", "other", "left", "right"]
        best: dict[int, tuple[int, int]] = {}
        found: list[np.ndarray] = []
        rows_held = 0

        def look(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal rows_held
            bucket = _Bucket(table, percent)
            cid = bucket.cid
            least, partner = np.full(len(cid), np.iinfo(np.int64).max), np.full(len(cid), -1)
            for i in range(len(cid)):
                others, differ = bucket.partners(i)
                if not len(others):
                    continue
                if not nearest:
                    found.append(np.stack([np.minimum(cid[i], cid[others]), np.maximum(cid[i], cid[others]), differ]))
                    rows_held += len(others)
                    if rows_held > 200_000:
                        yield out()
                    continue
                k = differ.argmin()
                if differ[k] < least[i]:
                    least[i], partner[i] = differ[k], others[k]
                closer = others[differ < least[others]]
                least[closer], partner[closer] = differ[differ < least[others]], i
            for i in np.flatnonzero(partner >= 0):
                x, new = int(cid[i]), (int(least[i]), int(cid[partner[i]]))
                if x not in best or new < best[x]:
                    best[x] = new
            if len(best) > 200_000:
                yield out()

        def out() -> pa.RecordBatch:
            nonlocal rows_held
            if nearest:
                columns = np.array([(x, y, d) for x, (d, y) in best.items()], np.int64).reshape(-1, 3).T
            else:
                columns = np.unique(np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1), axis=1)
            best.clear()
            found.clear()
            rows_held = 0
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["a", "b", "differ"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            change = np.zeros(table.num_rows, bool)
            change[0] = True
            for k in keys:
                v = np.array(table[k])
                change[1:] |= v[1:] != v[:-1]
            edges = np.flatnonzero(change)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > 1:
                    yield from look(table.slice(a, b - a))
            held = table.slice(edges[-1])
        if held is not None and held.num_rows > 1:
            yield from look(held)
        yield out()

    keys = ["token", "other", "left", "right"]
    return small_batches(rows.repartition(*keys).sortWithinPartitions(*keys)).mapInArrow(scan, "a long, b long, differ long")


def _pieces(rows: DataFrame) -> DataFrame:
    """Cut buckets into pieces of about ``PIECE`` rows; every pair of pieces meets once."""
    sizes = rows.groupBy("token", "other").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token", "other", F.ceil(F.col("m") / PIECE).cast("int").alias("pieces"))
    cut = rows.join(sizes, ["token", "other"]).withColumn("piece", F.pmod(F.xxhash64("cid"), F.col("pieces")).cast("int"))
    meet = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda k: F.struct(F.least(k, "piece").alias("left"), F.greatest(k, "piece").alias("right")))
    return cut.withColumn("meet", F.explode(meet)).select("token", "other", "meet.left", "meet.right", "piece", "cid", "label", "n")


def _distinct_buckets(rows: DataFrame) -> DataFrame:
    """Keep one bucket of those with the same members: near copies share many tokens, and each would give the same pairs."""
    members = rows.groupBy("token", "other").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"))
    kept = members.groupBy("m", "x", "y").agg(F.min(F.struct("token", "other")).alias("k")).select("k.token", "k.other")
    return rows.join(kept, ["token", "other"], "left_semi")


def jaccard_components(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Words are lower-cased ``[^\\x20\\x09-\\x0D]+``; a set is the distinct n-word shingles, or the whole sequence
    where there are fewer words. Equal sets are one class, and only classes are compared.

    A set's prefix holds its first ``n - ceil(t n) + 2`` tokens in an order common to all sets; sets that link share
    two tokens of it. Tokens that few prefixes hold are indexed alone, frequent ones in pairs with another
    frequent token of the prefix; every linked pair meets in a bucket, whichever kind the shared tokens are.
    Buckets are compared in pieces, where sizes and parity bitmaps bound the similarity from above. In the
    first rounds each class that has a possible partner is verified against its nearest partner of another component, so that groups of near
    copies join up by a few links a member. The last round verifies all pairs of different components
    that the bounds leave, on the exact sets, so no link is lost, and pairs inside a component are not listed.

    Null text and text without words have 0 shingles and are their own component. A null doc_id is kept;
    its component is the smallest non-null doc_id, or null. Repeated rows fall in one component. No rows give none.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    signed = materialize(_signatures(docs, n, percent), "signatures")
    first = F.min_by(F.struct("doc_id", "text_hash"), F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "text_hash"))
    # prefix and bitmap follow from the set, so any row of a class has them; copies are combined before they are shuffled
    one_each = signed.filter("n > 0").groupBy("set_id", "check", "n").agg(first.alias("r"), F.min("doc_id").alias("low_doc"), F.any_value("prefix").alias("prefix"), F.any_value("bitmap").alias("bitmap"))
    # a class goes by its first row, so that texts are found by what their rows hold
    named_by = F.xxhash64
    classes = materialize(one_each.select("set_id", "n", named_by("r.doc_id", "r.text_hash").alias("cid"), "low_doc", "prefix", "bitmap"), "classes")
    # sets of under nine shingles link with equal sets only
    able = classes.filter(F.col("n") * (100 - percent) >= percent)
    bitmaps = able.select("cid", "bitmap")
    tokens = able.select("cid", "n", F.explode("prefix").alias("token"))
    met = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    index = materialize(tokens.join(met, "token"), "index")

    rare = index.filter(F.col("df") <= FREQUENT).select("token", F.lit(0).cast("long").alias("other"), "cid", "n")
    heavy = index.filter(F.col("df") > FREQUENT).groupBy("cid", "n").agg(F.sort_array(F.collect_set("token")).alias("t"))
    combined = heavy.select("cid", "n", F.explode(F.flatten(F.transform("t", lambda x: F.transform(F.filter("t", lambda y: y > x), lambda y: F.struct(x.alias("token"), y.alias("other")))))).alias("c")).select("c.token", "c.other", "cid", "n")
    # a row can link only if its neighbour by size in the bucket is of about its size
    by_size = Window.partitionBy("token", "other").orderBy("n")
    alike = lambda x, y: F.coalesce(percent * F.greatest(x, y) <= 100 * F.least(x, y), F.lit(False))
    sized = rare.unionByName(combined).withColumns({"before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)})
    near = sized.filter(F.col("before").isNotNull() & alike(F.col("before"), F.col("n")) | F.col("after").isNotNull() & alike(F.col("after"), F.col("n")))
    buckets = materialize(_distinct_buckets(near.select("token", "other", "cid", "n")), "buckets")

    edges = docs.sparkSession.createDataFrame([], "a long, b long")
    labelled = classes.select("cid", F.col("cid").alias("label"))
    for k in range(NEAREST_ROUNDS + 1):
        nearest = k < NEAREST_ROUNDS
        pieces = _pieces(buckets.join(labelled, "cid") if k else buckets.withColumn("label", F.col("cid")))
        rows = pieces.join(bitmaps, "cid").select("token", "other", "left", "right", "piece", "cid", "label", "n", "bitmap")
        pairs = _near_pairs(rows, percent, nearest)
        if nearest:
            pairs = pairs.groupBy("a").agg(F.min_by("b", F.struct("differ", "b")).alias("b"))
        pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        if k == 0:
            # a class that the bounds leave no partner now has none later, when components have only grown
            alive = materialize(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "alive")
            buckets = materialize(buckets.join(alive, "cid", "left_semi"), "buckets")
            ids = F.broadcast(alive) if alive.count() <= BROADCAST_IDS else alive
            texts = materialize(docs.select(named_by("doc_id", "text_hash").alias("cid"), "text").join(ids, "cid", "left_semi"), "texts")
        edges = edges.unionByName(materialize(_verified(texts, pairs, n, percent), "links"))
        if nearest:
            labelled = materialize(_labels(classes.select("cid"), edges), "labels")
    final = _labels(classes.select("cid", "set_id", "low_doc"), edges)
    lowest = final.groupBy("label").agg(F.min("low_doc").alias("component_id"))
    named = final.join(lowest, "label").select("set_id", "component_id")
    some = signed.filter("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(named, "set_id").select("doc_id", "n_shingles", "component_id")
    return some.unionByName(signed.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
