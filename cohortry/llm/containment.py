"""Short texts inside long ones by MinHash and exact shingle containment (operators 5 and 10).

Both operators share the word shingles, the exact check, and a table that finds the few shingles of a document that matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.llm.tables import small_batches
from cohortry.llm.words import mix, shingle_hashes, text_runs, word_hashes, word_spans

SHINGLE = 5
SHARE = 0.8
#: Shingles of short texts that one scan carries (8 bytes each, and sketches of a fifth as many).
BLOCK_SHINGLES = 2_000_000
#: Seed of the shingle hashes by which candidates are verified; those that find them have seed 0.
CHECK_SEED = 1


class Members:
    """A set of hashes; a bit table passes over most that are not in it, a binary search decides the others."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        bits = min(23, max(18, (16 * len(self.sorted)).bit_length()))
        self.bits = np.zeros(1 << bits, bool)
        self.bits[self.sorted & np.uint64(len(self.bits) - 1)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of those hashes that are in the set."""
        near = np.flatnonzero(self.bits[hashes & np.uint64(len(self.bits) - 1)])
        if not len(near) or not len(self.sorted):
            return near[:0]
        at = np.minimum(np.searchsorted(self.sorted, hashes[near]), len(self.sorted) - 1)
        return near[self.sorted[at] == hashes[near]]


def shingles_of(texts: Sequence[str | None], n: int = SHINGLE, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes; none for a text of fewer than n words."""
    from cohortry.llm.words import shingle_sets

    return [s for _, s in shingle_sets(pa.array(list(texts), pa.string()), n, False, seed)]


# -- operator 5 -----------------------------------------------------------------------------------------------


def sketch_size(largest: int, share: float) -> int:
    """Least MinHash values that a set of at most ``largest`` shingles keeps, so that a set with ``share`` of them has one."""
    return largest - math.ceil(share * largest - 1e-9) + 1


def size_classes(sizes: np.ndarray) -> np.ndarray:
    """The largest size of each one's class; classes end at the powers of the square root of two."""
    steps = np.ceil(2 * np.log2(np.maximum(sizes, 1)) - 1e-9)
    return np.floor(2.0 ** (steps / 2) + 1e-9).astype(np.int64)


@dataclass
class Sketches:
    """Short texts with their bottom-k MinHash sketches; k is set by size class.

    A sketch holds the k least hashes of a text's shingles. A document that has at least ``share`` of a set of s shingles
    lacks s - ceil(share * s) of them at most, and k is one more for the largest size of the class, so such a document
    has one of the k: no class misses a match, and the documents need no signatures of their own.
    """

    ids: np.ndarray
    sets: list[np.ndarray]
    values: np.ndarray
    owners: np.ndarray
    members: Members

    @classmethod
    def of(cls, ids: list[int], texts: list[str], share: float) -> Sketches:
        found, checked = shingles_of(texts), shingles_of(texts, seed=CHECK_SEED)
        tops = size_classes(np.array([len(s) for s in found], np.int64))
        least = [s[: min(len(s), sketch_size(int(top), share))] for s, top in zip(found, tops, strict=True)]
        values = np.concatenate([np.zeros(0, np.uint64), *least])
        owners = np.repeat(np.arange(len(found)), [len(x) for x in least])
        order = np.argsort(values, kind="stable")
        return cls(np.array(ids, np.int64), checked, values[order], owners[order], Members(values))

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the short texts that have one of these hashes in their sketch."""
        hashes = np.unique(hashes)
        low, high = np.searchsorted(self.values, hashes, "left"), np.searchsorted(self.values, hashes, "right")
        return np.unique(np.concatenate([np.zeros(0, np.int64), *[self.owners[a:b] for a, b in zip(low, high, strict=True)]]))


def sketch_blocks(items: DataFrame, key: str, text: str, share: float, limit: int = BLOCK_SHINGLES) -> Iterator[Sketches]:
    """The short texts in blocks of about ``limit`` shingles at most.

    A word takes two bytes at least, so half the bytes of the texts bound their shingles; items are dealt
    to as many blocks by a hash, and only one block at a time is on the driver.
    """
    rows = items.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * limit)))
    for k in range(blocks):
        found = sorted((r["id"], r["text"]) for r in rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect())
        yield Sketches.of([i for i, _ in found], [t for _, t in found], share)


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs (doc_id, item_id, item_shingles, shared, containment) with at least ``share`` of the item's shingles in the document.

    Items fall into size classes, and each keeps the least MinHash values of its shingles, as many as its class needs so that no
    containing document is missed (``Sketches``): about a fifth. A document's shingles are looked up in the sketches of all classes;
    an item is a candidate when one is found, and is verified by its whole shingle set under another hash. Items travel in bounded
    blocks, with a scan of the documents for each.

    Items of fewer than five words, null texts and null item ids never match; a null doc_id is kept in the pairs;
    repeated items count once, repeated documents give a row each. Empty tables give no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, item_shingles long, shared long, containment double"
    out = None
    for short in sketch_blocks(items, item_key, item_text, share, block):
        sent = docs.sparkSession.sparkContext.broadcast(short)

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            short = sent.value
            for batch in batches:
                column, found = batch.column("text"), []
                for first, data, offsets in text_runs(column):
                    starts, ends, heads = word_spans(data, offsets)
                    grams = shingle_hashes(word_hashes(data, starts, ends), SHINGLE)
                    hits = short.members.places(grams)
                    owner = np.searchsorted(heads, hits, "right") - 1
                    # shingles that run over the end of a text are none of it
                    inside = hits + SHINGLE <= heads[owner + 1]
                    hits, owner = hits[inside], owner[inside]
                    for k in np.unique(owner):
                        of = slice(heads[k], heads[k + 1])
                        own = np.unique(shingle_hashes(word_hashes(data, starts[of], ends[of], seed=CHECK_SEED), SHINGLE))
                        for c in short.candidates(grams[hits[owner == k]]):
                            wanted = short.sets[c]
                            shared = int(np.isin(wanted, own, assume_unique=True).sum())
                            if shared >= share * len(wanted):
                                found.append((first + int(k), int(short.ids[c]), len(wanted), shared, shared / len(wanted)))
                keys = batch.column("doc_id")
                columns = list(zip(*found, strict=True)) or [[]] * 5
                arrays = [keys.take(pa.array(columns[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(columns[1:], [pa.int64(), pa.int64(), pa.int64(), pa.float64()], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "item_shingles", "shared", "containment"])

        part = small_batches(rows).mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out


# -- operator 10 ----------------------------------------------------------------------------------------------

#: Rows per band and bands of the window signatures.
BAND_ROWS, BANDS = 2, 72


class Windows:
    """Templates of one size class: overlapping windows, and MinHash bands.

    Windows are an eighth longer than the largest size of the class and start at every eighth of it, so a template lies in some
    window as a whole. The class's smallest size is its largest over the square root of two; with 0.8 of its shingles in a window the
    Jaccard similarity is 0.44 or more, and 72 bands of two rows collide with probability 1 - (1 - 0.44**2)**72, above 0.9999998.
    """

    def __init__(self, size: int, members: list[int], sets: list[np.ndarray]):
        self.step = max(1, size // 8)
        self.width = size + self.step if size > 1 else 1
        rng = np.random.default_rng(20)
        self.salts = rng.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)
        self.bands: list[dict[bytes, list[int]]] = [{} for _ in range(BANDS)]
        for m in members:
            for band, value in zip(self.bands, self.signature(sets[m]), strict=True):
                band.setdefault(value, []).append(m)

    def signature(self, shingles: np.ndarray) -> list[bytes]:
        least = mix(shingles[None, :] ^ self.salts[:, None]).min(axis=1)
        return [row.tobytes() for row in least.reshape(BANDS, BAND_ROWS)]

    def firsts(self, hits: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the places ``hits``."""
        before = np.arange(-(-self.width // self.step))
        at = np.unique((hits[:, None] // self.step - before) * self.step)
        return at[at >= 0]

    def candidates(self, shingles: np.ndarray, hits: np.ndarray) -> set[tuple[int, int]]:
        """(template, window start) for the windows over a document's shingles that hold one of ``hits``."""
        out = set()
        for start in self.firsts(hits).tolist():
            window = shingles[start : start + self.width]
            if len(window):
                for band, value in zip(self.bands, self.signature(window), strict=True):
                    for m in band.get(value, ()):
                        out.add((m, start))
        return out


def licensed(docs: DataFrame, templates: Sequence[tuple[str, str]], share: float = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, license_id, template_shingles, shared, containment, first_word, n_windows).

    One row per document and template with at least ``share`` of the template's five-word shingles in one
    window of the document; the figures are of the best window (the first, of equal ones). Templates
    of fewer than five words never match. ``templates`` (id, text) is a bounded list of the caller; several texts
    may have one id, and the best of them counts. Null text never matches, a null key is kept, repeated rows
    give a row each, and no rows or no templates give none. Windows that share no shingle with any template cannot
    collide and are not hashed. Candidates are verified under another hash than the one that found them.
    """
    sets, checked = shingles_of([t for _, t in templates]), shingles_of([t for _, t in templates], seed=CHECK_SEED)
    names = [n for n, _ in templates]
    members = Members(np.concatenate([np.zeros(0, np.uint64), *sets]))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    fields = [("license_id", T.StringType()), ("template_shingles", T.LongType()), ("shared", T.LongType()), ("containment", T.DoubleType()), ("first_word", T.LongType()), ("n_windows", T.LongType())]
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, t) for n, t in fields)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = size_classes(np.array([len(s) for s in sets], np.int64))
        classes: dict[int, list[int]] = {}
        for k, top in enumerate(tops.tolist()):
            if len(sets[k]):
                classes.setdefault(top, []).append(k)
        windows = [Windows(size, of, sets) for size, of in sorted(classes.items())]
        for batch in batches:
            found = []
            for first, data, offsets in text_runs(batch.column("text")):
                starts, ends, heads = word_spans(data, offsets)
                grams = shingle_hashes(word_hashes(data, starts, ends), SHINGLE)
                hits = members.places(grams)
                owner = np.searchsorted(heads, hits, "right") - 1
                inside = hits + SHINGLE <= heads[owner + 1]
                hits, owner = hits[inside], owner[inside]
                for k in np.unique(owner):
                    of = slice(heads[k], heads[k + 1])
                    own = grams[heads[k] : heads[k + 1] - SHINGLE + 1]
                    check = shingle_hashes(word_hashes(data, starts[of], ends[of], seed=CHECK_SEED), SHINGLE)
                    best: dict[str, tuple] = {}
                    count: dict[str, int] = {}
                    for w in windows:
                        for m, start in sorted(w.candidates(own, hits[owner == k] - heads[k])):
                            shared = int(np.isin(checked[m], check[start : start + w.width]).sum())
                            if shared >= share * len(checked[m]):
                                name = names[m]
                                count[name] = count.get(name, 0) + 1
                                rank = (shared / len(checked[m]), len(checked[m]), -start)
                                if name not in best or rank > best[name][0]:
                                    best[name] = (rank, len(checked[m]), shared, shared / len(checked[m]), start)
                    found += [(first + int(k), n, *best[n][1:], count[n]) for n in sorted(best)]
            columns = list(zip(*found, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            arrays = [batch.column("doc_id").take(pa.array(columns[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(n for n, _ in fields)])

    return small_batches(rows).mapInArrow(scan, schema)
