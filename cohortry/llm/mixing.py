"""Mixing sources to target weights by blocks (operator 9)."""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.tables import WORD, running_total, word_count
from cohortry.storage import materialize

BLOCK_WORDS = 1024
#: Rounds of the permutation's network.
ROUNDS = 4


def capped_targets(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size; the excess is shared again by weight."""
    capped: set[int] = set()
    total = sum(sizes)
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(most * sizes[k] for k in capped)
        weight = sum(weights[k] for k in free)
        targets = [most * sizes[k] if k in capped else left * weights[k] / weight for k in range(len(sizes))]
        above = {k for k in free if targets[k] > most * sizes[k]}
        if not above:
            return targets
        capped |= above


def draw_counts(slots: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Slot counts by shard and source: multinomial draws, given that each source's total is exact."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        size = int(left.sum()) // (shards - k)
        if k == shards - 1:
            out[k] = left
        elif size:  # a marginal at a time, with totals beyond numpy's own limit drawn by the normal form
            rest, take = int(left.sum()), size
            for s in range(len(slots)):
                good, rest = int(left[s]), rest - int(left[s])
                if rest == 0:
                    drawn = take
                elif good + rest < 10**9:
                    drawn = int(rng.hypergeometric(good, rest, take)) if good and take else 0
                else:
                    n, p = good + rest, good / (good + rest)
                    sd = math.sqrt(max(0.0, take * p * (1 - p) * (n - take) / max(1, n - 1)))
                    drawn = min(good, take, max(take - rest, round(rng.normal(take * p, sd))))
                out[k, s], take = drawn, take - drawn
        left = left - out[k]
    return out


class Permutation:
    """A keyed pseudorandom permutation of 0 to count - 1: a Feistel network on the cells of a grid hardly larger than ``count``, walked until it ends inside."""

    def __init__(self, count: int, key: int):
        self.count, self.key = count, key
        self.wide = math.isqrt(max(0, count - 1)) + 1
        self.high = -(-count // self.wide) or 1

    def _add(self, step: int, x: int) -> int:
        # what Spark's xxhash64 gives for the three numbers
        found = 42
        for value in (self.key, step, x):
            found = xxhash.xxh64_intdigest(struct.pack("<q", value), found)
        return found - (1 << 64) if found >> 63 else found

    def inverse(self, y: int) -> int:
        """The number that is sent to y."""
        while True:
            left, right = divmod(y, self.high)
            for step in reversed(range(ROUNDS)):
                if step % 2:
                    right = (right - self._add(step, left)) % self.high
                else:
                    left = (left - self._add(step, right)) % self.wide
            y = left * self.high + right
            if y < self.count:
                return y

    @staticmethod
    def column(x: Column, count: Column, key: Column, wide: Column, high: Column) -> Column:
        """Where x is sent, of the permutation whose figures the other columns hold; a walk of 64 steps ends outside for no count in practice, and would be null."""

        def once(y: Column) -> Column:
            left, right = F.floor(y / high).cast("long"), F.pmod(y, high)
            for step in range(ROUNDS):
                if step % 2:
                    right = F.pmod(right + F.pmod(F.xxhash64(key, F.lit(step).cast("long"), left), high), high)
                else:
                    left = F.pmod(left + F.pmod(F.xxhash64(key, F.lit(step).cast("long"), right), wide), wide)
            return left * high + right

        found = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.lit(-1).cast("long"), lambda y, k: F.when((y >= 0) & (y < count), y).otherwise(once(F.when(y < 0, x).otherwise(y))))
        return F.when(found < count, found)


def plan_sources(sizes: Sequence[int], targets: Sequence[float], block: int, seed: int) -> list[dict]:
    """For each source its blocks, whole passes, and the permutation and slots of every pass.

    The last pass stops when the rounded target is reached: its last slot may take part of a block only.
    """
    out = []
    for s, (size, target) in enumerate(zip(sizes, targets, strict=True)):
        blocks = -(-size // block)
        want = min(int(target + 0.5), math.floor(3 * size))
        full, rest = divmod(want, size) if size else (0, 0)
        tail = size - (blocks - 1) * block if blocks else 0
        passes = []
        for e in range(full + bool(rest)):
            p = Permutation(blocks, seed + 1000 * s + e)
            at = p.inverse(blocks - 1)
            goal = size if e < full else rest
            slots = -(-goal // block)
            if at < slots:
                slots = 1 + -(-max(0, goal - tail) // block)
            passes.append({"key": p.key, "wide": p.wide, "high": p.high, "tail_at": at, "goal": goal, "slots": min(slots, blocks)})
        out.append({"blocks": blocks, "tail": tail, "passes": passes})
    return out


def _sized(docs: DataFrame, keep: Sequence[str], key: str, source: str, text: str) -> DataFrame:
    return docs.select(
        *keep,
        F.col(key).alias("_id"),
        F.coalesce(F.col(source), F.lit("")).alias("_source"),
        F.col(source).isNull().alias("_none"),
        word_count(text).alias("_size"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text_hash"),
    )


class Mixture:
    """Plan and results of one mixture. The driver holds one row per source, and source x shard counts.

    Words of a source, in the order of a hash of (id, text), form one stream that is cut into blocks of
    ``block`` words. Every source gets as many slots as its target takes; multinomial draws deal them to
    ``shards`` output shards. Slot i of a pass over the source reads block ``permutation(i)``, and slots
    and the documents' stretches are joined by (source, block). A document is taken at most once a pass.
    Sources are ordered by code point, null last, and weigh 1, 2, 3, repeating, unless ``weights`` are given.

    Null text has size 0 and is never taken; a null id and repeated rows are kept, each row on its own; an
    empty table gives empty results. A source without words has the target 0.
    """

    def __init__(self, docs: DataFrame, weights: Sequence[float] | None = None, block: int = BLOCK_WORDS, shards: int = 16, seed: int = 1729, key: str = "doc_id", source: str = "source", text: str = "text"):
        self.docs, self.block, self.names = docs, block, (key, source, text)
        spark = docs.sparkSession
        # texts are counted once; their sizes are written as a narrow table
        self.sized = sized = materialize(_sized(docs, [], key, source, text), "sizes")
        found = sorted((r["_none"], r["_source"], r["n"]) for r in sized.groupBy("_none", "_source").agg(F.sum("_size").alias("n")).collect())
        sizes = [n for *_, n in found]
        weights = list(weights) if weights is not None else [1 + k % 3 for k in range(len(found))]
        targets = capped_targets(sizes, weights) if found else []
        plans = plan_sources(sizes, targets, block, seed)
        self.sources = spark.createDataFrame(
            [(none, name, k, n, float(t)) for k, ((none, name, n), t) in enumerate(zip(found, targets, strict=True))],
            "_none boolean, _source string, _no int, source_size long, target double",
        )
        drawn = draw_counts([sum(p["slots"] for p in plan["passes"]) for plan in plans], shards, seed) if plans else np.zeros((0, 0), int)
        self._ranges = self._slot_ranges(plans, drawn)

    @staticmethod
    def _slot_ranges(plans: list[dict], drawn: np.ndarray) -> list[tuple]:
        """(source, pass, shard, first slot, end slot, key, wide, high, blocks, tail, tail_at, goal)."""
        out = []
        for s, plan in enumerate(plans):
            ends = np.cumsum(drawn[:, s])
            first = 0
            for e, p in enumerate(plan["passes"]):
                for k, end in enumerate(ends):
                    low, high = max(first, int(end) - int(drawn[k, s])), min(first + p["slots"], int(end))
                    if low < high:
                        out.append((s, e, k, low - first, high - first, p["key"], p["wide"], p["high"], plan["blocks"], plan["tail"], p["tail_at"], p["goal"]))
                first += p["slots"]
        return out

    def slots(self) -> DataFrame:
        """One row per slot: shard, source number, pass, slot, block and the words it takes of it."""
        ranges = self.docs.sparkSession.createDataFrame(
            self._ranges, "_no int, pass int, shard int, low long, end long, key long, wide long, high long, blocks long, tail long, tail_at long, goal long"
        )
        step = 1 << 16
        pieces = ranges.withColumn("from", F.explode(F.sequence("low", F.col("end") - 1, F.lit(step)))).repartition(F.col("_no"), F.col("from"), F.col("pass"), F.col("shard"))
        rows = pieces.withColumn("slot", F.explode(F.sequence("from", F.least(F.col("from") + step, "end") - 1)))
        length = F.when(F.col("block") == F.col("blocks") - 1, F.col("tail")).otherwise(self.block)
        before = F.col("slot") * self.block - F.when(F.col("tail_at") < F.col("slot"), self.block - F.col("tail")).otherwise(0)
        return (
            rows.withColumn("block", Permutation.column(*map(F.col, ("slot", "blocks", "key", "wide", "high"))))
            .withColumn("take", F.greatest(F.lit(0), F.least(length, F.col("goal") - before)).cast("long"))
            .select("shard", "_no", "pass", "slot", "block", "take")
        )

    def placed(self, keep: Sequence[str] = ()) -> DataFrame:
        """Every document with its source's figures and ``_at``, its first word in the source's stream."""
        sized = (_sized(self.docs, keep, *self.names) if keep else self.sized).join(F.broadcast(self.sources), ["_none", "_source"])
        return running_total(sized, ["_no"], "_size", ["_id", "_text_hash"], "_at")

    def stretches(self, placed: DataFrame) -> DataFrame:
        """The stretches of documents that slots take: (_no, _at, _size, shard, pass, begin, words), begin in the document."""
        last = F.floor((F.col("_at") + F.col("_size") - 1) / self.block).cast("long")
        spread = placed.filter("_size > 0").select("_no", "_at", "_size", F.explode(F.sequence(F.floor(F.col("_at") / self.block).cast("long"), last)).alias("block"))
        low = F.greatest(F.col("_at"), F.col("block") * self.block)
        high = F.least(F.col("_at") + F.col("_size"), F.col("block") * self.block + F.col("take"))
        # slots grow with the words, though Spark takes the exploded ranges for a small table
        joined = spread.join(self.slots().hint("merge"), ["_no", "block"])
        return joined.select("_no", "_at", "_size", "shard", "pass", (low - F.col("_at")).alias("begin"), (high - low).alias("words")).filter("words > 0")

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken."""
        placed = self.placed()
        sums = self.stretches(placed).groupBy("_no", "_at").agg(F.sum("words").alias("_taken"))
        figures = [F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target"]
        some = placed.filter("_size > 0").join(sums, ["_no", "_at"], "left").select(*figures, F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))
        return some.unionByName(placed.filter("_size = 0").select(*figures, F.lit(0).cast("long").alias("taken")))

    def documents(self) -> DataFrame:
        """The mixture as documents: a row per document and pass that takes words of it, with those words.

        A document that a pass takes whole keeps its text; of one that it takes in part, the taken words
        are joined by blanks. All columns of the input are returned.
        """
        text = self.names[2]
        columns = self.docs.columns
        own = {c: f"_own{k}" for k, c in enumerate(columns)}
        docs = self.docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
        inner = Mixture.__new__(Mixture)
        inner.__dict__.update(self.__dict__)
        inner.docs, inner.names = docs, tuple(own[n] for n in self.names)
        pieces = self.stretches(self.placed()).groupBy("_no", "_at", "pass").agg(F.sum("words").alias("_words"), F.sort_array(F.collect_list(F.struct("begin", "words"))).alias("_parts"))
        rows = inner.placed(list(own.values())).filter("_size > 0").join(pieces, ["_no", "_at"])
        body = F.col(own[text])
        cut = F.array_join(F.flatten(F.transform("_parts", lambda p: F.slice(F.col("_split"), (p["begin"] + 1).cast("int"), p["words"].cast("int")))), " ")
        rows = rows.withColumn("_split", F.when(F.col("_words") < F.col("_size"), F.regexp_extract_all(body, F.lit(WORD), F.lit(0))))
        return rows.select(*[F.when(F.col("_words") < F.col("_size"), cut).otherwise(body).alias(c) if c == text else F.col(n).alias(c) for c, n in own.items()])
