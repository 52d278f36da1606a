"""Sharding by minimax contiguous partition (operator 4): DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.tables import running_total
from cohortry.storage import materialize


def greedy_ends(sizes: Sequence[int], counts: Sequence[int], capacity: int) -> list[tuple[int, int]]:
    """Greedy packing of runs of equal atomic sizes: (run, atoms of it taken) at the end of every shard.

    ``capacity`` must hold the largest atom. Run k has ``counts[k]`` atoms of ``sizes[k]``.
    """
    before = [0]
    for s, c in zip(sizes, counts, strict=True):
        before.append(before[-1] + s * c)
    at, ends = 0, []
    while at < before[-1]:
        run = bisect_right(before, at + capacity) - 1
        if run == len(sizes):
            ends.append((run, 0))
            break
        taken = (at + capacity - before[run]) // sizes[run]
        at = before[run] + taken * sizes[run]
        ends.append((run, taken))
    return ends


def smallest_capacity(sizes: Sequence[int], counts: Sequence[int], shards: int) -> int:
    """Binary search for the least capacity with which greedy packing needs at most ``shards`` shards."""
    if not sizes:
        return 0
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    low = max(max(sizes), -(-total // shards))
    high = low + max(sizes)
    while low < high:
        middle = (low + high) // 2
        if len(greedy_ends(sizes, counts, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_shards(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", lanes: int = 32) -> DataFrame:
    """Assign every row to one of ``shards`` contiguous parts of the ordered atomic groups.

    A group is all rows of equal text and is never cut. Groups are ordered by (lane, bytes of the group,
    digest), the lane being a hash of the text, so every shard gets a mixture of lengths, and the order
    compresses into runs of equal sizes. The run table is all that reaches the driver. It has at most
    ``sqrt(2 * lanes * total bytes)`` rows, as run sizes inside a lane differ. The binary search over
    capacities works on it, and the cuts go back as literals.

    Returns the key, size (UTF-8 bytes plus 1; null text counts as empty), text_crc32, group_bytes,
    shard and slot (gapless from 0 in a shard, in no particular order). Null text and empty text form one
    group; a null key is kept; repeated rows are kept; no rows give no rows. A group larger than the
    even share gets a shard of its own, and later shards may then be empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(body.cast("binary"))).alias("digest"),
    )
    lane = F.pmod(F.xxhash64("digest"), F.lit(lanes)).cast("int").alias("lane")
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("group_bytes")).select("digest", "group_bytes", lane), "groups")
    runs = sorted((r["lane"], r["group_bytes"], r["n"]) for r in groups.groupBy("lane", "group_bytes").agg(F.count("*").alias("n")).toLocalIterator())
    sizes, counts = [r[1] for r in runs], [r[2] for r in runs]
    ends = greedy_ends(sizes, counts, smallest_capacity(sizes, counts, shards))

    # A cut (run, k) puts the first k groups of the run before it; only runs that are cut inside need ranks.
    cuts = [(*runs[run][:2], k) for run, k in ends if run < len(runs)]
    here = lambda c: (F.col("lane") == c[0]) & (F.col("group_bytes") == c[1])
    split = F.lit(False)
    for c in cuts:
        split = split | here(c) if c[2] else split
    inside = running_total(groups.filter(split).withColumn("one", F.lit(1)), ["lane", "group_bytes"], "one", ["digest"], "rank").drop("one")
    ranked = groups.filter(~split).withColumn("rank", F.lit(0).cast("long")).unionByName(inside)
    shard = F.lit(0)
    for c in cuts:
        later = (F.col("lane") > c[0]) | ((F.col("lane") == c[0]) & (F.col("group_bytes") > c[1])) | (here(c) & (F.col("rank") >= c[2]))
        shard = shard + F.when(later, 1).otherwise(0)
    placed = rows.join(ranked.select("digest", "group_bytes", shard.cast("int").alias("shard")), "digest").drop("digest")
    placed = placed.withColumn("one", F.lit(1))
    return running_total(placed, ["shard"], "one", ["doc_id", "text_crc32", "size"], "slot", 1024).drop("one")
