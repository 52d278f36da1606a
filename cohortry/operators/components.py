"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.joins import SALTS, SHARE
from cohortry.storage import materialize

#: Edge ends that a task takes without more ado.
FLOOR = 100_000


def _both(edges: DataFrame) -> DataFrame:
    """Every edge from both of its ends."""
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hubs(edges: DataFrame) -> tuple[DataFrame | None, tuple]:
    """The nodes that over one in ``SHARE`` of all edge ends meet in, so ``SHARE`` at most (none if no node has ``FLOOR``), and a mark of the edges.

    An edge of a round leads from a node to a neighbour of its neighbours, so within the round no other node gets as many edges.
    """
    marked = edges.select("a", "b", F.xxhash64("a", "b").alias("h"))
    ends = marked.union(marked.select("b", "a", F.lit(0).cast("long")))
    degrees = ends.groupBy("a").agg(F.count("*").alias("n"), F.bit_xor("h").alias("h"))
    total, most, check = degrees.agg(F.sum("n"), F.max("n"), F.bit_xor("h")).first()
    least = max(FLOOR, (total or 0) / SHARE)
    if (most or 0) <= least:
        return None, (total, check)
    found = degrees.filter(F.col("n") > least).select("a", F.lit(True).alias("hub"))
    return edges.sparkSession.createDataFrame(found.collect(), found.schema), (total, check)


def salted(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """Add salt: edges of a hub are dealt to ``SALTS`` parts, others have part 0."""
    flagged = edges.join(F.broadcast(hubs), "a", "left")
    return flagged.withColumn("salt", F.when(F.col("hub"), F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hub")


def _with_least(edges: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """Add m: the least b of all edges of a. Minima are combined before they move; the edges of a hub meet theirs in many tasks."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    if hubs is None:
        return edges.join(low, "a")
    salts = F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    copies = low.join(F.broadcast(hubs), "a", "left").select("a", "m", salts.alias("salt"))
    return salted(edges, hubs).join(copies, ["a", "salt"]).select("a", "b", "m")


def _round(edges: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """A large star (larger neighbours move to the least node around), then a small star (smaller neighbours and the node itself move to the least one)."""
    large = _with_least(_both(edges), hubs).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    small = _with_least(large, hubs)
    moved = F.when(F.col("b") == F.col("m"), F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    # the edge of a node to its least neighbour is among its own edges, so it stays
    return small.select(moved.alias("e")).select("e.a", "e.b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of an edge; component is the smallest node reachable.

    Edges with a null end and self-loops give no row. An empty edge table gives an empty table. Every
    round ends in a table of the shared folder, so neither lineage nor lost executors add up. No task holds all edges of a node that has many.
    """
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null and x <> y")
    current = materialize(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    hubs, before = _hubs(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        current = materialize(_round(current, hubs), "stars")
        hubs, after = _hubs(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no stable components after {max_rounds} rounds")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
