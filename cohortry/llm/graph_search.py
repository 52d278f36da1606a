"""Approximate nearest neighbours by robust-pruned directed graphs (operator 6)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.storage import materialize

#: Vectors a shard, links a vector, beam while building and searching, and the relaxation of distances when pruning.
SHARD_ROWS = 5000
LINKS = 24
BUILD_BEAM = 40
SEARCH_BEAM = 96
ALPHA = 1.2
#: Vectors of one graph differ in length by this factor at most, so that float32 tells the shortest of them apart.
LENGTH_RATIO = 8
#: Queries that one task searches at a time in a shard.
QUERY_ROWS = 20_000


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, without overflow of their squares."""
    most = np.abs(x).max(axis=1, initial=0.0, keepdims=True)
    most[most == 0] = 1
    return most[:, 0] * np.sqrt(((x / most) ** 2).sum(axis=1))


def levels(x: np.ndarray) -> np.ndarray:
    """A number for each vector: from the longest on, those within ``LENGTH_RATIO`` of a level's longest."""
    size = lengths(x)
    order = np.argsort(-size, kind="stable")
    out, level, top = np.zeros(len(x), np.int32), -1, np.inf
    for k in order:
        if level < 0 or size[k] * LENGTH_RATIO < top:
            level, top = level + 1, size[k]
        out[k] = level
    return out


class Graph:
    """A directed graph over different vectors of one level of a shard; distances are squared Euclidean.

    Vectors are scaled to a greatest length of 1 and get one more component, so that all have length 1 and the nearest
    by distance are those of the largest inner product with a query (whose extra component is 0).
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7):
        self._place(vectors)
        x = self.x
        self.links, n = links, len(x)
        self.out = np.full((n, links), -1, np.int32)
        rng = np.random.default_rng(seed)
        if n <= links + 1:
            for i in range(n):
                others = np.delete(np.arange(n), i)
                self.out[i, : len(others)] = others
            return
        self.out[:] = rng.integers(0, n, (n, links))
        for relax in (1.0, alpha):
            order = rng.permutation(n)
            step = 64
            while len(order):
                part, order = order[:step], order[step:]
                self._insert(part, beam, relax)
                step = min(256, 2 * step)

    @classmethod
    def of_links(cls, vectors: np.ndarray, out: np.ndarray) -> Graph:
        """A graph that was built before."""
        made = cls.__new__(cls)
        made._place(vectors)
        made.out = out
        return made

    def _place(self, vectors: np.ndarray) -> None:
        size = lengths(vectors)
        top = size.max(initial=0.0) or 1.0
        self.x = np.column_stack([vectors / top, np.sqrt(np.maximum(0.0, 1 - (size / top) ** 2))]).astype(np.float32)
        self.start = int(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1).argmin()) if len(vectors) else 0

    def distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Half the squared distances from each query to its own row of ids, less the squares, which are the same for all ids."""
        return -np.einsum("qd,qkd->qk", q, self.x[ids])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedy beam search of all queries at once: (ids, distances) of the beam by growing distance; -1 fills up."""
        m = len(q)
        ids = np.full((m, beam), -1, np.int32)
        far = np.full((m, beam), np.inf, np.float32)
        done = np.ones((m, beam), bool)
        ids[:, 0], done[:, 0] = self.start, False
        far[:, 0] = self.distances(q, ids[:, :1])[:, 0]
        live = np.arange(m)
        while len(live):
            pick = (~done[live]).argmax(axis=1)
            done[live, pick] = True
            near = self.out[ids[live, pick]]
            known = (near[:, :, None] == ids[live][:, None, :]).any(axis=2) | (near < 0)
            d = np.where(known, np.inf, self.distances(q[live], near)).astype(np.float32)
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_far = np.concatenate([far[live], d], axis=1)
            all_done = np.concatenate([done[live], known], axis=1)
            # a neighbour may stand twice in one list of links: all but its first place are dropped
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[live], far[live], done[live] = (np.take_along_axis(v, order, axis=1) for v in (all_ids, all_far, all_done))
            done[live] |= ~np.isfinite(far[live])
            live = live[~done[live].all(axis=1)]
        return ids, far

    def _prune(self, p: int, candidates: np.ndarray, relax: float) -> np.ndarray:
        """Keep the nearest candidate, drop those nearer to it (distance relaxed) than to ``p``, and so on."""
        candidates = np.unique(candidates[(candidates >= 0) & (candidates != p)])
        v = self.x[candidates].astype(np.float64)
        d = ((v - self.x[p]) ** 2).sum(axis=1)
        square = (v * v).sum(axis=1)
        between = np.maximum(0, square[:, None] + square[None, :] - 2 * v @ v.T)
        order = np.argsort(d, kind="stable")
        open_, kept = np.ones(len(order), bool), []
        for k in order:
            if open_[k]:
                kept.append(k)
                if len(kept) == self.links:
                    break
                open_ &= relax * relax * between[k] > d
        return candidates[kept]

    def _insert(self, part: np.ndarray, beam: int, relax: float) -> None:
        found, _ = self.search(self.x[part], beam)
        back: dict[int, list[int]] = {}
        for p, near in zip(part.tolist(), found, strict=True):
            kept = self._prune(p, np.concatenate([near, self.out[p]]), relax)
            self.out[p] = -1
            self.out[p, : len(kept)] = kept
            for k in kept.tolist():
                back.setdefault(k, []).append(p)
        for k, new in back.items():
            own = self.out[k][self.out[k] >= 0]
            both = np.unique(np.concatenate([own, new]))
            kept = both if len(both) <= self.links else self._prune(k, both, relax)
            self.out[k] = -1
            self.out[k, : len(kept)] = kept


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows whose vector is there, not zero, and finite in every component, as doubles."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))


def build_index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per vector: shard, level, place, vec_id, v, links (places in the level).

    Vectors are dealt to shards of about ``shard_rows`` by a hash of their id. A shard is a graph for each level of
    lengths, and equal vectors of a shard are one node, with one place and the same links. Vectors
    that are null, zero, or hold null or non-finite components take no part, nor do null ids. Vectors of different
    dimensions have no inner product: each dimension has graphs of its own, and a query finds vectors of its dimension only.
    Rows of equal id stand as candidates each. The table is written to the shared folder.
    """
    usable = _usable(vectors, key, vector)
    shards = max(1, -(-usable.count() // shard_rows))
    # more tasks than shards, so that few share one; the number stands, adaptive execution merges none of them
    tasks = max(4 * shards, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def graph(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        flat = np.array(table["v"].combine_chunks().values if table["v"].num_chunks else [])
        x = flat.reshape(table.num_rows, -1)
        level = levels(x)
        place, links = np.zeros(len(x), np.int32), np.full((len(x), LINKS), -1, np.int32)
        for at in np.unique(level):
            here = np.flatnonzero(level == at)
            _, first, node = np.unique(x[here], axis=0, return_index=True, return_inverse=True)
            # nodes stand in order of their first row
            order = np.argsort(first)
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            place[here] = rank[node.reshape(-1)]
            links[here] = Graph(x[here[first[order]]]).out[place[here]]
        for name, column in (("level", pa.array(level, pa.int32())), ("place", pa.array(place, pa.int32())), ("links", pa.array(list(links), pa.list_(pa.int32())))):
            table = table.append_column(name, column)
        return table.select(["shard", "dim", "level", "place", "vec_id", "v", "links"])

    dealt = usable.withColumns({"shard": F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"), "dim": F.size("v")}).repartition(tasks, "shard", "dim")
    return materialize(dealt.groupBy("shard", "dim").applyInArrow(graph, "shard int, dim int, level int, place int, vec_id long, v array<double>, links array<int>"), "graph")


def search(index: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", beam: int = SEARCH_BEAM) -> DataFrame:
    """The ``k`` nearest found for every query: query_id, rank, vec_id, score, nearest first, ties to the smaller id.

    Every graph of every shard is searched for every query, in blocks of queries; the best of all shards are ranked by the
    inner product in double precision. A row whose id is the query's own is no candidate. With fewer than ``k``
    candidates all of them are returned, as graphs of up to ``beam`` nodes are searched whole. Unusable queries give no rows.
    """
    asked = _usable(queries, key, vector)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    shards = index.select("shard").distinct()
    nodes = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = _spread(asked, shards, blocks)
    tasks = max(4 * blocks * shards.count(), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    nodes, spread = (x.repartition(tasks, "shard", "dim", "block") for x in (nodes, spread))

    def beam_search(graph: pa.Table, query: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not graph.num_rows or not query.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        graph = graph.sort_by([("level", "ascending"), ("place", "ascending"), ("vec_id", "ascending")])
        ids, level, place = (np.array(graph[c]) for c in ("vec_id", "level", "place"))
        x = np.array(graph["v"].combine_chunks().values).reshape(len(ids), -1)
        links = np.array(graph["links"].combine_chunks().values).reshape(len(ids), -1)
        q = np.array(query["v"].combine_chunks().values).reshape(query.num_rows, -1)
        own = np.array(query["vec_id"])
        by_id = np.sort(ids)
        mine = np.searchsorted(by_id, own, "right") - np.searchsorted(by_id, own, "left")
        # a node is its first row; its rows, by growing id, reach to the next node's
        nodes = np.flatnonzero(np.concatenate([[True], (level[1:] != level[:-1]) | (place[1:] != place[:-1])]))
        ends = np.append(nodes[1:], len(ids))
        made = []
        for at in np.unique(level):
            here = np.flatnonzero(level[nodes] == at)
            made.append((here, Graph.of_links(x[nodes[here]], links[nodes[here]]) if len(here) > beam else None))
        out = []
        for a in range(0, len(q), 256):
            part = q[a : a + 256]
            unit = np.column_stack([part / lengths(part)[:, None], np.zeros(len(part))]).astype(np.float32)
            columns = []
            for here, built in made:
                if built is None:
                    columns.append(np.tile(here, (len(part), 1)))
                else:
                    at, _ = built.search(unit, beam)
                    columns.append(np.where(at >= 0, here[at], -1))
            found = np.concatenate(columns, axis=1)
            score = np.where(found >= 0, np.einsum("qd,qkd->qk", part, x[nodes[found]]), -np.inf)
            for row in range(len(part)):
                # the query's own rows are no candidates, so as many more are looked at
                wanted = k + int(mine[a + row])
                best = np.lexsort((ids[nodes[found[row]]], -score[row]))[:wanted]
                best = best[np.isfinite(score[row][best])]
                rows = [np.arange(nodes[n], min(ends[n], nodes[n] + wanted)) for n in found[row][best]]
                of = np.repeat(score[row][best], [len(r) for r in rows])
                rows = np.concatenate([np.zeros(0, np.int64), *rows])
                other = ids[rows] != own[a + row]
                rows, of = rows[other], of[other]
                first = np.lexsort((ids[rows], -of))[:k]
                out.append((np.full(len(first), own[a + row]), ids[rows[first]], of[first]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    found = nodes.groupBy("shard", "dim", "block").cogroup(spread.groupBy("shard", "dim", "block")).applyInArrow(beam_search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _spread(asked: DataFrame, shards: DataFrame, blocks: int) -> DataFrame:
    """A row per query and shard; the shard numbers are a range, so a count of them is enough."""
    top = shards.agg(F.max("shard")).first()[0]
    return asked.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(top if top is not None else 0))).alias("shard"))
