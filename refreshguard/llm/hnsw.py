"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node that knows its least ids.  Nodes go to shards by a
hash; a task builds the graph of its shard and searches it for all queries, and
the best of all shards are merged.  A graph is one flat array of neighbours for
each layer (node x degree, -1 for empty places).  Nodes enter in growing
batches: a batch is searched in the graph so far, side by side with array
operations, and linked to the nearest found and to each other.

Shards have about ``SHARD`` nodes, so a task's memory has a bound and the work
grows with the rows.  Queries are read by every shard in blocks; results are at
most ``K`` per query and shard.

The measure is the inner product in double precision, of the original vectors.
Graphs are built on vectors brought to one length by an extra coordinate, for
which the nearest by angle are those with the largest product.

Defined cases: vectors that are null, empty, zero, or hold null or not finite
numbers take no part; a vector shorter than the longest counts as followed by
zeros; rows with a null ``vec_id`` take no part; repeated rows count once; with fewer candidates
all are returned; ties go to the smaller id; an empty table gives an empty
result; further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

K = 20
EVERY = 20  # queries are the rows whose id this divides
SHARD = 6000
DEGREE = 24  # links of a node; twice as many in the lowest layer
BREADTH = 64  # nodes kept in a search while building, and at least while searching
SEARCH_BREADTH = 128
BATCH = 256
STARTS = 8  # nodes handed down from layer to layer


class Graph:
    """Layers of flat neighbour arrays over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, seed: int = 11):
        norms = np.einsum("ij,ij->i", vectors, vectors)
        extra = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
        self.x = np.column_stack([vectors, extra]).astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        top = np.floor(-np.log(1 - rng.random(n)) / math.log(DEGREE)).astype(int) if n else \
            np.zeros(0, dtype=int)
        self.order = np.argsort(-top, kind="stable")  # high nodes first
        self.top = top
        self.layers = [np.full((n, DEGREE * (2 if k == 0 else 1)), -1, dtype=np.int32)
                       for k in range(int(top.max(initial=0)) + 1)]
        self.entry = int(self.order[0]) if n else -1
        at, size = 1, 1
        while at < n:
            self._insert(self.order[at:at + size])
            at, size = at + size, min(BATCH, max(1, (at + size) // 2))
        self._reach_all()

    def _reach_all(self) -> None:
        """Give every node that no path reaches (its back links were crowded out) links from its nearest."""
        while self.entry >= 0:
            links = self.layers[0]
            reached = np.zeros(len(self.x), dtype=bool)
            front = np.array([self.entry])
            while len(front):
                reached[front] = True
                near = np.unique(links[front])
                front = near[(near >= 0) & ~reached[np.maximum(near, 0)]]
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            found = np.concatenate([self.search_nodes(self.x[lost[k:k + BATCH]], BREADTH)[:, :3]
                                    for k in range(0, len(lost), BATCH)])
            source, target = np.repeat(lost, found.shape[1]), found.ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            place = np.arange(len(target)) - np.searchsorted(target, target)
            new = np.full((len(self.x), int(place.max()) + 1), -1, dtype=np.int32)
            new[target, place] = source
            self.layers[0] = np.concatenate([links, new], 1)

    def _insert(self, nodes: np.ndarray) -> None:
        start = np.full((len(nodes), 1), self.entry)
        for level in range(len(self.layers) - 1, -1, -1):
            mine = self.top[nodes] >= level
            wide = BREADTH if mine.any() else STARTS
            ids, near = self.beam(self.x[nodes], start, level, wide)
            start = ids[:, :STARTS]
            if not mine.any():
                continue
            own = nodes[mine]
            among = self.x[own] @ self.x[own].T
            np.fill_diagonal(among, -np.inf)
            both = np.concatenate([ids[mine], np.broadcast_to(own, among.shape)], 1)
            score = np.concatenate([near[mine], among], 1)
            both = np.where(np.isfinite(score), both, -1)
            self._link(own, both, score, level)

    def _link(self, own: np.ndarray, ids: np.ndarray, score: np.ndarray, level: int) -> None:
        links = self.layers[level]
        degree = links.shape[1]
        chosen = self._spread(own, ids, score, degree // 2)
        links[own, :chosen.shape[1]] = chosen
        # Back links: append where there is room, else keep the best spread of old and new.
        source = np.repeat(own, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        counts = np.diff(np.r_[first, len(target)])
        if not len(target):
            return
        width = int(counts.max())
        new = np.full((len(first), width), -1, dtype=np.int64)
        new[np.repeat(np.arange(len(first)), counts),
            np.arange(len(target)) - np.repeat(first, counts)] = source
        nodes = target[first]
        for k in range(0, len(nodes), 512):
            some = nodes[k:k + 512]
            more = new[k:k + 512]
            more[(more[:, :, None] == links[some][:, None, :]).any(2)] = -1
            every = np.concatenate([links[some], more], 1)
            dist = np.einsum("ijk,ik->ij", self.x[every], self.x[some])
            dist[every < 0] = -np.inf
            full = (every >= 0).sum(1) > degree
            packed = np.argsort(-dist, 1, kind="stable")[:, :degree]
            kept = np.take_along_axis(every, packed, 1)
            if full.any():
                kept[full] = self._spread(some[full], every[full], dist[full], degree)
            links[some] = np.where(kept >= 0, kept, -1)

    def _spread(self, own, ids, score, degree: int) -> np.ndarray:
        """Per node neighbours that are nearer to it than to a neighbour chosen before; then the nearest others."""
        order = np.argsort(-score, 1, kind="stable")[:, :max(degree * 3, degree)]
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
        first = np.zeros_like(ids, dtype=bool)
        first[:, 1:] = ids[:, 1:] == ids[:, :-1]
        valid = (ids >= 0) & np.isfinite(score) & ~first
        among = np.einsum("ijk,ilk->ijl", self.x[ids], self.x[ids])
        keep = np.zeros(ids.shape, dtype=bool)
        for j in range(ids.shape[1]):
            shaded = (keep & (among[:, j, :] > score[:, j:j + 1])).any(1)
            keep[:, j] = valid[:, j] & ~shaded & (keep.sum(1) < degree)
        rank = np.where(keep, 0, np.where(valid, 1, 2))
        pick = np.argsort(rank, 1, kind="stable")[:, :degree]
        chosen = np.take_along_axis(ids, pick, 1)
        chosen[np.take_along_axis(rank, pick, 1) == 2] = -1
        return chosen

    def beam(self, q: np.ndarray, start: np.ndarray, level: int, breadth: int):
        """(ids, scores), best first: the ``breadth`` best nodes found from the start, for all rows of q."""
        links = self.layers[level]
        rows = np.arange(len(q))
        seen = np.zeros((len(q), len(self.x)), dtype=bool)
        ids = np.full((len(q), breadth), -1, dtype=np.int64)
        score = np.full((len(q), breadth), -np.inf, dtype=np.float32)
        done = np.ones((len(q), breadth), dtype=bool)
        start = start[:, :breadth]
        real = start >= 0
        first = np.einsum("ijk,ik->ij", self.x[np.maximum(start, 0)], q)
        first[~real] = -np.inf
        order = np.argsort(-first, 1, kind="stable")
        wide = start.shape[1]
        ids[:, :wide] = np.take_along_axis(start, order, 1)
        score[:, :wide] = np.take_along_axis(first, order, 1)
        done[:, :wide] = ~np.take_along_axis(real, order, 1)
        seen[np.broadcast_to(rows[:, None], start.shape)[real], start[real]] = True
        alive = rows
        while len(alive):
            best = np.argmax(~done[alive], 1)  # scores are sorted: the first not expanded
            alive = alive[~done[alive, best]]
            if not len(alive):
                break
            best = np.argmax(~done[alive], 1)
            done[alive, best] = True
            near = links[ids[alive, best]].astype(np.int64)
            new = (near >= 0) & ~seen[alive[:, None], np.maximum(near, 0)]
            seen[np.broadcast_to(alive[:, None], near.shape)[new], near[new]] = True
            got = np.einsum("ijk,ik->ij", self.x[np.maximum(near, 0)], q[alive])
            got[~new] = -np.inf
            all_ids = np.concatenate([ids[alive], near], 1)
            all_score = np.concatenate([score[alive], got], 1)
            all_done = np.concatenate([done[alive], ~new], 1)
            order = np.argsort(-all_score, 1, kind="stable")[:, :breadth]
            ids[alive] = np.take_along_axis(all_ids, order, 1)
            score[alive] = np.take_along_axis(all_score, order, 1)
            done[alive] = np.take_along_axis(all_done, order, 1)
        return np.where(np.isfinite(score), ids, -1), score

    def search(self, queries: np.ndarray, breadth: int = SEARCH_BREADTH) -> np.ndarray:
        """Nodes found for each query, -1 for none."""
        if self.entry < 0:
            return np.zeros((len(queries), 0), dtype=np.int64)
        q = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
        return self.search_nodes(q, min(breadth, max(1, len(self.x))))

    def search_nodes(self, q: np.ndarray, breadth: int) -> np.ndarray:
        start = np.full((len(q), 1), self.entry)
        for level in range(len(self.layers) - 1, 0, -1):
            start = self.beam(q, start, level, STARTS)[0]
        return self.beam(q, start, 0, breadth)[0]


def clean(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors, as arrays of double, short ones followed by zeros."""
    v = F.col("v")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    padding = F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v"))
    return rows.select("vec_id", F.when(F.size("v") < longest, F.concat("v", padding))
                       .otherwise(F.col("v")).alias("v"))


def nodes(rows: DataFrame) -> DataFrame:
    """(v, ids, shard): distinct vectors with the ``K + 1`` least ids of each, in hash shards."""
    alike = rows.groupBy("v", "vec_id").count()
    # Of a group of copies only the least ids can be among the nearest; each task keeps its own few.
    spread = alike.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    own = Window.partitionBy("v", "part").orderBy("vec_id")
    few = spread.withColumn("r", F.row_number().over(own)).filter(F.col("r") <= K + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        "v", F.slice("ids", 1, K + 1).alias("ids"))


def search_shards(found: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """(query_id, vec_id, score): the ``K`` best of each shard for each query.

    Every shard gets its nodes and then, in lots, all queries: a task holds one
    graph and one lot.
    """
    placed = found.select(
        F.pmod(F.xxhash64("v", F.lit(3)), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "ids", "v")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"),
        F.col("vec_id").alias("query_id"), F.lit(None).cast("array<long>").alias("ids"), "v")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, vectors, ids, graph = None, [], [], None
        for batch in batches:
            for (shard, kind), part in batch.groupby(["shard", "kind"], sort=False):
                if shard != current:
                    current, vectors, ids, graph = shard, [], [], None
                if kind == 0:
                    vectors += part["v"].tolist()
                    ids += part["ids"].tolist()
                elif vectors:
                    if graph is None:
                        x = np.array(vectors, dtype=np.float64)
                        order = np.lexsort(x.T[::-1])  # the same graph in each run
                        x, ids = x[order], [np.asarray(ids[i]) for i in order]
                        graph = Graph(x)
                    for k in range(0, len(part), BATCH):
                        yield _answers(graph, x, ids, part.iloc[k:k + BATCH])

    # By its number, not by a hash of it, so that each task has one shard.
    dealt = placed.unionByName(asked).repartitionById(shards, "shard").sortWithinPartitions(
        "shard", "kind")
    return dealt.mapInPandas(answer, "query_id long, vec_id long, score double")


def _answers(graph: Graph, x: np.ndarray, ids: list, asked: pd.DataFrame) -> pd.DataFrame:
    """The ``K`` best rows of a shard for some queries; a node stands for all its ids."""
    queries = np.array(asked["v"].tolist(), dtype=np.float64)
    out: list[tuple] = []
    for row, query_id, mine in zip(queries, asked["query_id"], graph.search(queries)):
        mine = mine[mine >= 0]
        exact = np.array([float(np.dot(x[i], row)) for i in mine])
        best = [(-s, int(v), s) for i, s in zip(mine, exact) for v in ids[i] if v != query_id]
        out += [(query_id, v, s) for _, v, s in sorted(best)[:K]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``K`` nearest found of each row whose id ``every`` divides."""
    rows = stored(clean(embeddings), "vectors")
    found = stored(nodes(rows), "nodes")
    shards = max(1, -(-found.count() // SHARD))
    queries = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    best = search_shards(found, queries, shards)
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= K).select(
        "query_id", "rank", "vec_id", "score")
