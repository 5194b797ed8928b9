"""Approximate nearest neighbours by stable projections and kd-trees.

Largest inner product becomes nearest Euclidean neighbour by one more component that gives all vectors the same norm.
Gaussian (2-stable) projections to 8 dimensions turn a squared distance d^2 into d^2 times a chi-square variable. The
index holds a kd-tree over the projections of each shard. It is built once and stored: a shard's vectors in the order of
its leaves, which with their number fixes the tree. A query walks the tree best first, so leaves come by their projected
distance, and verifies each leaf's vectors by the true inner product. After each leaf it is tested whether the next is so
far that, by the chi-square law, a vector nearer than the k-th found would have come before with probability CONFIDENCE.

A shard's size is bounded by memory. A task holds one shard and lets its queries stream by; a shard is sent to more than
one task only where it has more than BLOCK_QUERIES queries, or where there would be fewer tasks than cores.

Defined cases: null ids, and vectors that are null, zero or hold null or non-finite components, take no part, neither as
queries nor as candidates; vectors of different lengths never meet; equal scores go to the smaller id; rows that repeat
an id are candidates one by one, but never of a query of the same id; of queries that repeat an id the one with the least
hash of its vector is answered; where squares of components overflow, all vectors are verified; other columns take no
part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnfield.llm._shared import stored, table
from cairnfield.llm.vectors import lists, matrix, runs, usable, whole

K = 20
DIMENSIONS = 8
CONFIDENCE = 0.98
SHARD_BYTES = 64 << 20
BLOCK_QUERIES = 250_000
LEAF = 256
SEED = 11
INDEX = "shard long, size int, place long, ids array<long>, v array<double>, p array<double>"


def chi_square_quantile(p: float, dof: int = DIMENSIONS) -> float:
    """The quantile for an even number of degrees of freedom, by bisection of the closed form."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        x = (lo + hi) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))
        lo, hi = (x, hi) if below < p else (lo, x)
    return hi


class KdTree:
    """A balanced kd-tree over points; leaves holds the row numbers of each leaf.

    A node's rows are halved along its widest side, so the tree of points that are already in the order of the leaves
    (ordered) follows from their number alone. The children of node i are left[i] and left[i] + 1; leaves have -1.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF, ordered: bool = False):
        self.order = np.arange(len(points))
        self.start, self.end, self.left = [0], [len(points)], [-1]
        node = 0
        while node < len(self.start):
            s, e = self.start[node], self.end[node]
            if e - s > leaf:
                half = (e - s) // 2
                if not ordered:
                    own = points[self.order[s:e]]
                    axis = int(np.argmax(own.max(0) - own.min(0)))
                    self.order[s:e] = self.order[s:e][np.argpartition(own[:, axis], half)]
                self.left[node] = len(self.start)
                self.start += [s, s + half]
                self.end += [s + half, e]
                self.left += [-1, -1]
            node += 1
        self.low, self.high = np.zeros((node, points.shape[1])), np.zeros((node, points.shape[1]))
        for i in range(node - 1, -1, -1):  # children come after their parents
            c = self.left[i]
            if c < 0:
                own = points[self.order[self.start[i] : self.end[i]]]
                self.low[i], self.high[i] = own.min(0), own.max(0)
            else:
                self.low[i], self.high[i] = self.low[c : c + 2].min(0), self.high[c : c + 2].max(0)
        self.leaf_nodes = [i for i in range(node) if self.left[i] < 0]
        self.leaves = [self.order[self.start[i] : self.end[i]] for i in self.leaf_nodes]

    def box_distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the leaves' boxes."""
        return np.stack([self.gaps(q, self.leaf_nodes) for q in queries])

    def gaps(self, q: np.ndarray, nodes: slice | list) -> np.ndarray:
        """Squared distances of a query to the boxes of nodes."""
        d = np.maximum(np.maximum(self.low[nodes] - q, q - self.high[nodes]), 0)
        return np.einsum("nd,nd->n", d, d)

    def walk(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(squared distance of the box, first and last place in `order`) of the leaves, nearest first."""
        ahead = [(0.0, 0)]
        while ahead:
            gap, node = heapq.heappop(ahead)
            c = self.left[node]
            if c < 0:
                yield gap, self.start[node], self.end[node]
            else:
                near, far = self.gaps(q, slice(c, c + 2)).tolist()
                heapq.heappush(ahead, (near, c))
                heapq.heappush(ahead, (far, c + 1))


def projected(vectors: np.ndarray, norm2: float) -> np.ndarray:
    """Projections of vectors with the component that makes all norms equal; norm2 is None for queries, which lack it."""
    direction = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, DIMENSIONS))
    out = vectors @ direction[:-1]
    if norm2 is not None:
        out += np.sqrt(np.maximum(norm2 - (vectors**2).sum(1), 0))[:, None] * direction[-1]
    return out


class Shard:
    """A stored shard: distinct vectors in the order of the tree's leaves, with the rising ids of each.

    ids holds those of all vectors one after the other, ends where each vector's end. A vector is alone where all its ids
    are one.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, vectors: np.ndarray, points: np.ndarray, norm2: float):
        self.ids, self.ends, self.vectors, self.norm2 = ids, np.cumsum(counts), vectors, norm2
        self.firsts = self.ends - counts
        self.alone = ids[self.firsts] == ids[self.ends - 1]
        self.tree = KdTree(points, ordered=True)

    def others(self, row: int, query_id: int, k: int) -> list[int]:
        """The k least ids of a vector, with repeats, but for the query's own."""
        own = self.ids[self.firsts[row] : self.ends[row]]
        low, high = np.searchsorted(own, query_id), np.searchsorted(own, query_id, side="right")
        return np.concatenate([own[: min(low, k)], own[high : high + k]])[:k].tolist()

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float) -> Iterator[tuple[int, int, float]]:
        """(query_id, vec_id, score) of the k nearest found for each query, whose own id's rows are left out from the start."""
        limit = chi_square_quantile(confidence)
        exact = not math.isfinite(self.norm2)
        points = np.zeros((len(queries), DIMENSIONS)) if exact else projected(queries, None)
        for query_id, q, point in zip(query_ids.tolist(), queries, points, strict=True):
            own = self.alone & (self.ids[self.firsts] == query_id)
            best, rows, scores = np.full(k, -np.inf), [], []
            least, q2 = -np.inf, float(q @ q)
            for gap, start, end in self.tree.walk(point):
                if not exact and gap >= limit * max(q2 + self.norm2 - 2 * least, 1e-12):
                    break
                found = self.vectors[start:end] @ q
                near = found >= least - 1e-9 * (1 + abs(least)) if math.isfinite(least) else found == found
                hit = np.flatnonzero(near & ~own[start:end])
                if len(hit):
                    rows.append(start + hit)
                    scores.append(found[hit])
                    best = -np.partition(-np.concatenate([best, found[hit]]), k - 1)[:k]
                    least = float(best.min())
            if not rows:
                continue
            rows, scores = np.concatenate(rows), np.concatenate(scores)
            if math.isfinite(least):
                rows = rows[scores >= least - 1e-9 * (1 + abs(least))]
            # matrix products may round by position; these sums don't
            sums = (self.vectors[rows] * q).sum(1).tolist()
            for s, o in sorted((-s, o) for s, r in zip(sums, rows.tolist(), strict=True) for o in self.others(r, query_id, k))[:k]:
                yield query_id, o, -s


def index(held: DataFrame, shards: int, norm2: float) -> DataFrame:
    """The stored index of held (vec_id, v, size): one row for each distinct vector of a shard, as INDEX says."""

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def one(key: tuple, parts: list) -> pa.RecordBatch:
            batch = whole(parts)
            ids, v = batch.column(2).to_numpy(), np.ascontiguousarray(matrix(batch.column(3)))
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            _, first, inverse = np.unique(v.view(np.dtype((np.void, v.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
            owner = np.argsort(inverse, kind="stable")
            owners = np.split(ids[owner], np.cumsum(np.bincount(inverse))[:-1])
            v = v[first]
            points = projected(v, norm2) if math.isfinite(norm2) else np.zeros((len(v), DIMENSIONS))
            at = KdTree(points).order
            n = len(at)
            columns = [pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.int32()), pa.array(range(n), pa.int64())]
            columns += [pa.array([owners[i] for i in at], pa.list_(pa.int64())), lists(v[at]), lists(points[at])]
            return pa.record_batch(columns, names=[c.split()[0] for c in INDEX.split(", ")])

        group, parts = None, []
        for key, part in runs(batches, 2):
            if key != group and parts:
                yield one(group, parts)
                parts = []
            group = key
            parts.append(part)
        if parts:
            yield one(group, parts)

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    dealt = held.select(shard, "size", "vec_id", "v").repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "size")
    return stored(dealt.mapInArrow(build, INDEX), "projection-index")


def nearest(vectors: DataFrame, queries: Column, k: int = K, confidence: float = CONFIDENCE, shard_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of vectors (vec_id, embedding) where queries holds.

    shard_rows: vectors of a shard, as many as SHARD_BYTES hold if not given.
    """
    held = stored(usable(vectors).withColumn("size", F.size("v")), "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = held.agg(F.count("*").alias("n"), F.max("size").alias("size"), F.max(squares).alias("norm2"), F.count_if(queries).alias("q")).first()
    norm2 = facts.norm2 or 0.0
    shards = max(1, -(-facts.n // (shard_rows or max(1, SHARD_BYTES // (8 * (facts.size or 1))))))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-facts.q // BLOCK_QUERIES), -(-cores // shards))
    each = lambda n, name: F.explode(F.expr(f"sequence(0L, {n - 1}L)")).alias(name)
    none = F.lit(None).cast("array<double>").alias("p")
    base = index(held, shards, norm2).select("shard", "size", each(blocks, "block"), F.lit(0).alias("asks"), "place", "ids", "v", "p")
    asking = held.where(queries).groupBy("vec_id").agg(F.min(F.struct(F.xxhash64("v"), "v", "size")).alias("q"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block")
    asks = asking.select(each(shards, "shard"), "q.size", block, F.lit(1).alias("asks"), F.lit(0).cast("long").alias("place"), F.array("vec_id").alias("ids"), "q.v", none)
    # numbered tasks: a hash would put several shards into one
    dealt = base.unionByName(asks).repartitionById(shards * blocks, (F.col("shard") * blocks + F.col("block")).cast("int")).sortWithinPartitions("shard", "size", "block", "asks", "place")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, parts, shard = None, [], None
        for (*key, asks), part in runs(batches, 4):
            if key != group:
                group, parts, shard = key, [], None
            if not asks:
                parts.append(part)
                continue
            if shard is None and parts:
                batch = whole(parts)
                shard = Shard(batch.column(5).flatten().to_numpy(), batch.column(5).value_lengths().to_numpy(), np.ascontiguousarray(matrix(batch.column(6))), matrix(batch.column(7)), norm2)
                parts = []
            if shard is None:  # no vector of this length is in the shard
                continue
            ids, q = part.column(5).flatten().to_numpy(), matrix(part.column(6))
            for at in range(0, len(ids), 1000):
                found = list(shard.search(ids[at : at + 1000], q[at : at + 1000], k, confidence))
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.record_batch([pa.array([r[c] for r in found], kind) for c, kind in enumerate(kinds)], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
