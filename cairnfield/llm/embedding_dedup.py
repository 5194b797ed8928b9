"""Near-duplicate embeddings: a navigable small-world graph per shard, every shard queried, components of the links.

Equal vectors are one class, whose smallest id stands for it. Classes are dealt to a number of shards that grows only
when a shard would pass SHARD_ROWS. Each shard's graph is built once, layer by layer from the sparsest, and stored. Then
every class is looked up in every shard by a beam search from the top layer down: a task holds one shard's graph and lets
the classes stream by, BLOCK_ROWS of them at most, fewer where there would be fewer tasks than cores. The beam that searches start with is doubled until audits find RECALL
of the links that brute force finds in the shard, a vector's link with itself left out: those of sampled classes of the
shard, those of as many vectors made at the bounding cosine from these classes (each has a link, however rare links are),
and those of sampled classes among those that ask, which are of all shards. Where the widest beam fails, the shard is
compared exactly; each shard's beam and its recall in the audit are stored with the graph. A single search whose beam holds nothing but links is widened until it does not, or until comparing it
with all nodes costs less, so groups of any size are found. Candidates are verified by cosine in double precision, of vectors scaled by powers of two so that no square
overflows. A task gives the number of links of each class and a spanning forest of the links it saw, not all pairs.

Defined cases: vectors that are null, zero or hold null or non-finite components link with nothing and keep themselves;
so do vectors of different lengths with one another; rows that repeat an id link with each other where their vectors do
and share a component; a null id takes no part, has a null component_id and is not kept; other columns (labels too) take
no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import stored, table
from cairnfield.llm.components import components
from cairnfield.llm.vectors import matrix, runs, takes_part, usable, whole

COSINE = 0.95
SHARDS = 6
SHARD_ROWS = 250_000
BLOCK_ROWS = 250_000
DEGREE = 16
BUILD_BEAM = 64
FIRST_BEAM = 16
AUDIT_ROWS = 256
RECALL = 0.998
WIDEST_BEAM = 4096
#: In place of a beam: compare with all nodes.
EXACT = 0
SHARD_BYTES = 128 << 20
#: Nodes that the exact comparison takes in the time of one node of a beam, as its product reads them in order.
IN_ORDER = 16
#: Marks of nodes met that searches run side by side hold.
MARKS = 1 << 25
#: Likely links that are verified at once.
PAIRS = 1 << 16


def diverse(ids: np.ndarray, sims: np.ndarray, x: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (ids by falling sims, -1 for none), those nearer to the row than to any one chosen before."""
    n, c = ids.shape
    out, count = np.full((n, most), -1, np.int32), np.zeros(n, np.int64)
    v = x[np.maximum(ids, 0)]
    among = v @ v.transpose(0, 2, 1)
    chosen = np.zeros((n, c), bool)
    for j in range(c):
        near = np.where(chosen, among[:, :, j], -2.0).max(1)
        ok = (ids[:, j] >= 0) & (count < most) & (near < sims[:, j])
        chosen[:, j] = ok
        out[ok, count[ok]] = ids[ok, j]
        count[ok] += 1
    # free places go to the nearest that were passed over
    for j in range(c):
        ok = (ids[:, j] >= 0) & ~chosen[:, j] & (count < most)
        out[ok, count[ok]] = ids[ok, j]
        count[ok] += 1
    return out


class Visited:
    """Marks of nodes met by searches, in one buffer that is kept: a search has its own number, so nothing is cleared."""

    def __init__(self) -> None:
        self.marks, self.stamps, self.number = np.zeros(0, np.int32), np.zeros(0, np.int16), 0

    def take(self, n: int, size: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(marks, stamps, the search's number) for n searches among `size` nodes; stamps hold anything."""
        if n * size > len(self.marks):
            self.marks, self.stamps, self.number = np.zeros(n * size, np.int32), np.empty(n * size, np.int16), 0
        self.number += 1
        return self.marks[: n * size].reshape(n, size), self.stamps[: n * size].reshape(n, size), self.number


VISITED = Visited()


class Layer:
    """One layer: links[i] are the neighbours of node i (places in the layer's vectors), -1 for none."""

    def __init__(self, x: np.ndarray, links: np.ndarray | None = None):
        self.x = x
        self.links = np.full((len(x), 2 * DEGREE), -1, np.int32) if links is None else links

    def beam(self, q: np.ndarray, entry: np.ndarray, width: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(places, similarities) of the best `width` nodes found for each row of q, best first; entry: starting places."""
        step = max(8, MARKS // max(1, len(self.x)))
        if len(q) > step:
            parts = [self.beam(q[at : at + step], entry[at : at + step], width, expand) for at in range(0, len(q), step)]
            return np.concatenate([ids for ids, _ in parts]), np.concatenate([sims for _, sims in parts])
        n, w = len(q), max(width, entry.shape[1])
        ids, sims, done = np.full((n, w), -1, np.int32), np.full((n, w), -np.inf, np.float32), np.zeros((n, w), bool)
        e = entry.shape[1]
        ids[:, :e] = entry
        sims[:, :e] = np.einsum("nd,ned->ne", q, self.x[np.maximum(entry, 0)])
        sims[:, :e][entry < 0] = -np.inf
        seen, stamp, own = VISITED.take(n, len(self.x))
        np.put_along_axis(seen, np.maximum(entry, 0), own, 1)
        rows = np.arange(n)
        while len(rows):
            open_sims = np.where(done[rows] | (ids[rows] < 0), -np.inf, sims[rows])
            pick = np.argpartition(-open_sims, min(expand, w - 1), axis=1)[:, :expand]
            good = np.take_along_axis(open_sims, pick, 1) > -np.inf
            live = good.any(1)
            rows, pick, good = rows[live], pick[live], good[live]
            if not len(rows):
                break
            done[rows[:, None], pick] |= good
            nodes = np.where(good, ids[rows[:, None], pick], -1)
            near = np.where(nodes[:, :, None] >= 0, self.links[np.maximum(nodes, 0)], -1).reshape(len(rows), -1)
            place = np.maximum(near, 0)
            at = np.broadcast_to(np.arange(near.shape[1], dtype=np.int16), near.shape)
            stamp[rows[:, None], place] = at
            fresh = (near >= 0) & (seen[rows[:, None], place] != own) & (stamp[rows[:, None], place] == at)
            r, c = np.nonzero(fresh)
            seen[rows[r], near[r, c]] = own
            got = np.full(near.shape, -np.inf, np.float32)
            got[r, c] = np.einsum("nd,nd->n", q[rows[r]], self.x[near[r, c]])
            all_sims = np.concatenate([sims[rows], got], 1)
            all_ids = np.concatenate([ids[rows], np.where(fresh, near, -1)], 1)
            all_done = np.concatenate([done[rows], np.zeros(near.shape, bool)], 1)
            keep = np.argpartition(-all_sims, w - 1, axis=1)[:, :w]
            sims[rows] = np.take_along_axis(all_sims, keep, 1)
            ids[rows] = np.take_along_axis(all_ids, keep, 1)
            done[rows] = np.take_along_axis(all_done, keep, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1)[:, :width], np.take_along_axis(sims, order, 1)[:, :width]

    def insert(self, start: int, end: int, entry: np.ndarray) -> None:
        """Links nodes start..end-1 with those before them and with each other."""
        q = self.x[start:end]
        part = Layer(self.x[:start], self.links[:start])
        ids, sims = part.beam(q, entry, min(BUILD_BEAM, start))
        own = q @ q.T
        np.fill_diagonal(own, -np.inf)
        c = min(DEGREE, len(q) - 1)
        if c > 0:
            best = np.argpartition(-own, c - 1, axis=1)[:, :c]
            ids = np.concatenate([ids, best + start], 1).astype(np.int32)
            sims = np.concatenate([sims, np.take_along_axis(own, best, 1)], 1)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        chosen = diverse(ids, sims, self.x, DEGREE)
        self.links[start:end, :DEGREE] = chosen
        self.back(np.repeat(np.arange(start, end, dtype=np.int32), DEGREE), chosen.reshape(-1))

    def back(self, source: np.ndarray, target: np.ndarray) -> None:
        """Adds the links target -> source; full lists are chosen anew."""
        held = target >= 0
        source, target = source[held], target[held]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(nodes), 512):
            part, f, k = nodes[at : at + 512], first[at : at + 512], count[at : at + 512]
            more = np.full((len(part), int(k.max())), -1, np.int32)
            r = np.repeat(np.arange(len(part)), k)
            c = np.arange(len(r)) - np.repeat(np.cumsum(k) - k, k)
            more[r, c] = source[np.repeat(f, k) + c]
            ids = np.concatenate([self.links[part], more], 1)
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("nd,ncd->nc", self.x[part], self.x[np.maximum(ids, 0)]), -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            size = 2 * DEGREE
            full = (ids >= 0).sum(1) > size
            self.links[part[~full]] = ids[~full][:, :size]
            if full.any():
                self.links[part[full]] = diverse(ids[full][:, : 4 * size], sims[full][:, : 4 * size], self.x, size)


class SmallWorld:
    """Layers over nodes in one order: layer l holds the first sizes[l] of them, the last layer all."""

    def __init__(self, x: np.ndarray, layers: list[Layer]):
        self.x, self.layers = x, layers
        self.recall: float | None = None  # of the last audit that passed

    @classmethod
    def build(cls, x: np.ndarray) -> SmallWorld:
        sizes = [len(x)]
        while sizes[-1] > 4 * DEGREE:
            sizes.append(-(-sizes[-1] // DEGREE))
        out = cls(x, [])
        for size in reversed(sizes):
            layer = Layer(x[:size])
            at = min(size, 2 * DEGREE)
            own = x[:at] @ x[:at].T
            np.fill_diagonal(own, -np.inf)
            order = np.argsort(-own, axis=1)[:, : at - 1].astype(np.int32)
            layer.links[:at, : at - 1] = order[:, : 2 * DEGREE]
            while at < size:
                end = min(size, at + min(512, max(32, at // 2)))
                entry = out.enter(x[at:end])
                layer.insert(at, end, np.where(entry < at, entry, 0))
                at = end
            out.layers.append(layer)
        return out

    def enter(self, q: np.ndarray) -> np.ndarray:
        """Entry places for the layer below those there are."""
        if not self.layers:
            return np.zeros((len(q), 1), np.int32)
        top = self.layers[0]
        entry = np.argsort(-(q @ top.x.T), axis=1)[:, :4].astype(np.int32)
        for layer in self.layers[1:]:
            entry = layer.beam(q, entry, 4, 1)[0]
        return entry

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        low = self.layers[-1]
        entry = SmallWorld(self.x, self.layers[:-1]).enter(q) if len(self.layers) > 1 else np.zeros((len(q), 1), np.int32)
        return low.beam(q, entry, min(width, len(self.x)))

    def within(self, q: np.ndarray, cosine: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of q, places) of likely links, in parts; beams that hold nothing else are widened."""
        if width == EXACT:
            yield from self.compared(q, cosine)
            return
        step = max(8, min(512, MARKS // max(1, len(self.x))))
        for at in range(0, len(q), step):
            rows, w = np.arange(at, min(len(q), at + step)), width
            while len(rows):
                if w > width and self.exact_is_cheaper(IN_ORDER * w):
                    for r, c in self.compared(q[rows], cosine):
                        yield rows[r], c
                    break
                ids, sims = self.search(q[rows], w)
                full = (sims[:, -1] >= cosine) & (ids.shape[1] < len(self.x)) if ids.shape[1] else np.zeros(len(rows), bool)
                r, c = np.nonzero((sims >= cosine) & ~full[:, None])
                yield rows[r], ids[r, c]
                rows, w = rows[full], 2 * w

    def exact_is_cheaper(self, width: int) -> bool:
        """Whether a widened beam would meet as many links as there are nodes."""
        return 2 * DEGREE * width >= len(self.x)

    def compared(self, q: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """within() by brute force."""
        step = max(8, min(512, (1 << 23) // max(1, len(self.x))))
        for at in range(0, len(q), step):
            r, c = np.nonzero(q[at : at + step] @ self.x.T >= cosine)
            yield r + at, c

    def audited_width(self, cosine: float, asks: tuple[np.ndarray, np.ndarray] | None = None, width: int = FIRST_BEAM) -> int:
        """The first beam from width on that finds RECALL of the links of sampled vectors, or EXACT if none does.

        asks: vectors and their own places, -1 for none; else nodes, and vectors made at the cosine from them.
        """
        if width == EXACT:
            return EXACT
        if asks is None:
            own = spaced(len(self.x))
            sets = [(self.x[own], own), (at_cosine(self.x[own], cosine), np.full(len(own), -1))]
        else:
            at = spaced(len(asks[0]))
            sets = [(asks[0][at], asks[1][at])]
        truth = [linked(self.compared(q, cosine), own) for q, own in sets]
        while width <= WIDEST_BEAM:
            found = [linked(self.within(q, cosine, width), own) for q, own in sets]
            if all(f >= RECALL * n for f, n in zip(found, truth, strict=True)):
                self.recall = min([f / n for f, n in zip(found, truth, strict=True) if n], default=1.0)
                return width
            if width >= len(self.x):
                break
            width *= 2
        self.recall = 1.0
        return EXACT


def spaced(n: int) -> np.ndarray:
    """AUDIT_ROWS to twice as many places below n, or all."""
    return np.arange(0, n, max(1, n // AUDIT_ROWS))


def at_cosine(x: np.ndarray, cosine: float) -> np.ndarray:
    """A vector for each row of x, in a random direction from it, whose cosine with it is just over the given one."""
    u = np.random.default_rng(11).standard_normal(x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.maximum(np.sqrt((u**2).sum(1, keepdims=True)), 1e-12)
    c = min(1.0, cosine + 1e-4)
    return (c * x + math.sqrt(max(0.0, 1 - c * c)) * u).astype(np.float32)


def linked(parts: Iterator[tuple[np.ndarray, np.ndarray]], own: np.ndarray) -> int:
    """The number of links but for those of vectors with themselves."""
    return sum(int((c != own[r]).sum()) for r, c in parts)


def forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (u, v), as links to the least of each tree."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return list(zip(nodes[moved].tolist(), nodes[root[moved]].tolist(), strict=True))


def scaled(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(v with each row times a power of two that brings its largest component near 1, the norms of the rows)."""
    v = np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])
    return v, np.sqrt((v**2).sum(1))


GRAPH = "shard long, size int, node int, vec_id long, copies long, v array<double>, layers binary, width int, recall double"


def graphs(classes: DataFrame, shards: int, cosine: float) -> DataFrame:
    """The stored graphs of all shards: one row a node, as GRAPH says.

    layers: the node's neighbours, 2 * DEGREE places for each layer it is in, as 32-bit integers, the lowest layer first.
    """

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def one(parts: list) -> pa.RecordBatch:
            batch = whole(parts)
            v, norm = scaled(matrix(batch.column(4)))
            world = SmallWorld.build((v / norm[:, None]).astype(np.float32))
            n, width = len(v), world.audited_width(cosine - 1e-5)
            layers = [b"".join(m.links[i].tobytes() for m in reversed(world.layers) if i < len(m.links)) for i in range(n)]
            columns = [batch.column(0), batch.column(1), pa.array(range(n), pa.int32()), batch.column(2), batch.column(3), batch.column(4)]
            columns += [pa.array(layers, pa.binary()), pa.array([width] * n, pa.int32()), pa.array([world.recall] * n)]
            return pa.record_batch(columns, names=[c.split()[0] for c in GRAPH.split(", ")])

        group, parts = None, []
        for key, part in runs(batches, 2):
            if key != group and parts:
                yield one(parts)
                parts = []
            group = key
            parts.append(part)
        if parts:
            yield one(parts)

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    dealt = classes.select(shard, F.size("v").alias("size"), "vec_id", "copies", "v").repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "size", F.hash("vec_id", F.lit(7)), "vec_id")
    return stored(dealt.mapInArrow(build, GRAPH), "graphs")


class Held:
    """A stored shard: its graph, and what its nodes are."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, v: np.ndarray, layers: list[bytes], width: int):
        self.ids, self.copies, self.width = ids, copies, width
        self.v, self.norm = scaled(v)
        x = (self.v / self.norm[:, None]).astype(np.float32)
        rows = np.frombuffer(b"".join(layers), np.int32).reshape(-1, 2 * DEGREE)
        depth = np.array([len(b) for b in layers]) // (8 * DEGREE)
        first = np.cumsum(depth) - depth
        # layer k from below has the nodes that are in more than k layers, which are the first ones
        self.world = SmallWorld(x, [Layer(x[: (depth > k).sum()], rows[first[depth > k] + k]) for k in range(int(depth.max()) - 1, -1, -1)])
        self.order = np.argsort(ids, kind="stable")

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The nodes of ids, -1 for those of other shards."""
        at = self.order[np.minimum(np.searchsorted(self.ids, ids, sorter=self.order), len(self.ids) - 1)]
        return np.where(self.ids[at] == ids, at, -1)

    def links(self, ids: np.ndarray, v: np.ndarray, cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """(number of links of each vector with others' nodes, copies counted; a forest of the links)."""
        v, norm = scaled(v)
        q = (v / norm[:, None]).astype(np.float32)
        count, trees = np.zeros(len(ids)), []
        self.width = self.world.audited_width(cosine - 1e-5, (q, self.places(ids)), self.width)
        for rows, nodes in self.world.within(q, cosine - 1e-5, self.width):
            for at in range(0, len(rows), PAIRS):
                r, p = rows[at : at + PAIRS], nodes[at : at + PAIRS]
                near = (v[r] * self.v[p]).sum(1) / (norm[r] * self.norm[p]) >= cosine
                near &= ids[r] != self.ids[p]
                r, p = r[near], p[near]
                count += np.bincount(r, self.copies[p], len(ids))
                trees += forest(ids[r], self.ids[p])
        return count, forest(*np.array(trees, np.int64).reshape(-1, 2).T)


def links(graph: DataFrame, shards: int, blocks: int, cosine: float) -> DataFrame:
    """(u, v, n): with v null, n other vectors that class u links with in some shard; else a link of a forest."""
    each = lambda n, name: F.explode(F.expr(f"sequence(0L, {n - 1}L)")).alias(name)
    base = graph.select("shard", "size", each(blocks, "block"), F.lit(0).alias("asks"), "node", "vec_id", "copies", "v", "layers", "width")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("copies", "long"), ("v", "array<double>"), ("layers", "binary"), ("width", "int"))]
    none[1] = F.col("v")
    asks = graph.select(each(shards, "shard"), "size", block, F.lit(1).alias("asks"), F.lit(0).alias("node"), "vec_id", *none)
    # numbered tasks: a hash would put several shards into one
    dealt = base.unionByName(asks).repartitionById(shards * blocks, (F.col("shard") * blocks + F.col("block")).cast("int")).sortWithinPartitions("shard", "size", "block", "asks", "node", "vec_id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, parts, held = None, [], None
        for (*key, asks), part in runs(batches, 4):
            if key != group:
                group, parts, held = key, [], None
            if not asks:
                parts.append(part)
                continue
            if held is None and parts:
                b = whole(parts)
                held = Held(b.column(5).to_numpy(), b.column(6).to_numpy(), matrix(b.column(7)), b.column(8).to_pylist(), b.column(9)[0].as_py())
                parts = []
            if held is None:  # the shard has no vector of this length
                continue
            ids = part.column(5).to_numpy()
            count, trees = held.links(ids, matrix(part.column(7)), cosine)
            some = np.flatnonzero(count)
            u = ids[some].tolist() + [a for a, _ in trees]
            v = [None] * len(some) + [b for _, b in trees]
            n = count[some].astype(np.int64).tolist() + [0] * len(trees)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (u, v, n)], names=["u", "v", "n"])

    return stored(dealt.mapInArrow(run, "u long, v long, n long"), "vector-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding)."""
    held = usable(vectors)
    key = F.xxhash64("v").alias("h")
    classes = held.groupBy(key, "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = stored(classes.drop("h"), "vector-classes")
    n, width = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    shards = max(shards, -(-n // min(shard_rows, max(1, SHARD_BYTES // (8 * (width or 1))))))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block_rows), -(-cores // shards))
    found = links(graphs(classes, shards, cosine), shards, blocks, cosine)
    counts = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    reps = classes.select("v", F.col("vec_id").alias("rep"), "copies", F.xxhash64("v").alias("h"))
    member = stored(held.select("vec_id", "v", key).join(reps, ["h", "v"]).select("vec_id", "rep", "copies"), "vector-members")
    # rows that repeat an id may be in several classes
    several = member.groupBy("vec_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).where("u <> v").select("vec_id", "u")
    same = member.join(several, "vec_id").select("u", F.col("rep").alias("v")).distinct()
    part = components(found.where("v is not null").select("u", "v").union(same))
    linked = member.join(counts, "rep", "left").join(part.withColumnRenamed("id", "rep"), "rep", "left")
    out = linked.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    own = F.col("vec_id").cast("long")
    rest = vectors.where(~takes_part()).select(own.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), own.alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
