"""Connected components by alternating large-star and small-star, as joins and aggregates over an edge table.

Before the first round and after each, every task joins the edges that it holds to trees and gives links to each tree's least
node alone. Then nodes whose only link goes to a smaller node, and to which none goes, are set aside: they have the component of
that node. So a star that has settled, however large, takes no part in the next round's joins, and of a node that holds a third
of all links only those are left whose other ends are linked elsewhere. Those set aside are named last, by salted keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.llm._shared import dropped, new_path, stored

MAX_ROUNDS = 60
#: Copies of a label that leaves of one node are dealt over.
SALTS = 8
#: Links that a task joins to trees at once, beside those that its trees have left.
LINKS = 1 << 20


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links: each node that is not the least of its tree, and that least node."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) as links to the least node of each tree that a task's edges make, a bounded number of them at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            u, v = (np.concatenate([x, c.to_numpy()]) for x, c in zip((u, v), batch.columns, strict=True))
            if len(u) > LINKS:
                u, v = forest(u, v)
                if len(u) > LINKS // 2:  # trees that hardly shrink are handed on, and others begun
                    yield out(u, v)
                    u, v = u[:0], v[:0]
        yield out(*forest(u, v))

    return edges.mapInArrow(run, "u long, v long")


def _star(links: DataFrame) -> DataFrame:
    """links (u, v) plus m, the least of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).select("u", "v", F.least("u", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.union(edges.select("v", "u"))
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    s = _star(down)
    moved = s.select("v", "m").union(s.select("u", "m")).where("v <> m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def leaves(links: DataFrame) -> DataFrame:
    """The links (u, v) of nodes u that have no other and are no node's v."""
    single = links.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("w")).where("v = w").select("u", "v")
    return single.join(links.select(F.col("v").alias("h")).distinct(), F.col("u") == F.col("h"), "left_anti")


def named(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, component_id) of each u of links (u, v): the label of v, or v where it has none. v may be that of a third of all u."""
    copies = labels.select(F.col("id").alias("h"), "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int")
    both = links.withColumn("own", salt).join(copies, (F.col("v") == F.col("h")) & (F.col("own") == F.col("salt")), "left")
    return both.select(F.col("u").alias("id"), F.coalesce("component_id", "v").alias("component_id"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every node of edges (u, v); component_id is the component's least node.

    Every round is written to the shared folder, and the one before is deleted then. Nulls and loops are left out; no edges
    give no rows.
    """
    spark, before, aside = edges.sparkSession, None, []
    now = edges.select(*[F.col(c).cast("long").alias(c) for c in "uv"]).where("u <> v")
    for _ in range(MAX_ROUNDS):
        path = new_path(spark, "edges")
        contracted(now).write.option("compression", "zstd").parquet(path)
        if before:
            dropped(spark, before)
        now, before = spark.read.schema("u long, v long").parquet(path), path
        if now.isEmpty():
            break
        aside.append(stored(leaves(now), "leaves"))
        now = now.join(aside[-1].select("u"), "u", "left_anti")
        now = small_star(large_star(now))
    else:
        raise RuntimeError("components did not settle")
    out = spark.createDataFrame([], "id long, component_id long")
    for k, links in enumerate(reversed(aside)):
        out = out.unionByName(named(links, out) if k else links.toDF("id", "component_id"))
    return out.union(out.select("component_id", "component_id").distinct())
