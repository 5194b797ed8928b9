"""Connected components of a graph: trees inside tasks, then alternating large-star and small-star between them.

Every round is checkpointed in the shared folder. A node's links are joined with its least neighbour by salted keys, so the
links of a node that holds a third of all of them are spread over SALTS tasks, and further by adaptive skew joins. Joins are
merge joins at every size: a broadcast in each round would pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROUNDS = 60
SALTS = 8


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; in local mode, a folder of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cairnfield-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def trees(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links: each node that is not the least of its tree, and that least node."""
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
    return nodes[moved], nodes[root[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) as links to the least node of each tree that a task's edges make."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            u, v = trees(*(np.concatenate([x, c.to_numpy()]) for x, c in zip((u, v), batch.columns, strict=True)))
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    long = [F.col(c).cast("long").alias(c) for c in "uv"]
    return edges.select(*long).where("u <> v").mapInArrow(run, "u long, v long")


def _star(links: DataFrame) -> DataFrame:
    """links (u, v) plus m, the least of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), "m", F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt"))
    own = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    return links.withColumn("r", own).join(least.hint("merge"), (F.col("u") == F.col("w")) & (F.col("r") == F.col("salt"))).select("u", "v", F.least("u", "m").alias("m"))


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


def are_stars(links: DataFrame) -> bool:
    """Whether every node of links (u, v) is either linked to one node or has nodes linked to it."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def least_labels(edges: DataFrame) -> DataFrame:
    """(id, label) for each node of edges (u, v): the least node of its component. Nulls and loops are left out."""
    now = settled(contracted(edges))
    for _ in range(MAX_ROUNDS):
        if are_stars(now):
            return now.select(F.col("u").alias("id"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
        now = settled(contracted(small_star(large_star(now))))
    raise RuntimeError("components did not settle")
