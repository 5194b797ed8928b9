"""Whitening of embeddings by a one-sided Jacobi singular value decomposition of their centred rows.

Entries are taken as whole numbers, x = floor(1024 c) + 100000, so that sums over the table are exact. Each task centres its
rows and compresses them block by block to one triangular factor R (QR of the last R over the next block); factors are then
joined FAN to a task until one is left, whose R'R is the sum of squares of all centred rows. Plane rotations make R's columns
orthogonal: their lengths over sqrt(n) are the standard deviations, and the rotations' product holds the components. No
covariance is formed, so small deviations keep their accuracy. A last pass over the rows measures the covariance of what
whitening gives.

To the driver come sums of the dimensions, the components kept and the largest error; R stays in a task.

Defined cases: null vectors, empty ones and those with null or non-finite entries are dropped, and so are vectors of another
length than the most frequent one (the larger, of two), and those with an entry of 2^40 or more in magnitude, which has no place in the exact sums;
components without deviation (LEAST of the largest, or less) are left out, so that equal vectors, or a single one, have no
rows; repeated rows and null ids are answered one by one; an empty table gives no rows; other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import table
from cairnfield.llm.vectors import lists, matrix

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
#: Rows that are compressed at once; factors that a task joins.
BLOCK, FAN = 4096, 32
#: Cosine of two columns that counts as orthogonal; a component's least deviation, of the largest.
ORTHOGONAL, LEAST = 1e-15, 1e-10
SWEEPS = 60
RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """n rows with sums by dimension; components (dimension x component), their deviations and shares of all variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole parts are taken off as whole numbers, so that nothing is lost to the shift."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / self.deviations


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST / SCALE))
    held = vectors.where(F.coalesce(~bad & (F.size(v) > 0), F.lit(False)))
    x = held.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    sizes = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    return x.where(F.size("x") == (most["d"] if most else 0))


def column_sums(x: DataFrame) -> tuple[int, list[int]]:
    """(n, sums by dimension): tasks add up their rows, the sums of the tasks meet by dimension."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, total = 0, np.zeros(0, object)
        for batch in batches:
            rows = matrix(batch.column(0))
            n, total = n + len(rows), rows.sum(0).astype(object) + (total if len(total) else 0)  # 2^40 times a batch's rows fits
        if n:
            sums = pa.array([str(v) for v in total])
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), sums], names=["k", "n", "s"])

    parts = x.select("x").mapInArrow(run, "k int, n long, s string")
    rows = parts.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("k").collect()  # a row a dimension
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [])


def factor(rows: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """The square triangular factor of rows below an earlier one."""
    both = rows if before is None else np.concatenate([before, rows])
    short = max(0, both.shape[1] - len(both))
    return np.linalg.qr(np.concatenate([both, np.zeros((short, both.shape[1]))]) if short else both, mode="r")


def factors(rows: DataFrame, centre: Whitening | None = None) -> DataFrame:
    """One factor a task, as the row lists of it, of all rows of the one column; they are whole numbers if a centre is given."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r = None
        for batch in batches:
            values = matrix(batch.column(0))
            for at in range(0, len(values), BLOCK):
                block = values[at : at + BLOCK]
                r = factor(block if centre is None else centre.centred(block), r)
        if r is not None:
            yield pa.record_batch([lists(r)], names=["r"])

    return rows.mapInArrow(run, "r array<double>")


def jacobi(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; right singular vectors as columns) of a square matrix.

    Pairs of columns are rotated until all are orthogonal. A sweep deals the columns into rounds of disjoint pairs, as the
    teams of a tournament meet, and rotates a round's pairs at once.
    """
    d = r.shape[1]
    a, v = np.array(r, float), np.eye(d)
    scale = np.abs(a).max(initial=0.0)
    if d > 1 and scale > 0:
        a /= scale
        teams = np.arange(d + d % 2)
        for _ in range(SWEEPS):
            turned = False
            for _ in range(len(teams) - 1):
                p, q = teams[: len(teams) // 2], teams[: len(teams) // 2 - 1 : -1]
                real = (p < d) & (q < d)
                turned |= rotate(a, v, p[real], q[real])
                teams = np.concatenate([teams[:1], teams[-1:], teams[1:-1]])
            if not turned:
                break
        else:
            raise ArithmeticError(f"columns are not orthogonal after {SWEEPS} sweeps")
        a *= scale
    size = np.sqrt((a * a).sum(0))
    order = np.argsort(-size, kind="stable")
    return size[order], v[:, order]


def rotate(a: np.ndarray, v: np.ndarray, p: np.ndarray, q: np.ndarray) -> bool:
    """Turns the columns p and q of a against each other, and those of v alike, where they are not orthogonal."""
    x, y = a[:, p], a[:, q]
    xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
    wrong = np.abs(xy) > ORTHOGONAL * len(a) * np.sqrt(xx * yy)
    if not wrong.any():
        return False
    p, q, xx, yy, xy = p[wrong], q[wrong], xx[wrong], yy[wrong], xy[wrong]
    zeta = (yy - xx) / (2 * xy)
    t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
    cos = 1 / np.sqrt(1 + t * t)
    sin = cos * t
    for m in (a, v):
        x, y = m[:, p], m[:, q]
        m[:, p], m[:, q] = cos * x - sin * y, sin * x + cos * y
    return True


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of (vec_id, x); None without rows. A component's largest entry is positive."""
    n, sums = column_sums(x)
    if not n:
        return None
    none = np.zeros((len(sums), 0))
    now = factors(x.select("x"), Whitening(n, tuple(sums), none, none[0], none[0]))
    tasks = x.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN)
        now = factors(now.repartition(tasks))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r = None
        for batch in batches:
            r = factor(matrix(batch.column(0)), r)
        if r is None:
            return
        size, v = jacobi(r)
        held = int((size > LEAST * size[0]).sum()) if size[0] > 0 else 0
        k = min(components, held)
        v = v[:, :k] * np.where(v[np.abs(v[:, :k]).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        all_variance = float((size * size).sum())
        yield pa.record_batch([pa.array(size[:k]), pa.array(size[:k] ** 2 / all_variance if k else []), lists(np.ascontiguousarray(v.T)) if k else pa.array([], pa.list_(pa.float64()))], names=["size", "explained", "v"])

    rows = now.repartition(1).mapInArrow(run, "size double, explained double, v array<double>").collect()  # a row a component
    rows.sort(key=lambda r: -r["size"])
    v = np.array([r["v"] for r in rows]).T.reshape(len(sums), -1)
    return Whitening(n, tuple(sums), v, np.array([r["size"] for r in rows]) / np.sqrt(n), np.array([r["explained"] for r in rows]))


def identity_error(x: DataFrame, model: Whitening) -> float:
    """The largest entry, in magnitude, of the covariance of the whitened rows less the identity."""
    k = model.components.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        gram = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = model.whitened(matrix(batch.column(0)))
            one = np.concatenate([w, np.ones((len(w), 1))], 1)
            gram += one.T @ one
        yield pa.record_batch([pa.array(range(gram.size), pa.int32()), pa.array(gram.reshape(-1))], names=["k", "s"])

    parts = x.select("x").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()  # (k + 1)^2 rows
    gram = np.array([r["s"] for r in parts]).reshape(k + 1, k + 1) / model.n
    return float(np.abs(gram[:k, :k] - np.outer(gram[:k, k], gram[:k, k]) - np.eye(k)).max(initial=0.0))


def squared_distance(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """The sum over dimensions of (n x - S)^2 of each row, exact: halves of 31 bits are squared apart where whole squares do not fit."""
    largest = max(int(np.abs(x).max(initial=0)) * n, *map(abs, sums)) * 2
    if largest >= 1 << 62:
        return [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    z = np.abs(n * x - np.array(sums, np.int64))
    top = int(z.max(initial=0))
    if top * top * x.shape[1] < 1 << 63:
        return (z * z).sum(1).tolist()
    high, low = z >> 31, z & ((1 << 31) - 1)
    parts = [[int(v) for v in p.astype(object).sum(1)] if int(p.max(initial=0)) * x.shape[1] >= 1 << 63 else p.sum(1).tolist() for p in (high * high, high * low, low * low)]
    return [(a << 62) + (b << 32) + c for a, b, c in zip(*parts, strict=True)]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """RESULT of vectors (vec_id, embedding): a row for each vector that takes part and each component."""
    x = whole_numbers(vectors)
    model = fit(x, components)
    if model is None or not model.components.shape[1]:
        return vectors.sparkSession.createDataFrame([], RESULT)
    error, k = identity_error(x, model), model.components.shape[1]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from decimal import Decimal

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows = matrix(part.column(1))
                far = pa.array([Decimal(v) for v in squared_distance(rows, model.n, model.sums)], pa.decimal128(38, 0))
                again = pa.array(np.repeat(np.arange(len(rows)), k))
                columns = [
                    part.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(rows) * k, model.n)), far.take(again),
                    pa.array(model.whitened(rows).reshape(-1)), pa.array(np.tile(model.explained, len(rows))), pa.array(np.full(len(rows) * k, error)),
                ]
                yield pa.record_batch(columns, names=[f.split()[0] for f in RESULT.replace("38,0", "38").split(", ")])

    return x.mapInArrow(run, RESULT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as a long, as the contract says: beyond 2^63 the cast ends in an error; whiten() has it as a decimal."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", long_or_error(F.col("deviation")))


def long_or_error(value: Column) -> Column:
    fits = F.abs(value) < F.lit(str(1 << 63)).cast("decimal(38,0)")
    return F.when(fits, value.cast("long")).otherwise(F.raise_error(F.lit("a deviation is beyond 64 bits")).cast("long"))
