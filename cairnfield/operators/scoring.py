"""Model scores of cells and objects by Arrow batches, and hulls of objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.flooding import flood, watershed

__all__ = ["classified", "filtered_objects", "flood", "hull", "solidity", "watershed"]


def classified(df: DataFrame, features: list[str], classes: list[int], predict_proba: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """df plus class, proba and confidence; all null where every feature is null, single nulls count as 0.

    predict_proba takes a (rows x features) matrix and returns (rows x classes); it is shipped to the tasks.
    """

    @F.pandas_udf("array<double>")
    def proba(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            empty = np.isnan(x).all(1)
            p = predict_proba(np.nan_to_num(x))
            yield pd.Series([None if e else row.tolist() for e, row in zip(empty, p, strict=True)])

    out = df.withColumn("proba", proba(*[F.col(c).cast("double") for c in features]))
    at = F.array_position("proba", F.array_max("proba"))
    names = F.array(*[F.lit(c) for c in classes])
    return out.withColumns({"class": F.when(F.col("proba").isNotNull(), F.element_at(names, at.cast("int"))), "confidence": F.array_max("proba")})


def filtered_objects(objects: DataFrame, query: str = "proba <= 0.5 and max > 0.95") -> DataFrame:
    """Objects for which the condition holds; a null in it drops the object."""
    return objects.where(F.expr(query))


def _chain(seq: list) -> list:
    out: list = []
    for p in seq:
        while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
            out.pop()
        out.append(p)
    return out[:-1]


def _ring(corners: set) -> list:
    """The corners of the convex hull of points, in turn."""
    points = sorted(corners)
    return _chain(points) + _chain(points[::-1])


def _measures(ring: list) -> tuple[float, float, float]:
    """(area, row, col) of a ring and of its centroid, taken from its first corner on, so that far places lose no digits."""
    r0, c0 = ring[0]
    twice = row = col = 0.0
    for (a, b), (c, d) in zip(ring, [*ring[1:], ring[0]], strict=True):
        a, b, c, d = a - r0, b - c0, c - r0, d - c0
        cross = a * d - c * b
        twice, row, col = twice + cross, row + (a + c) * cross, col + (b + d) * cross
    return abs(twice / 2), r0 + row / (3 * twice), c0 + col / (3 * twice)


def hull(rows: np.ndarray, cols: np.ndarray) -> tuple[float, float, float]:
    """(area, row, col) of the convex hull of unit cells and of its centroid, in the cells' own coordinates."""
    return _measures(_ring({(float(r + i), float(c + k)) for r, c in zip(rows, cols, strict=True) for i in (-0.5, 0.5) for k in (-0.5, 0.5)}))


def solidity(labels: DataFrame) -> DataFrame:
    """(label, area, convex_area, solidity, hull_row, hull_col): the convex hull's area and centroid.

    Only the ends of an object's rows go to its task, as they fix the hull. A task reads its objects as one sorted stream of
    batches; of an object that goes on in the next batch it keeps the hull's corners.
    """
    ends = labels.groupBy("label", "row").agg(F.min("col").alias("first"), F.max("col").alias("last"), F.count("*").alias("n"))
    names = ("label", "area", "convex_area", "solidity", "hull_row", "hull_col")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def made(done: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 4)
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

        label, n, corners = None, 0, set()

        def closed() -> tuple:
            area, row, col = _measures(_ring(corners))
            return label, n, area, n / area, row, col

        for batch in batches:
            done = []
            for own, r, first, last, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != label:
                    if corners:
                        done.append(closed())
                    label, n, corners = own, 0, set()
                n += count
                corners.update(((r - 0.5, first - 0.5), (r + 0.5, first - 0.5), (r - 0.5, last + 0.5), (r + 0.5, last + 0.5)))
            corners = set(_ring(corners))
            if done:
                yield made(done)
        if corners:
            yield made([closed()])

    dealt = ends.repartition("label").sortWithinPartitions("label").select("label", "row", "first", "last", "n")
    return dealt.mapInArrow(run, "label long, area long, convex_area double, solidity double, hull_row double, hull_col double")
