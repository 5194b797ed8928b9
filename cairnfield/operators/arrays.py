"""Functions of whole series by Arrow batches: series of one length are a matrix, so NumPy works on many at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers that a chunk of series may need at once, in each of a function's arrays.
CELLS = 1 << 21


def gathered(obs: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """(keys.., p): one row a series, its points (x, y) sorted by both; points with a null are left out."""
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    held = F.col(x).isNotNull() & F.col(y).isNotNull()
    return obs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(held, point))).alias("p"))


def per_series(series: DataFrame, outputs: dict[str, str], work: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], cells: Callable[[int], int]) -> DataFrame:
    """series (.., p) with a column for each output (name: int or double) in place of p.

    work gets x and y, matrices of series x points, and returns an array of a number a series for each output, NaN
    standing for null; cells says how many numbers a series of n points needs meanwhile.
    """
    kept = [f for f in series.schema.fields if f.name != "p"]
    kinds = {"int": T.IntegerType(), "double": T.DoubleType()}
    schema = T.StructType([*kept, *(T.StructField(name, kinds[kind]) for name, kind in outputs.items())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(len(kept))
            size, flat = lists.value_lengths().to_numpy(), lists.flatten()
            x, y = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y"))
            start = np.cumsum(size) - size
            found = np.full((len(outputs), batch.num_rows), np.nan)
            for n in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == n)
                step = max(1, CELLS // max(1, cells(n)))
                for k in range(0, len(rows), step):
                    at = start[rows[k : k + step], None] + np.arange(n)
                    found[:, rows[k : k + step]] = work(x[at], y[at])
            columns = []
            for values, kind in zip(found, outputs.values(), strict=True):
                none = np.isnan(values)
                columns.append(pa.array(np.where(none, 0, values).astype(np.int32 if kind == "int" else float), mask=none))
            yield pa.record_batch([*batch.columns[: len(kept)], *columns], names=schema.names)

    return series.select(*[f.name for f in kept], "p").mapInArrow(run, schema)
