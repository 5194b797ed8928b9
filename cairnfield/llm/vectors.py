"""What the vector operators share: which vectors take part, and their Arrow batches as matrices and runs of equal keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part() -> Column:
    """Whether a row (vec_id, embedding) has an id, and a vector of finite components that are not all 0."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    return vectors.where(takes_part()).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))


def matrix(column) -> np.ndarray:  # noqa: ANN001
    """A list column of an Arrow batch whose lists have one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists(rows: np.ndarray):  # noqa: ANN201
    """A matrix as an Arrow column of lists of one length."""
    import pyarrow as pa

    ends = np.arange(len(rows) + 1) * (rows.shape[1] if len(rows) else 0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def runs(batches: Iterator, keys: int) -> Iterator[tuple]:
    """(key, slice) of each run of equal values in the first `keys` columns of Arrow batches; a run may end with a batch."""
    for batch in batches:
        if batch.num_rows:
            k = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(keys)], 1)
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(k)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield tuple(k[a].tolist()), batch.slice(a, b - a)


def whole(parts: list):  # noqa: ANN201
    """Slices of Arrow batches as one batch."""
    import pyarrow as pa

    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
