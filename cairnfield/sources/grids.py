"""A Python data source of rasters in NumPy files: windows of tiles are the partitions, missing cells are left out.

    spark.dataSource.register(GridSource)
    spark.read.format("grid").option("path", "/data/tile.npy").option("step", 250).load()

Files hold (band, row, col) or (row, col) arrays and are mapped, so that a task reads its window alone. They must lie
on a file system that every executor mounts; files that cannot be opened are left out. For files in other stores, and for
georeferenced ones, see tiff.
"""

from __future__ import annotations

import glob
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class Window(InputPartition):
    path: str
    row: int
    col: int
    step: int


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = sorted(glob.glob(options["path"]))
        self.step = int(options.get("step", 250))
        self.factor = float(options.get("factor", 10000))
        self.nodata = float(options.get("nodata", 0))

    def partitions(self) -> list[Window]:
        out = []
        for p in self.paths:
            try:
                rows, cols = np.load(p, mmap_mode="r").shape[-2:]
            except (OSError, ValueError):  # left out, as headers() tells
                continue
            out += [Window(p, r, c, self.step) for r in range(0, rows, self.step) for c in range(0, cols, self.step)]
        return out

    def read(self, partition: Window) -> Iterator:
        import pyarrow as pa

        grid = np.load(partition.path, mmap_mode="r")
        grid = grid[None] if grid.ndim == 2 else grid
        part = np.array(grid[:, partition.row : partition.row + partition.step, partition.col : partition.col + partition.step], float)
        part[part == self.nodata] = np.nan
        row, col = np.nonzero(~np.isnan(part).all(0))
        held = part[:, row, col].T / self.factor
        flat = pa.array(held.reshape(-1), mask=np.isnan(held).reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * len(part), pa.int32()), flat)
        columns = [pa.array([partition.path] * len(row), pa.string()), pa.array(row + partition.row), pa.array(col + partition.col), lists]
        yield pa.record_batch(columns, names=["path", "row", "col", "b"])


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bands, rows, cols) of raster files; their cells are not read, files that cannot be opened have nulls."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for p in batch["path"]:
                try:
                    shape = np.load(p, mmap_mode="r").shape
                    out.append((p, shape[0] if len(shape) == 3 else 1, *shape[-2:]))
                except (OSError, ValueError):
                    out.append((p, None, None, None))
            yield pd.DataFrame(out, columns=["path", "bands", "rows", "cols"])

    return spark.createDataFrame([(p,) for p in paths], "path string").mapInPandas(run, "path string, bands int, rows int, cols int")


class GridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "grid"

    def schema(self) -> str:
        return "path string, row long, col long, b array<double>"

    def reader(self, schema) -> GridReader:  # noqa: ANN001
        return GridReader(self.options)
