"""Rasters moved between coordinate systems: cells of a target grid find their places in a source grid.

The exact projection is made at the corners of square tiles of the target; places in between are interpolated. A tile whose
interpolation strays by more than a bound is split, down to single cells, which are projected themselves. Tiles that do not meet
the source are left out before they have cells. The nearest cell is that of the exact projection for every bound: places that lie
within the bound of a border between two cells are projected exactly. Tasks do this on arrays, a tile at a time: as expressions, the
series are nested so deep that plans which filter or join by them grow beyond bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions import projection
from cairnfield.operators import spatial

#: Sides of tiles, in cells, from the first to the last that are interpolated.
STEPS = (256, 64, 16, 4)
#: Cells that a task makes.
TASK_CELLS = 2_000_000
#: Points on each border of a source by which its place in another system is found.
BORDER_POINTS = 64
#: Source cells around a source whose weights reach it.
MARGIN = 3
#: Places of a tile, in halves of its side: corners, then the middles of the upper, lower, left and right borders.
POINTS = ((0, 0), (0, 2), (2, 0), (2, 2), (0, 1), (2, 1), (1, 0), (1, 2))


@dataclass(frozen=True)
class Grid:
    """A raster's place: the outer corner (x0, y0) of its first cell, the side of cells, its size and its UTM zone (None: degrees)."""

    x0: float
    y0: float
    size: float
    rows: int
    cols: int
    zone: int | None = None
    south: bool = False


def between(x, y, old: Grid, new: Grid):  # noqa: ANN001, ANN201
    """Arrays of coordinates of one grid's system in that of another."""
    lon, lat = (x, y) if old.zone is None else projection.from_utm(x, y, old.zone, old.south, np)
    return (lon, lat) if new.zone is None else projection.to_utm(lon, lat, new.zone, new.south, np)


def exact(row: np.ndarray, col: np.ndarray, source: Grid, target: Grid) -> tuple[np.ndarray, np.ndarray]:
    """The places, in rows and columns of the source, of the middles of target cells."""
    x, y = between(*projection.cell_centres(row, col, target.x0, target.y0, target.size), target, source)
    return (source.y0 - y) / source.size - 0.5, (x - source.x0) / source.size - 0.5


def covering(source: Grid, zone: int | None, size: float, south: bool = False) -> Grid:
    """The grid of another system that holds a source, its corner at whole multiples of the cell size."""
    share = np.linspace(0, 1, BORDER_POINTS + 1)
    wide, high, flat = share * source.cols * source.size, share * source.rows * source.size, np.zeros(len(share))
    x, y = np.concatenate([flat, flat + wide[-1], wide, wide]) + source.x0, source.y0 - np.concatenate([high, high, flat, flat + high[-1]])
    x, y = between(x, y, source, Grid(0.0, 0.0, size, 0, 0, zone, south))
    # one cell more on each side, as borders are bent between their points
    c0, c1, r0, r1 = math.floor(x.min() / size) - 1, math.ceil(x.max() / size) + 1, math.floor(y.min() / size) - 1, math.ceil(y.max() / size) + 1
    return Grid(c0 * size, r1 * size, size, r1 - r0, c1 - c0, zone, south)


def tiles(row: int, col: int, source: Grid, target: Grid, bound: float, level: int = 0) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(row, col, side, places of the corners) of the tiles, within the bound, of one that may meet the source.

    Cells whose tile of the least side is beyond the bound are projected themselves: they come as that tile, without places.
    """
    step = STEPS[level]
    i, k = np.array(POINTS).T * step / 2
    at = np.stack(exact(row + i, col + k, source, target))
    off = lambda m, p, q: np.abs(at[:, m] - (at[:, p] + at[:, q]) / 2)
    # a tile bends along both of its sides at most by the sum of what its borders do; twice that leaves room for higher orders
    error = 2 * (np.maximum(off(4, 0, 1), off(5, 2, 3)) + np.maximum(off(6, 0, 2), off(7, 1, 3)))
    low, high = at[:, :4].min(1) - error - MARGIN, at[:, :4].max(1) + error + MARGIN
    if low[0] >= source.rows or high[0] < 0 or low[1] >= source.cols or high[1] < 0:
        return
    if error.max() <= bound:
        yield row, col, step, at[:, :4]
    elif level + 1 == len(STEPS):
        yield row, col, step, None
    else:
        part = STEPS[level + 1]
        for r in range(row, min(row + step, target.rows), part):
            for c in range(col, min(col + step, target.cols), part):
                yield from tiles(r, c, source, target, bound, level + 1)


def tile_places(row: int, col: int, step: int, corners: np.ndarray | None, source: Grid, target: Grid, bound: float, nearest: bool) -> tuple:
    """(r, c, v, u) of a tile's cells."""
    r, c = (g.ravel() for g in np.meshgrid(np.arange(row, min(row + step, target.rows)), np.arange(col, min(col + step, target.cols)), indexing="ij"))
    if corners is None:
        return r, c, *exact(r, c, source, target)
    a, b = (r - row) / step, (c - col) / step
    v, u = (1 - a) * ((1 - b) * corners[:, :1] + b * corners[:, 1:2]) + a * ((1 - b) * corners[:, 2:3] + b * corners[:, 3:4])
    if nearest:
        edge = (np.abs(v - np.floor(v) - 0.5) <= bound) | (np.abs(u - np.floor(u) - 0.5) <= bound)
        v[edge], u[edge] = exact(r[edge], c[edge], source, target)
    return r, c, v, u


def places(spark: SparkSession, source: Grid, target: Grid, bound: float = 0.125, nearest: bool = True) -> DataFrame:
    """(r, c, v, u): target cells that may meet the source, with their places there, within a bound of source cells.

    With nearest, places within the bound of a border between source cells are exact. Tiles of the first side are dealt over
    tasks, and a task holds one tile's cells. An empty source or target has no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for n in batch.column(0).to_pylist():
                for tile in tiles(n // across * STEPS[0], n % across * STEPS[0], source, target, bound):
                    r, c, v, u = tile_places(*tile, source, target, bound, nearest)
                    met = (v > -MARGIN) & (v < source.rows + MARGIN) & (u > -MARGIN) & (u < source.cols + MARGIN)
                    if met.any():
                        yield pa.record_batch([pa.array(x[met]) for x in (r, c, v, u)], names=["r", "c", "v", "u"])

    down, across = -(-target.rows // STEPS[0]), max(1, -(-target.cols // STEPS[0]))
    count = down * across if source.rows and source.cols else 0
    tasks = min(max(spark.sparkContext.defaultParallelism, count * STEPS[0] ** 2 // TASK_CELLS), 10_000)
    return spark.range(0, count, 1, tasks).mapInArrow(run, "r long, c long, v double, u double")


def warped(cells: DataFrame, source: Grid, target: Grid, method: str = "nearest", bound: float = 0.125) -> DataFrame:
    """(row, col, value) of the target's cells that find values of the source's cells (row, col, value); others have no row.

    nearest gives the cell that holds the exact place; bilinear and cubic take places within the bound. Null values are as cells
    that are not there; of repeated cells all count, by their mean.
    """
    held = cells.where("value is not null").select("row", "col", "value")
    at = places(cells.sparkSession, source, target, bound, method == "nearest")
    out = spatial.resampled(at, held, ["r", "c"], "v", "u", method)
    return out.where("value is not null").select(F.col("r").alias("row"), F.col("c").alias("col"), "value")
