"""Places, boxes and tiles: range joins by bins, sampling, overlays, tilings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells of a side of the tiles in which targets are resampled.
TILE = 128
#: Places beyond this are those of no cell.
FAR = 2.0**52


def tiling(df: DataFrame, x_size: str, y_size: str, x_step: int, y_step: int) -> DataFrame:
    """The tiles of each raster: offsets, and sizes clipped at the far edges."""
    starts = lambda c, s: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(c).cast("long") - 1, F.lit(0).cast("long")), F.lit(s).cast("long")))
    out = df.withColumn("x_off", starts(x_size, x_step)).withColumn("y_off", starts(y_size, y_step))
    return out.withColumns({"x_len": F.least(F.lit(x_step), F.col(x_size) - F.col("x_off")), "y_len": F.least(F.lit(y_step), F.col(y_size) - F.col("y_off"))})


def _bins(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def in_boxes(points: DataFrame, boxes: DataFrame, x: str, y: str, bin_size: float) -> DataFrame:
    """points with each box (xmin, xmax, ymin, ymax, ..) that holds them, the lower ends included.

    Boxes are listed in the bins that they cover, so the range join is an equi-join on bins.
    """
    cover = boxes.withColumn("__bx", F.explode(_bins(F.col("xmin"), F.col("xmax"), bin_size))).withColumn("__by", F.explode(_bins(F.col("ymin"), F.col("ymax"), bin_size)))
    at = points.withColumns({"__bx": F.floor(F.col(x) / bin_size), "__by": F.floor(F.col(y) / bin_size)})
    inside = (F.col(x) >= F.col("xmin")) & (F.col(x) < F.col("xmax")) & (F.col(y) >= F.col("ymin")) & (F.col(y) < F.col("ymax"))
    return at.join(cover, ["__bx", "__by"]).where(inside).drop("__bx", "__by")


def meeting_boxes(left: DataFrame, right: DataFrame, bin_size: float, buffer: float = 0.0) -> DataFrame:
    """Pairs of boxes that meet when the left ones are widened by a buffer; columns of right have the prefix r_."""
    a = left.withColumn("__x", F.explode(_bins(F.col("xmin") - buffer, F.col("xmax") + buffer, bin_size))).withColumn("__y", F.explode(_bins(F.col("ymin") - buffer, F.col("ymax") + buffer, bin_size)))
    b = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    b = b.withColumn("__x", F.explode(_bins(F.col("r_xmin"), F.col("r_xmax"), bin_size))).withColumn("__y", F.explode(_bins(F.col("r_ymin"), F.col("r_ymax"), bin_size)))
    meet = (F.col("r_xmin") <= F.col("xmax") + buffer) & (F.col("r_xmax") >= F.col("xmin") - buffer) & (F.col("r_ymin") <= F.col("ymax") + buffer) & (F.col("r_ymax") >= F.col("ymin") - buffer)
    # a pair shares many bins; it is let out in the first of them alone
    first = (F.col("__x") == F.greatest(F.floor((F.col("xmin") - buffer) / bin_size), F.floor(F.col("r_xmin") / bin_size))) & (
        F.col("__y") == F.greatest(F.floor((F.col("ymin") - buffer) / bin_size), F.floor(F.col("r_ymin") / bin_size))
    )
    return a.join(b, ["__x", "__y"]).where(meet & first).drop("__x", "__y")


def sampled(points: DataFrame, cells: DataFrame, x: str, y: str, x0: float, y0: float, size: float) -> DataFrame:
    """points with the value of the cell that holds them; null outside."""
    at = points.withColumns({"col": F.floor((F.col(x) - x0) / size), "row": F.floor((F.lit(y0) - F.col(y)) / size)})
    return at.join(cells, ["row", "col"], "left")


def overlay(layers: DataFrame, keys: list[str], order: str = "ordinal", value: str = "value") -> DataFrame:
    """A mosaic: the value of the last layer that has one, 0 being none."""
    held = layers.where(F.col(value).isNotNull() & (F.col(value) != 0))
    return held.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def spread_over(df: DataFrame, rows: int, *keys: Column | str, total: int | None = None) -> DataFrame:
    """df dealt by keys into parts whose number follows its rows (total, where known): some `rows` in each, so that a task's memory does not grow with df."""
    total = df.count() if total is None else total
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // rows)), *keys)


def stacked(layers: DataFrame, keys: list[str], name: str, names: list[str], value: str = "value") -> DataFrame:
    """One column for each named layer."""
    return layers.groupBy(*keys).pivot(name, names).agg(F.first(value))


def updated(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """left with the values of right where right has any."""
    other = right.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = left.join(other, keys, "left")
    return out.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*[f"__{c}" for c in columns])


def with_attributes(objects: DataFrame, tables: list[DataFrame], key: str, how: str = "left") -> DataFrame:
    """objects joined with attribute tables of their key, one after the other: left, or full_outer to keep all keys.

    All joins are on one key, so objects and tables are dealt by it once each.
    """
    for t in tables:
        objects = objects.join(t, key, how)
    return objects


def stale(outputs: DataFrame, inputs: DataFrame, key: str, stamp: str = "ts") -> DataFrame:
    """Keys of outputs with whether they must be made again: missing, or older than the newest input."""
    newest = inputs.groupBy(key).agg(F.max(stamp).alias("newest"))
    old = outputs.groupBy(key).agg(F.max(stamp).alias("made"))
    both = newest.join(old, key, "left")
    return both.select(key, (F.col("made").isNull() | (F.col("made") < F.col("newest"))).alias("process"))


def unmet(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that are not there yet."""
    return expected.join(actual.select(*keys).distinct(), keys, "left_anti")


def box_union(boxes: DataFrame, *by: str) -> DataFrame:
    """The box around all boxes of a group."""
    ends = {"xmin": F.min, "xmax": F.max, "ymin": F.min, "ymax": F.max}
    return boxes.groupBy(*by).agg(*[f(c).alias(c) for c, f in ends.items()])


def newer_only(tiles: DataFrame, mosaics: DataFrame, key: str, stamp: str = "ts") -> DataFrame:
    """Tiles that are newer than their mosaic; a mosaic that is not there counts as made in 1900."""
    made = mosaics.groupBy(key).agg(F.max(stamp).alias("__made"))
    old = F.coalesce("__made", F.lit("1900-01-01").cast("timestamp_ntz"))
    return tiles.join(made, key, "left").where(F.col(stamp) > old).drop("__made")


def _kernel(method: str, t: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Offsets from the cell below, and their weights at a fraction t above it; cubic is the convolution with a = -1/2."""
    if method == "nearest":
        return [(0, np.where(t < 0.5, 1.0, 0.0)), (1, np.where(t < 0.5, 0.0, 1.0))]
    if method == "bilinear":
        return [(0, 1 - t), (1, t)]
    if method == "cubic":
        return [(-1, ((2 - t) * t - 1) * t / 2), (0, ((3 * t - 5) * t * t + 2) / 2), (1, ((4 - 3 * t) * t + 1) * t / 2), (2, (t - 1) * t * t / 2)]
    raise ValueError(f"method is nearest, bilinear or cubic, not {method!r}")


def _weighted(method: str, row: np.ndarray, col: np.ndarray, corner: tuple[int, int], total: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weighted sums of values, sums of weights) at places of a tile, of whose cells total and number hold values' sums and numbers."""
    low_row, low_col = np.floor(row), np.floor(col)
    a, b = low_row.astype(np.int64) - corner[0], low_col.astype(np.int64) - corner[1]
    s, w = np.zeros(len(row)), np.zeros(len(row))
    for i, x in _kernel(method, row - low_row):
        for k, y in _kernel(method, col - low_col):
            weight, at = x * y, (a + i, b + k)
            s += np.where((weight != 0) & (number[at] > 0), weight * total[at], 0.0)
            w += weight * number[at]
    return s, w


def resampled(targets: DataFrame, cells: DataFrame, keys: list[str], row: str, col: str, method: str = "nearest") -> DataFrame:
    """(keys.., value) of the targets at real-valued places (row, col) of a raster, whose cells have whole ones.

    Weights count over the cells that are there; a target without any, or without a place, has null. Cells go to the tiles
    whose targets ask for them, so each is moved about once, not once for each weight. A task reads a tile's cells, and then
    its targets by batches, from one sorted stream, so it holds one tile's arrays, however many targets the tile has.
    """
    ends = [offset for offset, _ in _kernel(method, np.zeros(0))]
    before, after = -min(ends), max(ends)
    side = TILE + before + after
    place = lambda c: F.col(c).cast("double")
    tiles = lambda c: F.explode(F.array_distinct(F.array(*[F.expr(f"floor(({c} - {n}) / {TILE})") for n in (after, -before)])))
    held = cells.where("value is not null").select(tiles("row").alias("__i"), "row", "col", "value").select("__i", tiles("col").alias("__k"), "row", "col", "value")
    held = held.select("__i", "__k", F.lit(0).alias("__kind"), *[F.col(c).cast("double").alias(f"__{c}") for c in ("row", "col", "value")], *[F.lit(None).cast(targets.schema[k].dataType).alias(k) for k in keys])
    known = lambda c: place(c).isNotNull() & (F.abs(place(c)) < FAR)
    there = known(row) & known(col)
    at = lambda c, other: F.when(there, F.floor(place(c) / TILE)).otherwise(other)
    asked = targets.select(
        at(row, F.pmod(F.xxhash64(*keys), F.lit(4096))).alias("__i"), at(col, F.lit(0)).alias("__k"), F.when(there, 1).otherwise(2).alias("__kind"),
        place(row).alias("__row"), place(col).alias("__col"), F.lit(None).cast("double").alias("__value"), *keys,
    )
    schema = T.StructType([*(targets.schema[k] for k in keys), T.StructField("__s", T.DoubleType()), T.StructField("__w", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tile, total, number = None, None, None
        for batch in batches:
            i, k, kind, r, c, value = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(6))
            parts = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (k[1:] != k[:-1]) | (kind[1:] != kind[:-1])]))
            s, w = np.zeros(len(i)), np.zeros(len(i))
            for start, end in zip(parts, [*parts[1:], len(i)], strict=True):
                corner = (int(i[start]) * TILE - before, int(k[start]) * TILE - before)
                if tile != corner:
                    tile, total, number = corner, np.zeros((side, side)), np.zeros((side, side))
                own = slice(start, end)
                if kind[start] == 1:
                    s[own], w[own] = _weighted(method, r[own], c[own], corner, total, number)
                elif kind[start] == 0:
                    cell = (r[own].astype(np.int64) - corner[0], c[own].astype(np.int64) - corner[1])
                    np.add.at(total, cell, value[own])
                    np.add.at(number, cell, 1.0)
            wanted = np.flatnonzero(kind)
            out = batch.take(pa.array(wanted))
            yield pa.record_batch([*out.columns[6:], pa.array(s[wanted]), pa.array(w[wanted])], schema=pa.schema([*list(batch.schema)[6:], ("__s", pa.float64()), ("__w", pa.float64())]))

    dealt = held.unionByName(asked).repartition("__i", "__k").sortWithinPartitions("__i", "__k", "__kind")
    found = dealt.mapInArrow(run, schema)
    return found.groupBy(*keys).agg(F.try_divide(F.sum("__s"), F.nullif(F.sum("__w"), F.lit(0.0))).alias("value"))
