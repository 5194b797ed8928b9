"""Rasters as sparse cells (row, col, ..): focal windows, objects, zonal statistics, thresholds.

A focal window is an explode to the neighbours' places and one aggregation by place, which combines within partitions
before it shuffles; no operator needs a raster in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnfield.operators.components import least_labels, settled

#: Rows of a raster whose links between runs are joined in one task.
BAND = 256
SQUARE = [(i, k) for i in (-1, 0, 1) for k in (-1, 0, 1)]
CROSS = [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]
#: The weights of the horizontal Sobel kernel by offset.
SOBEL = {(i, k): i * (2.0 if k == 0 else 1.0) / 4.0 for i in (-1, 1) for k in (-1, 0, 1)}

#: The published length of a border cell by its border neighbours at sides and at corners.
BORDER_PATTERNS = {
    (2, 0): 1.0, (3, 0): 1.0, (2, 1): 1.0, (3, 1): 1.0, (2, 2): 1.0, (3, 2): 1.0,
    (0, 2): math.sqrt(2), (1, 3): math.sqrt(2), (1, 1): (1 + math.sqrt(2)) / 2, (1, 2): (1 + math.sqrt(2)) / 2,
}


def from_array(df: DataFrame, row: str, values: str) -> DataFrame:
    """(row, col, value) of one array a row; nulls and NaN are left out."""
    out = df.select(F.col(row).alias("row"), F.posexplode(values).alias("col", "value"))
    return out.select("row", F.col("col").cast("long"), F.col("value").cast("double")).where("value is not null and not isnan(value)")


def spread(cells: DataFrame, offsets: list[tuple[int, int]] = SQUARE) -> DataFrame:
    """cells once for each offset, at the place moved by it; di and dk are the offset."""
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("k")) for i, k in offsets]))
    moved = cells.withColumn("__o", at)
    return moved.withColumns({"row": F.col("row") + F.col("__o.i"), "col": F.col("col") + F.col("__o.k"), "di": F.col("__o.i"), "dk": F.col("__o.k")}).drop("__o")


def _inside(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    return cells.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))


def dilate(mask: DataFrame, rows: int, cols: int, offsets: list[tuple[int, int]] = SQUARE) -> DataFrame:
    """Places with a cell of the mask in their window."""
    return _inside(spread(mask.select("row", "col"), offsets), rows, cols).select("row", "col").distinct()


def dilate_labels(labels: DataFrame, rows: int, cols: int) -> DataFrame:
    """The largest label in each place's window."""
    return _inside(spread(labels.select("row", "col", "label")), rows, cols).groupBy("row", "col").agg(F.max("label").alias("label"))


def erode(mask: DataFrame, rows: int, cols: int) -> DataFrame:
    """Cells whose whole window within the raster is in the mask."""
    return _full_windows(mask.select("row", "col").distinct(), rows, cols).select("row", "col")


def _full_windows(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """The cells, of each group if there are more columns, whose whole window within the raster is there."""
    high = lambda c, n: F.lit(3) - (F.col(c) == 0).cast("int") - (F.col(c) == n - 1).cast("int")
    seen = spread(cells).groupBy(*cells.columns).agg(F.count("*").alias("n"), F.max((F.col("di") == 0) & (F.col("dk") == 0)).alias("own"))
    return seen.where(F.col("own") & (F.col("n") == high("row", rows) * high("col", cols))).select(cells.columns)


def eroded(mask: DataFrame, rows: int, cols: int, offsets: list[tuple[int, int]]) -> DataFrame:
    """Erosion by any symmetric window: cells that no place outside the mask, but within the raster, has in its window."""
    own = mask.select("row", "col").distinct()
    outside = whole_grid(mask.sparkSession, rows, cols).join(own, ["row", "col"], "left_anti")
    return own.join(dilate(outside, rows, cols, offsets), ["row", "col"], "left_anti")


def closing(mask: DataFrame, rows: int, cols: int) -> DataFrame:
    return erode(dilate(mask, rows, cols), rows, cols)


def opening(mask: DataFrame, rows: int, cols: int) -> DataFrame:
    return dilate(erode(mask, rows, cols), rows, cols)


def focal(cells: DataFrame, weights: dict[tuple[int, int], float], value: str = "value") -> DataFrame:
    """The weighted mean of each cell's window over the cells that are there; the window holds the cell itself."""
    taps = [F.struct(F.lit(-i).alias("i"), F.lit(-k).alias("k"), F.lit(float(w)).alias("w")) for (i, k), w in weights.items()]
    moved = cells.select("row", "col", F.col(value).alias("value"), F.explode(F.array(*taps)).alias("o"))
    own = (F.col("o.i") == 0) & (F.col("o.k") == 0)
    moved = moved.select((F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.k")).alias("col"), (F.col("o.w") * F.col("value")).alias("s"), "o.w", own.alias("own"))
    out = moved.groupBy("row", "col").agg(F.sum("s").alias("s"), F.sum("w").alias("w"), F.max("own").alias("own")).where("own")
    return out.select("row", "col", (F.col("s") / F.nullif(F.col("w"), F.lit(0.0))).alias(value))


def whole_grid(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    """(row, col) of every place of a raster."""
    return spark.range(rows * cols).select(F.expr(f"id div {cols}").alias("row"), (F.col("id") % cols).alias("col"))


def without_holes(mask: DataFrame, rows: int, cols: int, least: int = 64) -> DataFrame:
    """The mask with every 4-connected gap of fewer than `least` cells filled."""
    own = mask.select("row", "col").distinct()
    gaps = components(whole_grid(mask.sparkSession, rows, cols).join(own, ["row", "col"], "left_anti"), cols)
    small = gaps.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") < least)
    return own.union(gaps.join(small.select("label"), "label", "left_semi").select("row", "col"))


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    return [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]


def gaussian(cells: DataFrame, sigma: float) -> DataFrame:
    """A blur by two passes of a one-dimensional kernel, over the cells that are there."""
    w = gaussian_weights(sigma)
    r = len(w) // 2
    for column in (True, False):
        cells = focal(cells, {((k - r), 0) if column else (0, (k - r)): x for k, x in enumerate(w)})
    return cells


def local_threshold(cells: DataFrame, offset: float = 0.0) -> DataFrame:
    """The Gaussian mean of each cell's 3 x 3 window, less an offset."""
    return gaussian(cells, 1 / 3).withColumn("value", F.col("value") - offset)


def sobel(cells: DataFrame) -> DataFrame:
    """Edge magnitude sqrt((h^2 + v^2) / 2) of cells whose window is full."""
    moved = spread(cells.select("row", "col", "value"))
    weight = lambda a, b: F.col(a) * F.when(F.col(b) == 0, 2.0).otherwise(1.0) / 4.0
    out = moved.groupBy("row", "col").agg(F.count("*").alias("n"), F.sum(weight("di", "dk") * F.col("value")).alias("h"), F.sum(weight("dk", "di") * F.col("value")).alias("v"))
    return out.where("n = 9").select("row", "col", F.sqrt((F.col("h") * F.col("h") + F.col("v") * F.col("v")) / 2).alias("value"))


def terrain_slope(cells: DataFrame, size: float = 30.0) -> DataFrame:
    """Slope in degrees from the differences of the four neighbours, of cells that have all four."""
    moved = spread(cells.select("row", "col", "value"), CROSS[1:])
    side = lambda i, k: F.max(F.when((F.col("di") == -i) & (F.col("dk") == -k), F.col("value")))
    out = moved.groupBy("row", "col").agg(*[side(i, k).alias(n) for (i, k), n in zip(CROSS[1:], ("up", "down", "left", "right"), strict=True)])
    out = out.join(cells.select("row", "col"), ["row", "col"], "left_semi").dropna()
    gx, gy = (F.col("right") - F.col("left")) / (2 * size), (F.col("down") - F.col("up")) / (2 * size)
    return out.select("row", "col", F.degrees(F.atan(F.sqrt(gx * gx + gy * gy))).alias("value"))


def local_maxima(cells: DataFrame, above: float, radius: int = 1) -> DataFrame:
    """Cells over a height that no cell within the radius tops."""
    offsets = [(i, k) for i in range(-radius, radius + 1) for k in range(-radius, radius + 1)]
    top = spread(cells.where(F.col("value") > above).select("row", "col", "value"), offsets).groupBy("row", "col")
    top = top.agg(F.max("value").alias("top"), F.max(F.when((F.col("di") == 0) & (F.col("dk") == 0), F.col("value"))).alias("value"))
    return top.where("value = top").select("row", "col", "value")


def components(mask: DataFrame, cols: int, diagonal: bool = False, by: str | None = None) -> DataFrame:
    """(row, col, label) of the mask's cells; an object's label is its least row * cols + col.

    Runs of cells in a row are nodes, so a wide object costs few rows; runs meet where cells of the next row touch. With by, a
    column of the mask, only cells of one value there are joined, and the result has it as the column by.
    """
    key = [F.col(by).alias("by")] if by else []
    names = ["by"] if by else []
    cells = mask.select("row", "col", *key).distinct()
    w = Window.partitionBy("row", *names).orderBy("col")
    cells = cells.withColumn("island", F.col("col") - F.row_number().over(w))
    cells = cells.withColumn("run", F.col("row") * cols + F.min("col").over(Window.partitionBy("row", *names, "island"))).drop("island")
    offsets = [(1, k) for k in ((-1, 0, 1) if diagonal else (0,))]
    below = spread(cells, offsets).select("row", "col", *names, F.col("run").alias("u"))
    edges = below.join(cells.select("row", "col", *names, F.col("run").alias("v")).hint("merge"), ["row", "col", *names]).select("u", "v")
    # bands of rows are dealt together, so that most of an object's links meet in one task; repeated ones end there
    labels = least_labels(edges.repartition(F.expr(f"u div {BAND * cols}")))
    out = cells.join(labels.hint("merge"), cells["run"] == labels["id"], "left")
    return out.select("row", "col", F.coalesce("label", "run").alias("label"), *names)


def renumbered(labels: DataFrame) -> DataFrame:
    """Labels as 1, 2, .. in their order.

    The distinct labels are cut into ranges; a label's number is its place in its range after the sizes of those before.
    """
    part = labels.select("label").distinct().repartitionByRange("label").withColumn("part", F.spark_partition_id())
    part = settled(part)
    sizes = part.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row a range
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("label"))
    numbers = part.withColumn("place", place).join(starts, "part").select("label", (F.col("start") + F.col("place")).alias("number"))
    return labels.join(numbers, "label").withColumn("label", F.col("number").cast("long")).drop("number")


def without_small(labels: DataFrame, least: int = 5) -> DataFrame:
    sizes = labels.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return labels.join(sizes.select("label"), "label", "left_semi")


def without_border(labels: DataFrame, rows: int, cols: int) -> DataFrame:
    """Objects that do not touch the raster's border."""
    edge = (F.col("row") == 0) | (F.col("row") == rows - 1) | (F.col("col") == 0) | (F.col("col") == cols - 1)
    return labels.join(labels.where(edge).select("label").distinct(), "label", "left_anti")


def without_border_or(labels: DataFrame, cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """Objects that touch neither the border nor the cross-shaped dilation of other cells."""
    near = dilate(cells, rows, cols, CROSS)
    bad = labels.join(near, ["row", "col"], "left_semi").select("label").distinct()
    return without_border(labels, rows, cols).join(bad, "label", "left_anti")


def kept_labels(labels: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every cell, with label 0 where its object is not wanted."""
    w = wanted.select(F.col("label").alias("__w")).distinct()
    return labels.join(w, F.col("label") == F.col("__w"), "left").withColumn("label", F.when(F.col("__w").isNotNull(), F.col("label")).otherwise(0)).drop("__w")


def zonal(labels: DataFrame, values: DataFrame, prefix: str = "", value: str = "value") -> DataFrame:
    """min, mean and max of the values of each object."""
    v = F.col(value)
    both = labels.join(values.select("row", "col", value), ["row", "col"])
    return both.groupBy("label").agg(F.min(v).alias(f"{prefix}min"), F.avg(v).alias(f"{prefix}mean"), F.max(v).alias(f"{prefix}max"))


def shape(labels: DataFrame) -> DataFrame:
    """Area, centroid, equivalent diameter, axes, eccentricity, orientation and perimeter (cell sides that are open).

    A covariance that differs from 0 by rounding alone counts as 0, so an object along the columns is turned by +90 degrees.
    """
    r, c = F.col("row").cast("double"), F.col("col").cast("double")
    m = labels.groupBy("label").agg(
        F.count("*").alias("area"), F.avg(r).alias("centroid_row"), F.avg(c).alias("centroid_col"),
        (F.var_pop(r) + 1 / 12).alias("rr"), (F.var_pop(c) + 1 / 12).alias("cc"), F.covar_pop(r, c).alias("rc"),
    )
    m = m.withColumn("rc", F.when(F.abs("rc") > 1e-9, F.col("rc")).otherwise(0.0))
    gap = F.sqrt(F.pow((F.col("rr") - F.col("cc")) / 2, 2) + F.col("rc") * F.col("rc"))
    m = m.withColumns({"l1": (F.col("rr") + F.col("cc")) / 2 + gap, "l2": (F.col("rr") + F.col("cc")) / 2 - gap})
    own = labels.select("row", "col", "label")
    around = spread(own, CROSS[1:]).select("row", "col", "label").groupBy("row", "col", "label").agg(F.count("*").alias("n"))
    shared = around.join(own.hint("merge"), ["row", "col", "label"]).groupBy("label").agg(F.sum("n").alias("shared"))
    out = m.join(shared.hint("merge"), "label", "left")
    return out.select(
        "label", "area", "centroid_row", "centroid_col",
        F.sqrt(F.col("area") * 4 / math.pi).alias("equivalent_diameter"),
        (4 * F.sqrt("l1")).alias("major_axis"), (4 * F.sqrt(F.greatest("l2", F.lit(0.0)))).alias("minor_axis"),
        F.sqrt(F.lit(1.0) - F.greatest(F.col("l2"), F.lit(0.0)) / F.col("l1")).alias("eccentricity"),
        (0.5 * F.atan2(2 * F.col("rc"), F.col("cc") - F.col("rr"))).alias("orientation"),
        (F.col("area") * 4 - F.coalesce("shared", F.lit(0))).cast("double").alias("perimeter"),
    )


def perimeter(labels: DataFrame) -> DataFrame:
    """(label, perimeter) by the estimator of Benkrid and Crookes: border cells count by the pattern of border cells around them.

    A border cell has a side that its object does not hold. It counts by how many border cells of its object meet its sides and
    its corners: 1 in a straight line, the root of 2 in a diagonal one, the mean of both where one turns into the other, else 0.
    """
    own = labels.select("row", "col", "label").distinct()
    here = (F.col("di") == 0) & (F.col("dk") == 0)
    seen = spread(own, CROSS).groupBy("row", "col", "label").agg(F.count("*").alias("n"), F.max(here).alias("own"))
    border = seen.where(F.col("own") & (F.col("n") < len(CROSS))).select("row", "col", "label")
    turned = (F.col("di") != 0) & (F.col("dk") != 0)
    around = spread(border).groupBy("row", "col", "label").agg(F.max(here).alias("own"), F.count_if(~here & ~turned).alias("sides"), F.count_if(turned).alias("corners"))
    weight = reduce(lambda w, p: w.when((F.col("sides") == p[0][0]) & (F.col("corners") == p[0][1]), F.lit(p[1])), BORDER_PATTERNS.items(), F)
    return around.where("own").groupBy("label").agg(F.sum(weight.otherwise(0.0)).alias("perimeter"))


def blocks(cells: DataFrame, size: int, *values: str) -> DataFrame:
    """Sums of values over square blocks; blocks at the far edges may be ragged."""
    by = [F.floor(F.col(c) / size).alias(f"block_{c}") for c in ("row", "col")]
    return cells.groupBy(*by).agg(*[F.sum(v).alias(v) for v in values])


def histogram(cells: DataFrame, bins: int = 256, value: str = "value") -> DataFrame:
    """(bin, n, centre) of equal bins between the least and the largest value; bins rows at most."""
    ends = cells.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.floor((F.col(value) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    counts = cells.crossJoin(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).alias("bin"), "lo", "hi").agg(F.count("*").alias("n"))
    grid = ends.select("lo", "hi", F.explode(F.expr(f"sequence(0L, {bins - 1}L)")).alias("bin"))
    out = grid.join(counts.select("bin", "n"), "bin", "left")
    return out.select("bin", F.coalesce("n", F.lit(0)).alias("n"), (F.col("lo") + width * (F.col("bin") + 0.5)).alias("centre"))


def otsu(cells: DataFrame, bins: int = 256) -> DataFrame:
    """threshold: the bin centre that parts the values with the largest variance between the parts."""
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    n, s = F.col("n").cast("double"), F.col("n") * F.col("centre")
    h = histogram(cells, bins).select("bin", "centre", F.sum(n).over(w).alias("n1"), F.sum(s).over(w).alias("s1"), F.sum(n).over(rest).alias("n2"), F.sum(s).over(rest).alias("s2"))
    gap = F.try_divide(F.col("s1"), F.col("n1")) - F.try_divide(F.col("s2"), F.col("n2"))
    h = h.withColumn("score", F.col("n1") * F.col("n2") * gap * gap).where("score is not null")
    return h.agg(F.max_by("centre", F.struct("score", -F.col("bin"))).alias("threshold"))


def yen(cells: DataFrame, bins: int = 256) -> DataFrame:
    """threshold by the maximum correlation criterion of the histogram."""
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    rest = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    h = histogram(cells, bins)
    h = h.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy()))
    h = h.select("bin", "centre", F.sum("p").over(w).alias("p1"), F.sum(F.col("p") * F.col("p")).over(w).alias("q1"), F.sum(F.col("p") * F.col("p")).over(rest).alias("q2"))
    inner = F.try_divide(F.pow(F.col("p1") * (1 - F.col("p1")), 2), F.col("q1") * F.col("q2"))
    h = h.withColumn("score", F.when(inner > 0, F.log(inner))).where("score is not null")
    return h.agg(F.max_by("centre", F.struct("score", -F.col("bin"))).alias("threshold"))


def two_means(values: DataFrame, by: str = "label", value: str = "value") -> DataFrame:
    """For each group, the value from which the upper of two least-squares clusters starts (null for a constant group).

    Distinct values are cut into ranges that tasks sort on their own; what lies under a value is its range's running sums after
    those of the group's ranges before. So a group of any size is spread over tasks.
    """
    v = F.col(value)
    counts = values.where(v.isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"), F.sum(v).alias("s"))
    held = settled(counts.repartitionByRange(by, value).withColumn("part", F.spark_partition_id()))
    part = held.groupBy(by, "part").agg(F.sum("n").alias("pn"), F.sum("s").alias("ps"))
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    whole = Window.partitionBy(by)
    none = lambda c: F.coalesce(c, F.lit(0))
    part = part.select(by, "part", none(F.sum("pn").over(before)).alias("n0"), none(F.sum("ps").over(before)).alias("s0"), F.sum("pn").over(whole).alias("n2"), F.sum("ps").over(whole).alias("s2"))
    up = Window.partitionBy(by, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    t = held.select(by, "part", value, none(F.sum("n").over(up)).alias("n1"), none(F.sum("s").over(up)).alias("s1")).join(part, [by, "part"])
    n1, s1 = F.col("n0") + F.col("n1"), F.col("s0") + F.col("s1")
    gain = s1 * s1 / n1 + (F.col("s2") - s1) * (F.col("s2") - s1) / (F.col("n2") - n1)
    t = t.where(n1 > 0).withColumn("gain", gain)
    return t.groupBy(by).agg(F.max_by(value, "gain").alias("threshold"))


def margins(all_cells: DataFrame, core: DataFrame, labels: DataFrame, rows: int, cols: int) -> tuple[DataFrame, DataFrame]:
    """(label_a, label_b): labels of the eroded core, and of the margin between it and the dilated whole."""
    inner = erode(core, rows, cols)
    ring = dilate(all_cells, rows, cols).join(inner, ["row", "col"], "left_anti")
    return labels.join(inner, ["row", "col"], "left_semi"), dilate_labels(labels, rows, cols).join(ring, ["row", "col"], "left_semi")


def margin_stats(label_a: DataFrame, label_b: DataFrame, proba: DataFrame, p: str = "p") -> DataFrame:
    """Area of each object's core, and the sums of its margin's probabilities of water, gain and loss."""
    core = label_a.groupBy("label").agg(F.count("*").cast("double").alias("area_water_inside"))
    ring = label_b.join(proba, ["row", "col"]).groupBy("label")
    ring = ring.agg(F.sum(F.col(p)[0]).alias("area_water_steady"), F.sum(F.col(p)[2]).alias("area_wgain"), F.sum(F.col(p)[3]).alias("area_wloss"))
    return ring.join(core, "label", "left").withColumn("area_water_inside", F.coalesce("area_water_inside", F.lit(0.0)))


def object_margins(labels: DataFrame, core: DataFrame, rows: int, cols: int) -> tuple[DataFrame, DataFrame]:
    """(inner, ring), both (row, col, label): each object's own eroded core, and its own dilation without that.

    Objects are taken one by one, so the rings of near objects may overlap.
    """
    inner = _full_windows(core.select("row", "col", "label").distinct(), rows, cols)
    outer = _inside(spread(labels.select("row", "col", "label")), rows, cols).select("row", "col", "label").distinct()
    return inner, outer.join(inner, ["row", "col", "label"], "left_anti")


def growth(inner: DataFrame, ring: DataFrame, proba: DataFrame, factor: float = 1.0, p: str = "p") -> DataFrame:
    """(label, lake_area, grow_area, shrink_area, grow_perc, shrink_perc) by the probabilities of each object's ring."""
    core = inner.groupBy("label").agg(F.count("*").alias("n"))
    sums = ring.join(proba, ["row", "col"]).groupBy("label").agg(*[(F.sum(F.col(p)[k]) * factor).alias(f"s{k}") for k in (0, 2, 3)])
    area, start = F.coalesce("n", F.lit(0)) + F.col("s0"), F.coalesce("n", F.lit(0)) + F.col("s0") + F.col("s3")
    return sums.join(core, "label", "left").select(
        "label", area.alias("lake_area"), F.col("s2").alias("grow_area"), F.col("s3").alias("shrink_area"),
        (F.try_divide("s2", start) * 100).alias("grow_perc"), (F.try_divide("s3", start) * 100).alias("shrink_perc"),
    )


def change_cells(label_a: DataFrame, label_b: DataFrame, proba: DataFrame, p: str = "p") -> DataFrame:
    """(row, col, gain, loss, stable): probable gain and loss of water on margins, and water that stays on margins and cores."""
    ring = label_b.where("label <> 0").select("row", "col").distinct().join(proba, ["row", "col"])
    ring = ring.select("row", "col", *[F.col(p)[k].alias(f"p{k}") for k in (0, 2, 3)])
    core = label_a.where("label <> 0").select("row", "col").distinct().withColumn("core", F.lit(1.0))
    held = lambda c: F.coalesce(c, F.lit(0.0))
    both = ring.join(core, ["row", "col"], "full_outer")
    return both.select("row", "col", held("p2").alias("gain"), held("p3").alias("loss"), (held("p0") + held("core")).alias("stable"))


def change_blocks(cells: DataFrame, size: int, metres: float = 30.0) -> DataFrame:
    """Eight measures of change in square blocks: hectares, hectares a square kilometre, and shares of a block in per cent."""
    hectares, km2 = metres * metres / 1e4, (size * metres / 1000) ** 2
    share = (size * metres / 100) ** 2 / 100
    start, end, net = F.col("stable") + F.col("loss"), F.col("stable") + F.col("gain"), F.col("gain") - F.col("loss")
    return blocks(cells, size, "gain", "loss", "stable").select(
        "block_row", "block_col", (net / km2 * hectares).alias("netchange"), (F.col("gain") / km2 * hectares).alias("grossgain"),
        (F.col("loss") / km2 * hectares).alias("grossloss"), (F.col("stable") * hectares).alias("waterstable"),
        (start * hectares).alias("area_start_ha"), (end * hectares).alias("area_end_ha"),
        (start / share * hectares).alias("limnicity_start"), (end / share * hectares).alias("limnicity_end"),
    )


def upper_cluster(values: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells (row, col) of each object's bounding box that lie in the upper of its two least-squares clusters."""
    box = labels.groupBy("label").agg(*[f(c).alias(f"{n}_{c}") for c in ("row", "col") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    lines = box.select("label", "lo_col", "hi_col", F.explode(F.sequence("lo_row", "hi_row")).alias("row"))
    own = values.select("row", "col", "value").join(lines, "row").where(F.col("col").between(F.col("lo_col"), F.col("hi_col")))
    own = own.select("label", "row", "col", "value")
    return own.join(two_means(own.select("label", "value")), "label").where("value >= threshold").select("row", "col").distinct()


def scattered(objects: DataFrame, labels: DataFrame, value: Column) -> DataFrame:
    """An attribute of the objects back on their cells; -9999 where it is null."""
    return labels.join(objects.select("label", value.alias("value")).hint("merge"), "label", "left").select("row", "col", F.coalesce("value", F.lit(-9999.0)).alias("value"))
