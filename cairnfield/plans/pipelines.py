"""Whole pipelines: trend images, changing objects, segments of a probability, training sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.functions import objects, projection
from cairnfield.operators import cells, flooding, scoring, series, spatial, trend
from cairnfield.operators.components import settled


def trend_image(obs: DataFrame, pixel: list[str], mode: str = "full", reference: str = "2014-07-01", months: tuple[int, int] = (7, 8), years: tuple[int, int] = (1985, 2014)) -> DataFrame:
    """Trend per decade of every pixel of obs (pixel.., date, value).

    full: over all dates, in days from the reference date; median_year: over yearly medians, in years from the
    reference year. Pixels with fewer than six observations have nulls.
    """
    held = series.dealt(series.in_season(obs, months=months, years=years), pixel)
    if mode == "full":
        points = series.mean_of_same_date(held, pixel).withColumn("x", F.datediff("date", F.lit(reference).cast("date")))
        factor = trend.PER_DECADE_DAYS
    elif mode == "median_year":
        points = series.by_bucket(held, pixel, "year", "median").withColumn("x", F.col("year") - int(reference[:4]))
        factor = trend.PER_DECADE_YEARS
    else:
        raise ValueError(f"mode is full or median_year, not {mode!r}")
    return trend.robust_trend(points, pixel, "x", "value", factor, trend.MIN_FOR_TREND)


def changing_objects(classes: DataFrame, rows: int, cols: int, period: str, least: int = 5, core_classes: tuple[int, ...] = (1,), all_classes: tuple[int, ...] = (1, 12, 21), query: str = "proba <= 0.5 and max > 0.95") -> DataFrame:
    """Objects of classes (row, col, class, p array of probabilities) with shape, water, gain, loss and change rates.

    Objects are 4-connected cells of all_classes, of `least` cells (8-connected) or more, that do not touch the border.
    proba, of which the query may speak, is 0 where no scorer has set it.
    """
    whole = classes.where(F.col("class").isin(*all_classes)).select("row", "col")
    big = cells.without_small(cells.components(whole, cols, diagonal=True), least).select("row", "col")
    core = classes.where(F.col("class").isin(*core_classes)).select("row", "col").join(big, ["row", "col"], "left_semi")
    labels = cells.without_border(cells.components(big, cols), rows, cols)
    label_a, label_b = cells.margins(big, core, labels, rows, cols)
    water = F.col("p")[0] + F.col("p")[2] + F.col("p")[3]
    stats = cells.zonal(labels, classes.withColumn("value", water))
    table = cells.shape(labels).join(cells.margin_stats(label_a, label_b, classes), "label").join(stats, "label")
    table = objects.with_shares(table).withColumn("proba", F.lit(0.0))
    table = scoring.filtered_objects(table, query)
    return objects.with_change(objects.in_degrees(objects.in_metres(objects.in_hectares(table))), period)


def segments(classes: DataFrame, rows: int, cols: int, mode: str = "simple", target: int = 14, mask_above: float = 0.3, peaks_above: float = 0.5, sigma: float = 2.0, edge_sigma: float = 0.5, distance: int = 1, tile: int = flooding.STEP) -> DataFrame:
    """(row, col, label): segments of classes (row, col, class, value), value being the probability of the class sought.

    simple: cells of the class. local_kmeans: the upper of two clusters around each smoothed object of four cells or
    more. local_threshold: cells whose local threshold is positive. local_thresh_edge: strong edges, closed and opened,
    holes filled. watershed2, watershed3, watershed: cells over mask_above, flooded from peaks of the smoothed value
    over edges, over edges with compactness 1, or down from the peaks with compactness 0.5; 0 is unreached.
    Tasks flood tiles of `tile` cells a side, which change no label.
    """
    value = classes.select("row", "col", "value")
    if mode == "simple":
        return cells.components(classes.where(F.col("class") == target), cols)
    if mode == "local_threshold":
        return cells.components(cells.local_threshold(value, 0.3).where("value > 0"), cols)
    if mode == "local_thresh_edge":
        surface = cells.local_threshold(cells.sobel(value))
        mask = surface.where(F.col("value") > (cells.yen(surface).first()[0] or 0.0))
        mask = cells.eroded(cells.dilate(mask, rows, cols, cells.CROSS), rows, cols, cells.CROSS)
        mask = cells.dilate(cells.eroded(mask, rows, cols, cells.CROSS), rows, cols, cells.CROSS)
        return cells.components(cells.without_holes(mask, rows, cols), cols)
    smooth = settled(cells.gaussian(value, sigma))
    if mode == "local_kmeans":
        labels = cells.without_small(cells.components(smooth.where(F.col("value") > mask_above), cols, diagonal=True), 4)
        return cells.components(cells.upper_cluster(smooth, labels), cols)
    if mode not in ("watershed2", "watershed3", "watershed"):
        raise ValueError(f"no mode {mode!r}")
    edges = cells.sobel(smooth if mode == "watershed2" else cells.gaussian(value, edge_sigma))
    surface = smooth.withColumn("value", -F.col("value")) if mode == "watershed" else edges
    radius = 3 if mode == "watershed2" else distance
    peaks = cells.components(settled(cells.local_maxima(smooth, peaks_above, radius)), cols, diagonal=True).withColumn("marker", F.col("label") + 1)
    held = value.where(F.col("value") > mask_above if mode == "watershed2" else F.col("value") >= mask_above).select("row", "col")
    held = held.join(surface, ["row", "col"], "left").join(peaks.select("row", "col", "marker"), ["row", "col"], "left")
    held = held.withColumn("value", F.coalesce("value", F.lit(0.0)))
    compact = {"watershed2": 0.0, "watershed3": 1.0, "watershed": 0.5}[mode]
    return flooding.watershed(held, tile, compact)


#: The layers of a trend image, in their order.
TREND_LAYERS = ("slp", "ict", "cil", "ciu")
#: Rows of layers that a task brings together, in the mean.
FEATURE_ROWS = 1 << 19


def feature_stack(images: dict[str, DataFrame], dem: DataFrame, x0: float, y0: float, size: float, zone: int | None = None) -> DataFrame:
    """(row, col, <index>_slp, _ict, _cil, _ciu for each image, dem, slope): a row of features for each cell.

    images: trend images (row, col, b array) by index name; dem: (row, col, value), whose slope is taken from cells of the
    given size. With a UTM zone, lon and lat of the cells' centres are added, the raster's corner being (x0, y0). All layers
    are dealt by cell, one row a layer or image, and meet in one aggregation of parts of bounded size; a cell that a layer lacks has null there.
    """
    names = [f"{index}_{n}" for index in images for n in TREND_LAYERS] + ["dem", "slope"]

    def wide(df: DataFrame, layers: dict) -> DataFrame:
        return df.select("row", "col", *[layers.get(n, F.lit(None)).cast("double").alias(n) for n in names])

    n = dem.count()
    total = 2 * n + sum(df.count() for df in images.values())  # slopes are as many as heights at most
    slope = cells.terrain_slope(spatial.spread_over(dem.select("row", "col", "value"), FEATURE_ROWS, F.floor(F.col("row") / cells.BAND), total=n), size)
    parts = [wide(df, {f"{index}_{n}": F.get("b", F.lit(k)) for k, n in enumerate(TREND_LAYERS)}) for index, df in images.items()]
    parts += [wide(dem, {"dem": F.col("value")}), wide(slope, {"slope": F.col("value")})]
    dealt = spatial.spread_over(reduce(DataFrame.unionByName, parts), FEATURE_ROWS, "row", "col", total=total)
    out = dealt.groupBy("row", "col").agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    if zone is None:
        return out
    lon, lat = projection.from_utm(*projection.cell_centres(F.col("row"), F.col("col"), x0, y0, size), zone)
    return out.withColumns({"lon": lon, "lat": lat})


def training_set(points: DataFrame, boxes: DataFrame, layers: dict[str, DataFrame], x0: float, y0: float, size: float, bin_size: float, zone: str) -> DataFrame:
    """Distinct points (.., x, y) that lie in exactly one box, with the layers' values at their cells and the zone's name.

    A layer that is called <index>_ciu and one that is called <index>_cil also give <index>_cirange, their difference.
    """
    found = spatial.in_boxes(points, boxes, "x", "y", bin_size)
    box = F.struct(*boxes.columns)
    held = found.groupBy(*points.columns).agg(F.min(box).alias("__box"), F.max(box).alias("__last")).where("__box = __last")
    held = held.select(*points.columns, "__box.*")
    for name, layer in layers.items():
        held = spatial.sampled(held, layer.select("row", "col", F.col("value").alias(name)), "x", "y", x0, y0, size)
    for name in [n.removesuffix("_ciu") for n in layers if n.endswith("_ciu") and n.removesuffix("u") + "l" in layers]:
        held = held.withColumn(f"{name}_cirange", F.col(f"{name}_ciu") - F.col(f"{name}_cil"))
    return held.withColumn("zone", F.lit(zone))
