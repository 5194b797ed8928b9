import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.functions import projection
from cairnfield.operators import cells, warp


def zone_grid(rows=300, cols=400, zone=8, size=30.0):
    return warp.Grid(500000.0, 7000000.0, size, rows, cols, zone)


def test_places_are_within_the_bound(spark):
    source = zone_grid()
    target = warp.covering(source, 9, 45.0)
    near = warp.places(spark, source, target, 0.05, nearest=False).toPandas()
    v, u = warp.exact(near.r.to_numpy(), near.c.to_numpy(), source, target)
    assert len(near) == len(near.drop_duplicates(["r", "c"])) > 300 * 400 / 2.25
    assert max(abs(v - near.v).max(), abs(u - near.u).max()) <= 0.05


def test_tiles_are_split_by_the_bound():
    source = warp.Grid(-141.0, 64.0, 0.05, 100, 220)
    target = warp.covering(source, 8, 5000.0)
    sides, single = [], []
    for bound in (100.0, 0.1, 1e-9):
        found = list(warp.tiles(0, 0, source, target, bound))
        sides.append(max(t[2] for t in found))
        single.append(sum(t[3] is None for t in found))
        for t in found:
            _, _, v, u = warp.tile_places(*t, source, target, bound, False)
            r, c, *there = warp.tile_places(*t[:3], None, source, target, bound, False)
            assert max(abs(v - there[0]).max(), abs(u - there[1]).max()) <= bound
    assert sides[0] > sides[1] > sides[2] and single[0] == 0 < single[2]


@pytest.mark.parametrize("bound", [0.3, 0.001])
def test_nearest_is_exact_for_every_bound(spark, bound):
    source = zone_grid(40, 50)
    target = warp.covering(source, 9, 30.0)
    values = spark.range(40 * 50).select(F.expr("id div 50").alias("row"), (F.col("id") % 50).alias("col"), F.col("id").cast("double").alias("value"))
    got = {(r.row, r.col): r.value for r in warp.warped(values, source, target, bound=bound).collect()}
    r, c = (g.ravel() for g in np.mgrid[: target.rows, : target.cols])
    v, u = warp.exact(r, c, source, target)
    want = {(int(r[k]), int(c[k])): 50.0 * math.floor(v[k] + 0.5) + math.floor(u[k] + 0.5) for k in np.flatnonzero((v >= -0.5) & (v < 39.5) & (u >= -0.5) & (u < 49.5))}
    assert got == want and len(want) > 1900


def test_smooth_values_survive_bilinear_warps(spark):
    source = zone_grid(60, 60)
    target = warp.covering(source, 9, 30.0)
    values = spark.range(3600).select(F.expr("id div 60").alias("row"), (F.col("id") % 60).alias("col"), (F.expr("id div 60") * 2.0 + F.col("id") % 60).alias("value"))
    got = warp.warped(values, source, target, "bilinear", 0.01).toPandas()
    v, u = warp.exact(got.row.to_numpy(), got.col.to_numpy(), source, target)
    inside = (v > 0) & (v < 58) & (u > 0) & (u < 58)
    assert inside.sum() > 3000 and abs(got.value - 2 * v - u)[inside].max() <= 0.031


def test_arrays_are_projected_as_columns_are(spark):
    df = spark.range(200).select((F.lit(-141.0) + F.col("id") * 0.06).alias("lon"), (F.lit(55.0) + F.col("id") * 0.09).alias("lat"))
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), 8)
    got = df.select("lon", "lat", x.alias("x"), y.alias("y")).toPandas()
    there = projection.to_utm(got.lon.to_numpy(), got.lat.to_numpy(), 8, ops=np)
    back = projection.from_utm(*there, 8, ops=np)
    assert abs(there[0] - got.x).max() < 1e-6 and abs(there[1] - got.y).max() < 1e-6
    assert abs(back[0] - got.lon).max() < 1e-8 and abs(back[1] - got.lat).max() < 1e-8


def test_empty_and_null_values(spark):
    source = zone_grid(20, 20)
    target = warp.covering(source, 9, 30.0)
    none = spark.createDataFrame([(3, 3, None)], "row long, col long, value double")
    assert warp.warped(none, source, target).count() == 0
    far = warp.Grid(0.0, 1000000.0, 30.0, 300, 300, 20)
    assert warp.places(spark, source, far).count() == 0
    assert warp.warped(none, warp.Grid(0.0, 0.0, 30.0, 0, 0, 8), target).count() == 0


def codes(image):
    """Lengths of border cells by the published table of codes: 1 for itself, 2 a side, 10 a corner."""
    high, wide = image.shape
    at = lambda m, r, c: 0 <= r < high and 0 <= c < wide and m[r, c]
    edge = np.array([[bool(image[r, c]) and not all(at(image, r + i, c + k) for i, k in cells.CROSS) for c in range(wide)] for r in range(high)])
    worth = dict.fromkeys((5, 7, 15, 17, 25, 27), 1.0) | dict.fromkeys((21, 33), math.sqrt(2)) | dict.fromkeys((13, 23), (1 + math.sqrt(2)) / 2)
    total = 0.0
    for r, c in zip(*np.nonzero(edge), strict=True):
        code = sum((1 if i == k == 0 else 10 if i and k else 2) for i, k in cells.SQUARE if at(edge, r + i, c + k))
        total += worth.get(code, 0.0)
    return total


def test_perimeter(spark):
    rng = np.random.default_rng(5)
    disc = np.hypot(*np.mgrid[-9:10, -9:10]) <= 8.5
    images = [np.ones((3, 6), bool), np.ones((1, 1), bool), disc, rng.random((25, 30)) < 0.7]
    rows = [(k, int(r) + 100 * k, int(c)) for k, m in enumerate(images) for r, c in zip(*np.nonzero(m), strict=True)]
    df = spark.createDataFrame(rows + rows[:4], "label long, row long, col long")
    got = {r.label: r.perimeter for r in cells.perimeter(df).collect()}
    assert got == pytest.approx({k: codes(m) for k, m in enumerate(images)})
    assert got[0] == 14.0 and abs(got[2] - 2 * math.pi * 8.5) < 4
    assert cells.perimeter(df.limit(0)).count() == 0
