import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import cells, scoring
from cairnfield.plans.pipelines import changing_objects, segments

ROWS, COLS = 14, 17


def frame(spark, grid):
    rows = [(int(r), int(c), float(grid[r, c])) for r, c in np.ndindex(grid.shape) if not np.isnan(grid[r, c])]
    return spark.createDataFrame(rows, "row long, col long, value double").repartition(3)


def places(df):
    return {(r["row"], r["col"]) for r in df.collect()}


@pytest.fixture(scope="module")
def noise():
    return np.random.default_rng(12).random((ROWS, COLS))


def windows(m, pad):
    p = np.pad(m, 1, constant_values=pad)
    return np.stack([p[i : i + m.shape[0], k : k + m.shape[1]] for i in range(3) for k in range(3)])


def label(m, diagonal):
    out, near = np.full(m.shape, -1), [(i, k) for i in (-1, 0, 1) for k in (-1, 0, 1) if (i or k) and (diagonal or not (i and k))]
    for start in zip(*np.nonzero(m)):
        if out[start] < 0:
            todo = [start]
            out[start] = start[0] * m.shape[1] + start[1]
            while todo:
                r, c = todo.pop()
                for i, k in near:
                    a = (r + i, c + k)
                    if 0 <= a[0] < m.shape[0] and 0 <= a[1] < m.shape[1] and m[a] and out[a] < 0:
                        out[a] = out[start]
                        todo.append(a)
    return out


def test_morphology(spark, noise):
    m = noise > 0.35
    df = frame(spark, np.where(m, noise, np.nan))
    assert places(cells.dilate(df, ROWS, COLS)) == set(zip(*np.nonzero(windows(m, False).any(0))))
    assert places(cells.erode(df, ROWS, COLS)) == set(zip(*np.nonzero(windows(m, True).all(0))))
    assert places(cells.opening(df, ROWS, COLS)) <= places(df) <= places(cells.closing(df, ROWS, COLS))


@pytest.mark.parametrize("diagonal", [False, True])
def test_objects(spark, noise, diagonal):
    m = noise > 0.55
    want = label(m, diagonal)
    df = cells.components(frame(spark, np.where(m, noise, np.nan)), COLS, diagonal)
    got = {(r["row"], r["col"]): r.label for r in df.collect()}
    assert got == {(r, c): want[r, c] for r, c in zip(*np.nonzero(m))}
    big = {x for x in np.unique(want[m]) if (want == x).sum() >= 3}
    assert {r.label for r in cells.without_small(df, 3).collect()} == big
    edge = set(np.concatenate([want[0], want[-1], want[:, 0], want[:, -1]]))
    assert {r.label for r in cells.without_border(df, ROWS, COLS).collect()} == set(np.unique(want[m])) - edge
    order = {x: k for k, x in enumerate(np.unique(want[m]), 1)}
    numbers = {(r["row"], r["col"]): r.label for r in cells.renumbered(df).collect()}
    assert numbers == {(r, c): order[want[r, c]] for r, c in zip(*np.nonzero(m))}


def test_no_cells(spark):
    empty = spark.createDataFrame([], "row long, col long, value double")
    assert cells.components(empty, COLS).count() == 0 and cells.erode(empty, 3, 3).count() == 0


def test_focal_filters(spark, noise):
    got = {(r["row"], r["col"]): r.value for r in cells.sobel(frame(spark, noise)).collect()}
    k = np.array([[1, 2, 1], [0, 0, 0], [-1, -2, -1]]) / 4
    for r, c in got:
        w = noise[r - 1 : r + 2, c - 1 : c + 2]
        assert got[r, c] == pytest.approx(np.sqrt(((w * k).sum() ** 2 + (w * k.T).sum() ** 2) / 2))
    assert len(got) == (ROWS - 2) * (COLS - 2)
    flat = cells.gaussian(frame(spark, np.full((ROWS, COLS), 3.5)), 1.5).collect()
    assert len(flat) == ROWS * COLS and all(r.value == pytest.approx(3.5) for r in flat)


def test_thresholds_part_two_humps(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, 110), rng.normal(20, 1, 128)]).reshape(ROWS, COLS)
    for find in (cells.otsu, cells.yen):
        assert -4 < find(frame(spark, v)).first().threshold < 20
    parted = frame(spark, v).withColumn("label", F.lit(1))
    assert 10 < cells.two_means(parted).first().threshold < 20


def test_shape_of_a_rectangle(spark):
    grid = np.full((ROWS, COLS), np.nan)
    grid[2:5, 3:9] = 1
    labels = cells.components(frame(spark, grid), COLS)
    s = cells.shape(labels).first()
    assert (s.area, s.perimeter, s.centroid_row, s.centroid_col) == (18, 18.0, 3.0, 5.5)
    assert s.major_axis == pytest.approx(4 * np.sqrt(6 * 6 / 12)) and s.minor_axis == pytest.approx(4 * np.sqrt(3 * 3 / 12))
    assert s.orientation == pytest.approx(0.0)
    c = scoring.solidity(labels).first()
    assert (c.area, c.convex_area, c.solidity) == (18, 18.0, 1.0)
    assert (c.hull_row, c.hull_col) == (pytest.approx(3.0), pytest.approx(5.5))
    # three cells: a square of 2 x 2 that lacks the triangle between (-1/2, 1/2), (-1/2, 3/2) and (1/2, 3/2)
    area, row, col = scoring.hull(np.array([0, 1, 1]), np.array([0, 0, 1]))
    assert area == pytest.approx(3.5)
    assert row == pytest.approx((4 * 0.5 - 0.5 * (-1 / 6)) / 3.5) and col == pytest.approx((4 * 0.5 - 0.5 * (7 / 6)) / 3.5)


def test_margins(spark):
    grid = np.full((ROWS, COLS), np.nan)
    grid[3:8, 3:8] = 1
    df = frame(spark, grid)
    labels = cells.components(df, COLS)
    a, b = cells.margins(df, df, labels, ROWS, COLS)
    assert places(a) == {(r, c) for r in range(4, 7) for c in range(4, 7)}
    assert len(places(b)) == 49 - 9
    p = df.select("row", "col").withColumn("p", F.array(*[F.lit(x) for x in (0.25, 0.0, 0.5, 0.25)]))
    row = cells.margin_stats(a, b, p).first()
    assert (row.area_water_inside, row.area_water_steady, row.area_wgain, row.area_wloss) == (9.0, 4.0, 8.0, 4.0)


def test_flooding(spark):
    surface = np.array([[0, 1, 5, 1, 0]] * 3, float)
    rows = [(1, r, c, float(surface[r, c]), 1 if (r, c) == (1, 0) else 2 if (r, c) == (1, 4) else None) for r, c in np.ndindex(surface.shape)]
    got = scoring.watershed(spark.createDataFrame(rows, "tile long, row long, col long, value double, marker long")).collect()
    by = {(r["row"], r["col"]): r.label for r in got}
    assert all(by[r, 0] == by[r, 1] == 1 and by[r, 3] == by[r, 4] == 2 for r in range(3))


def test_scores_of_missing_features(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None)], "id int, a double, b double")
    got = {r.id: r for r in scoring.classified(df, ["a", "b"], [1, 12], lambda x: np.column_stack([x[:, 0], 1 - x[:, 0]])).collect()}
    assert (got[1]["class"], got[1].confidence) == (1, 1.0) and got[2]["class"] is None and got[2].confidence is None


def test_changing_objects(spark):
    grid = np.zeros((20, 20), int)
    grid[4:10, 4:10], grid[10, 4:10] = 1, 12
    rows = [(r, c, int(grid[r, c]), [0.9, 0.0, 0.1, 0.0] if grid[r, c] == 1 else [0.1, 0.0, 0.9, 0.0] if grid[r, c] else [0.0, 1.0, 0.0, 0.0]) for r, c in np.ndindex(grid.shape)]
    classes = spark.createDataFrame(rows, "row long, col long, class int, p array<double>")
    got = changing_objects(classes, 20, 20, "2000-2020").collect()
    assert len(got) == 1 and got[0].area == pytest.approx(42 * 0.09)
    assert got[0].netchange_ha > 0 and got[0].changerate_net == pytest.approx(got[0].netchange_ha * 1e4 / got[0].perimeter / 20)


def test_compact_flooding_parts_halfway():
    surface, markers = np.zeros((1, 7)), np.zeros((1, 7), int)
    markers[0, 0], markers[0, 6] = 1, 2
    got = scoring.flood(surface, markers, np.ones((1, 7), bool), compactness=1.0)[0]
    assert list(got[:3]) == [1, 1, 1] and list(got[4:]) == [2, 2, 2]


def test_holes(spark, noise):
    m = noise > 0.35
    gaps = label(~m, False)
    want = m | np.isin(gaps, [x for x in np.unique(gaps[~m]) if (gaps == x).sum() < 4])
    assert places(cells.without_holes(frame(spark, np.where(m, noise, np.nan)), ROWS, COLS, 4)) == set(zip(*np.nonzero(want)))


@pytest.mark.parametrize("mode", ["simple", "local_kmeans", "local_threshold", "local_thresh_edge", "watershed2", "watershed3", "watershed"])
def test_segments_part_two_humps(spark, mode):
    r, c = np.mgrid[0:24, 0:40]
    hump = lambda a, b: np.exp(-((r - a) ** 2 + (c - b) ** 2) / 18)
    grid = np.maximum(hump(12, 10), hump(12, 28))
    classes = frame(spark, grid).withColumn("class", F.when(F.col("value") > 0.5, 14).otherwise(1))
    got = {(x["row"], x["col"]): x.label for x in segments(classes, 24, 40, mode, sigma=1.0).collect()}
    if mode != "local_thresh_edge":  # whose segments are the humps' rims
        assert got[12, 10] and got[12, 28] and got[12, 10] != got[12, 28] and got[11, 11] == got[12, 10]
    assert 0 < len(got) < grid.size


@pytest.mark.parametrize("mode", ["local_kmeans", "watershed"])
def test_segments_smooth_their_cells_once(spark, noise, mode):
    """Cells are read for the smoothed values and, to flood them, for the mask; not again for each use of the smoothed values."""
    reads = spark.sparkContext.accumulator(0)
    read = F.udf(lambda v: reads.add(1) or v, "double")
    classes = frame(spark, noise).withColumn("class", F.lit(0)).withColumn("value", read("value"))
    segments(classes, ROWS, COLS, mode, mask_above=0.3, peaks_above=0.4, sigma=1.0).collect()
    assert noise.size <= reads.value <= (2 if mode == "watershed" else 1) * noise.size


def test_segments_know_their_modes(spark, noise):
    with pytest.raises(ValueError):
        segments(frame(spark, noise), ROWS, COLS, "none")


def test_one_large_object_is_spread_over_tasks(spark):
    """Two clusters of one label: the threshold is that of a plain scan, and no task holds most of its values."""
    rng = np.random.default_rng(8)
    v = np.round(np.concatenate([rng.normal(0, 1, 3000), rng.normal(6, 1, 2000)]), 3)
    rows = [(1, float(x)) for x in v] + [(2, 5.0)] * 40 + [(3, 1.0), (3, 9.0), (4, None)]
    df = spark.createDataFrame(rows, "label long, value double").repartition(4)
    s = np.sort(v)
    n1 = np.flatnonzero(s[1:] > s[:-1]) + 1
    s1 = np.cumsum(s)[n1 - 1]
    gain = s1**2 / n1 + (s.sum() - s1) ** 2 / (len(s) - n1)
    for joined in ("true", "false"):  # small ranges are joined to one task's, or not
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
        try:
            got = {r.label: r.threshold for r in cells.two_means(df).collect()}
            held = df.groupBy("label", "value").count().repartitionByRange("label", "value").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert got[1] == s[n1[gain.argmax()]] and got[3] == 9.0
        assert got.get(2) is None and got.get(4) is None
    assert max(r["count"] for r in held) < 0.5 * len(set(v))
