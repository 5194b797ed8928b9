import math

import numpy as np
import pytest

from cairnfield.operators import flooding as W


def one_by_one(surface, markers, mask, compactness=0.0):
    """Labels by settling the cell with the least way of all, over and over; ways are looked for anew each time."""
    held = {tuple(map(int, v)) for v in zip(*np.nonzero(mask))}
    done = {v: (float(surface[v]), 0, int(markers[v]), *v) for v in held if markers[v]}
    while True:
        ways = []
        for v in held - set(done):
            for u in ((v[0] - 1, v[1]), (v[0] + 1, v[1]), (v[0], v[1] - 1), (v[0], v[1] + 1)):
                if u in done:
                    h, t, label, r0, c0 = done[u]
                    own = float(surface[v]) + (compactness * math.hypot(v[0] - r0, v[1] - c0) if compactness else 0)
                    ways.append((max(h, own), t + 1 if own <= h else 1, h, t, label, r0, c0, v))
        if not ways:
            return np.array([[done[r, c][2] if (r, c) in done else 0 for c in range(mask.shape[1])] for r in range(mask.shape[0])])
        h, t, _, _, label, r0, c0, v = min(ways)
        done[v] = (h, t, label, r0, c0)


def raster(seed, rows=17, cols=29, levels=6, n=7):
    rng = np.random.default_rng(seed)
    surface = rng.integers(0, levels, (rows, cols)).astype(float)
    mask = rng.random((rows, cols)) < 0.85
    markers = np.zeros((rows, cols), int)
    for k in range(1, n + 1):
        markers[rng.integers(rows), rng.integers(cols)] = k
    return surface, markers, mask


@pytest.mark.parametrize("compactness", [0.0, 0.7])
@pytest.mark.parametrize("seed", range(3))
def test_one_tile_equals_brute_force(seed, compactness):
    surface, markers, mask = raster(seed)
    assert np.array_equal(W.flood(surface, markers, mask, compactness), one_by_one(surface, markers, mask, compactness))


@pytest.mark.parametrize(("step", "compactness"), [(4, 0.0), (16, 0.0), (1024, 0.0), (16, 0.7), (5, 2.0)])
def test_labels_do_not_depend_on_tiles(spark, step, compactness):
    surface, markers, mask = raster(4)
    rows = [(int(r), int(c), float(surface[r, c]), int(markers[r, c]) or None) for r, c in zip(*np.nonzero(mask))]
    df = spark.createDataFrame(rows, "row long, col long, value double, marker long").repartition(3)
    want = one_by_one(surface, markers, mask, compactness)
    got = {(r["row"], r["col"]): r.label for r in W.watershed(df, step, compactness).collect()}
    assert got == {(r, c): want[r, c] for r, c, *_ in rows}


def test_a_way_through_many_tiles(spark):
    """A channel that winds through the raster: one marker at its end reaches all of it."""
    grid = np.zeros((17, 40), bool)
    grid[::4] = True
    for k, r in enumerate(range(2, 17, 4)):
        grid[r - 1 : r + 2, -1 if k % 2 == 0 else 0] = True
    rows = [(int(r), int(c), 0.0, 9 if (r, c) == (0, 0) else 0) for r, c in zip(*np.nonzero(grid))]
    df = spark.createDataFrame(rows, "row long, col long, value double, marker long")
    assert {r.label for r in W.watershed(df, 8).collect()} == {9}


def test_no_cells_and_no_markers(spark):
    df = spark.createDataFrame([(0, 0, 1.0, None), (-3, 700, 1.0, 5), (-3, 701, 2.0, 0)], "row long, col long, value double, marker long")
    assert {(r["row"], r["col"], r.label) for r in W.watershed(df, 8).collect()} == {(0, 0, 0), (-3, 700, 5), (-3, 701, 5)}
    assert W.watershed(df.where("row > 5")).collect() == []


@pytest.mark.parametrize(("halo", "step", "compactness"), [(1, 5, 0.7), (2, 5, 2.0), (1, 4, 0.0), (0, 8, 0.7)])
def test_labels_do_not_depend_on_the_halo(spark, monkeypatch, halo, step, compactness):
    """Ways are longer than the halo, so that tiles are flooded again from what stands beside them."""
    monkeypatch.setattr(W, "HALO", halo)
    surface, markers, mask = raster(5)
    rows = [(int(r), int(c), float(surface[r, c]), int(markers[r, c]) or None) for r, c in zip(*np.nonzero(mask))]
    df = spark.createDataFrame(rows, "row long, col long, value double, marker long").repartition(3)
    want = one_by_one(surface, markers, mask, compactness)
    got = W.watershed(df, step, compactness).collect()
    assert len(got) == len(rows) and {(r["row"], r["col"]): r.label for r in got} == {(r, c): want[r, c] for r, c, *_ in rows}


def test_tiles_whose_surroundings_agree_are_flooded_once(spark, monkeypatch):
    """Ways of a few cells over the borders of four tiles: no tile is flooded again, so few more cells than there are, are flooded."""
    surface, markers, mask = raster(6, rows=8, cols=256, n=200)
    rows = [(int(r), int(c), float(surface[r, c]), int(markers[r, c])) for r, c in zip(*np.nonzero(mask))]
    df = spark.createDataFrame(rows, "row long, col long, value double, marker long")
    flooded, given = W._flooded, []
    monkeypatch.setattr(W, "_flooded", lambda cells, *rest, **more: given.append(cells.count()) or flooded(cells, *rest, **more))
    got = {(r["row"], r["col"]): r.label for r in W.watershed(df, 64, 0.7).collect()}
    want = W.flood(surface, markers, mask, 0.7)
    assert got == {(r, c): want[r, c] for r, c, *_ in rows}
    assert sum(given) < 1.6 * len(rows)
