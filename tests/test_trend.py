import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import selection, trend
from cairnfield.operators.breakpoints import breakpoints
from cairnfield.operators.selection import PairSlopes
from cairnfield.operators.trend import Z95, robust_trend
from cairnfield.plans.pipelines import trend_image


def brute(points):
    pts = [(x, y) for x, y in points if y is not None]
    s = sorted((d - b) / (c - a) for a, b in pts for c, d in pts if c > a)
    n, nt = len(pts), len(s)
    spread = math.sqrt(n * (n - 1) * (2 * n + 5) / 18) * Z95
    lo, hi = max(int(np.rint((nt - spread) / 2)) - 1, 0), min(int(np.rint((nt + spread) / 2)), nt - 1)
    slope = float(np.median(s))
    return slope, float(np.median([y for _, y in pts]) - slope * np.median([x for x, _ in pts])), s[lo], s[hi]


def frame(spark, series):
    rows = [(k, float(x), y) for k, pts in series.items() for x, y in pts]
    return spark.createDataFrame(rows, "pixel int, x double, y double").repartition(3)


def test_trend_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    series = {k: [(int(x), None if rng.random() < 0.1 else float(rng.normal() + 0.3 * x)) for x in rng.integers(0, 40, 8 + 3 * k)] for k in range(8)}
    got = {r.pixel: r for r in robust_trend(frame(spark, series), ["pixel"]).collect()}
    for k, pts in series.items():
        want = brute(pts)
        assert (got[k].slope, got[k].intercept, got[k].ci_low, got[k].ci_high) == pytest.approx(want)
        assert got[k].ci_low <= got[k].slope <= got[k].ci_high
        assert got[k].nobs == sum(y is not None for _, y in pts)


def test_offsets_leave_the_slope(spark):
    pts = [(x, float(x * x % 7)) for x in range(12)]
    a, b = (robust_trend(frame(spark, {0: s}), ["pixel"]).first() for s in (pts, [(x, y + 100) for x, y in pts]))
    assert a.slope == pytest.approx(b.slope) and b.intercept == pytest.approx(a.intercept + 100)


def test_short_and_constant_series(spark):
    series = {0: [(1, 1.0), (2, 2.0), (3, 3.0)], 1: [(5, 1.0)] * 6, 2: [(1, None)] * 6}
    nulls = {r.pixel: r for r in robust_trend(frame(spark, series), ["pixel"]).collect()}
    zeros = {r.pixel: r for r in robust_trend(frame(spark, series), ["pixel"], fill_zero=True).collect()}
    assert all(r.slope is None and r.ci_high is None for r in nulls.values())
    assert all((r.slope, r.intercept, r.ci_low, r.ci_high) == (0, 0, 0, 0) for r in zeros.values())


def fit(x, y):
    b, a = np.polyfit(x, y, 1)
    return a + b * x


def brute_breaks(pts, breaks, predictor):
    x, y = (np.array(v, float) for v in zip(*sorted(pts)))
    n, best = len(x), None
    cuts = [(i,) for i in range(2, n - 1)] if breaks == 1 else [(i, j) for i in range(2, n - 1) for j in range(i + 2, n - 1)]
    for c in cuts:
        ends = [0, *c, n]
        f = np.concatenate([fit(x[a:b], y[a:b]) for a, b in zip(ends, ends[1:])])
        mae, r2 = np.abs(y - f).mean(), np.corrcoef(y, f)[0, 1] ** 2
        score = mae if predictor == "mae" else -r2
        if best is None or score < best[0] - 1e-12:
            best = (score, c, mae, r2)
    return best


@pytest.mark.parametrize(("breaks", "predictor"), [(1, "mae"), (1, "r2"), (2, "mae"), (2, "r2")])
def test_breaks_equal_brute_force(spark, breaks, predictor):
    rng = np.random.default_rng(8)
    series = {k: [(x, float(np.where(x < 6, x, 20 - 2 * x) + rng.normal())) for x in range(9 + k)] for k in range(4)}
    got = {r.pixel: r for r in breakpoints(frame(spark, series), ["pixel"], breaks=breaks, predictor=predictor).collect()}
    for k, pts in series.items():
        _, cuts, mae, r2 = brute_breaks(pts, breaks, predictor)
        assert tuple(got[k][f"break_loc{i + 1}"] for i in range(breaks)) == cuts
        assert (got[k].mae, got[k].r2) == pytest.approx((mae, r2))


def test_series_too_short_for_a_break(spark):
    row = breakpoints(frame(spark, {0: [(0, 1.0), (1, 2.0), (2, 4.0)]}), ["pixel"]).first()
    assert row.break_loc1 is None and row.mae is None and row.mae_linear is not None


def test_trend_image_modes(spark):
    days = spark.range(3000).select((F.col("id") % 3).alias("pixel"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    obs = days.withColumn("value", F.datediff("date", F.lit("2014-07-01").cast("date")) * 0.01)
    full = trend_image(obs, ["pixel"]).collect()
    assert len(full) == 3 and all(r.slope == pytest.approx(36.5) for r in full)
    yearly = trend_image(obs, ["pixel"], mode="median_year").collect()
    assert all(r.slope == pytest.approx(36.5, rel=0.02) for r in yearly)
    with pytest.raises(ValueError):
        trend_image(obs, ["pixel"], mode="other")


def test_inversions_equal_brute_force():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 64, 65):
        r = rng.permutation(n)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if r[i] > r[j]}
        assert selection.inversions(r) == len(want)
        assert set(zip(*(v.tolist() for v in selection.inversions(r, pairs=True)), strict=True)) == want


@pytest.mark.parametrize("case", ["smooth", "ties", "few x", "constant", "line", "steps"])
@pytest.mark.parametrize("enumerated", [5, 2000])
def test_selected_slopes_equal_all_pairs(monkeypatch, case, enumerated):
    monkeypatch.setattr(selection, "ENUMERATED", enumerated)
    monkeypatch.setattr(selection, "SAMPLED", 300)
    rng = np.random.default_rng(3)
    n = 240
    x = np.sort({"smooth": rng.normal(size=n) * 50, "few x": rng.integers(0, 3, n)}.get(case, rng.integers(0, 90, n)).astype(float))
    y = {"smooth": rng.normal(size=n) + 0.2 * x, "constant": np.full(n, 4.0), "line": 0.25 * x - 7, "steps": np.floor(x / 30)}.get(case, rng.integers(0, 5, n).astype(float))
    slopes, pairs = trend.pair_slopes(x[None], y[None])
    some = PairSlopes(x, y)
    assert some.pairs == pairs[0]
    ranks = [0, 1, pairs[0] // 3, (pairs[0] - 1) // 2, pairs[0] // 2, pairs[0] - 2, pairs[0] - 1]
    assert some.ranked(ranks) == pytest.approx(slopes[0, ranks], rel=1e-11, abs=1e-13)


def test_long_series_go_through_selection(spark, monkeypatch):
    rng = np.random.default_rng(5)
    series = {k: [(int(x), float(rng.normal() + 0.3 * x)) for x in rng.integers(0, 400, 150 + k)] for k in range(3)}
    whole = {r.pixel: tuple(r) for r in robust_trend(frame(spark, series), ["pixel"]).collect()}
    x, y = (np.array(v, float) for v in zip(*sorted(series[0]), strict=True))
    assert trend.selected(x, y) == pytest.approx((whole[0][2], whole[0][4], whole[0][5]))
    monkeypatch.setattr(trend, "MAX_POINTS", 10)
    assert {k: pytest.approx(v) for k, v in whole.items()} == {r.pixel: tuple(r) for r in robust_trend(frame(spark, series), ["pixel"]).collect()}
    assert np.isnan(trend.selected(np.ones(9), np.arange(9.0))).all()


def test_a_hundred_thousand_observations_take_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(6)
    n = 100_000
    x = np.arange(n, dtype=float)
    y = 0.5 * x + rng.normal(size=n) * 1000
    tracemalloc.start()
    slope, low, high = trend.selected(x, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert low < slope < high and abs(slope - 0.5) < 0.01 and peak < 500 << 20
    some = PairSlopes(x, y)
    middle = some.below(slope)
    assert abs(middle - some.pairs / 2) <= 2  # as many slopes under it as over it
