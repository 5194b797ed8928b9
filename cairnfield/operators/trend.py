"""Robust trends: the median of the slopes of all pairs, with rank-based confidence bounds.

All pairs of a series are made inside one row, as a matrix for series of one length, so a series costs one shuffle of its
own points and no self-join. Their number is half the square of the series' length; of series longer than MAX_POINTS the wanted
ranks are selected by counting, without all pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.arrays import gathered, per_series
from cairnfield.operators.selection import PairSlopes

#: The two-sided 95 % quantile of the normal distribution.
Z95 = 1.959963984540054
PER_DECADE_DAYS = 3650.0
PER_DECADE_YEARS = 10.0
MIN_OBSERVATIONS = 4
MIN_FOR_TREND = 6
#: Observations of a series whose pairs are all made: 8 million pairs, some 200 MB in a task.
MAX_POINTS = 4000


def pair_slopes(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slopes of all pairs of different x of each row, sorted, NaN at the end; their number). x rises along rows."""
    first, second = np.triu_indices(x.shape[1], 1)
    gap = x[:, second] - x[:, first]
    with np.errstate(invalid="ignore", divide="ignore"):
        slopes = np.where(gap > 0, (y[:, second] - y[:, first]) / gap, np.nan)
    slopes.sort(1)
    return slopes, (gap > 0).sum(1)


def rank_bounds(n: int, pairs: np.ndarray, z: float = Z95) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (from 0) of the lower and upper bound among the sorted slopes; halves round to even."""
    spread = np.sqrt(n * (n - 1) * (2 * n + 5) / 18.0) * z
    low, high = np.maximum(np.rint((pairs - spread) / 2) - 1, 0), np.minimum(np.rint((pairs + spread) / 2), pairs - 1)
    return low.astype(int), high.astype(int)


def selected(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(median slope, lower and upper bound) of one long series; NaN without two different x."""
    slopes = PairSlopes(x, y)
    if not slopes.pairs:
        return np.nan, np.nan, np.nan
    low, high = (int(r[0]) for r in rank_bounds(len(x), np.array([slopes.pairs])))
    a, b, c, d = slopes.ranked([(slopes.pairs - 1) // 2, slopes.pairs // 2, min(low, slopes.pairs - 1), max(high, 0)])
    return (a + b) / 2, c, d


def robust_trend(obs: DataFrame, pixel: list[str], x: str = "x", y: str = "y", factor: float = 1.0, least: int = MIN_OBSERVATIONS, fill_zero: bool = False) -> DataFrame:
    """(pixel.., nobs, slope, intercept, ci_low, ci_high), slope and bounds times factor.

    Pixels with fewer than `least` observations, or without two different x, get nulls, or zeros with fill_zero.
    """

    def work(xs: np.ndarray, ys: np.ndarray) -> list[np.ndarray]:
        count, n = xs.shape
        if n < max(least, 2):
            return [np.full(count, np.nan)] * 4
        if n > MAX_POINTS:
            slope, *bounds = np.array([selected(x, y) for x, y in zip(xs, ys, strict=True)]).T
            return [slope * factor, np.median(ys, 1) - slope * np.median(xs, 1), *(b * factor for b in bounds)]
        slopes, pairs = pair_slopes(xs, ys)
        rows, last = np.arange(count), np.maximum(pairs - 1, 0)
        low, high = rank_bounds(n, pairs)
        slope = (slopes[rows, last // 2] + slopes[rows, np.minimum(pairs // 2, last)]) / 2
        bounds = [slopes[rows, np.minimum(low, last)], slopes[rows, np.maximum(high, 0)]]
        return [slope * factor, np.median(ys, 1) - slope * np.median(xs, 1), *(b * factor for b in bounds)]

    series = gathered(obs, pixel, x, y).withColumn("nobs", F.size("p"))
    out = per_series(series, dict.fromkeys(("slope", "intercept", "ci_low", "ci_high"), "double"), work, lambda n: n * n // 2 if n <= MAX_POINTS else n)
    return out.na.fill(0.0, ["slope", "intercept", "ci_low", "ci_high"]) if fill_zero else out


def pairwise_median_slope(obs: DataFrame, pixel: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """The median slope alone, of pairs of values that are neither null nor 0."""
    kept = obs.where(F.col(y).isNotNull() & (F.col(y) != 0))
    out = robust_trend(kept, pixel, x, y, least=2)
    return out.select(*pixel, "slope")
