"""Piecewise linear fits with one or two breaks, chosen by mean absolute error or by explained variance.

A series is one row with its points as a sorted array, so the search needs one shuffle. Least-squares lines of all series
of one length are fitted together, split by split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from cairnfield.operators.arrays import gathered, per_series

#: Digits to which two candidates' qualities are told apart; equal ones go to the first.
DIGITS = 9


def line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Fitted values of the least-squares line of each row; NaN where all x are equal."""
    dx, my = x - x.mean(1, keepdims=True), y.mean(1, keepdims=True)
    sxx = (dx * dx).sum(1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return my + (dx * (y - my)).sum(1, keepdims=True) / np.where(sxx > 0, sxx, np.nan) * dx


def quality(y: np.ndarray, fitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean absolute error, and the squared correlation of observed and fitted values (NaN if either is constant)."""
    dy, df = y - y.mean(1, keepdims=True), fitted - fitted.mean(1, keepdims=True)
    spread = (dy * dy).sum(1) * (df * df).sum(1)
    return np.abs(y - fitted).mean(1), (dy * df).sum(1) ** 2 / np.where(spread > 0, spread, np.nan)


def cuts_of(n: int, breaks: int) -> list[tuple[int, ...]]:
    """The places of the breaks of n points, in order; every part holds two points at least."""
    firsts = range(2, n - 1)
    return [(i,) for i in firsts] if breaks == 1 else [(i, j) for i in firsts for j in range(i + 2, n - 1)]


def breakpoints(obs: DataFrame, pixel: list[str], x: str = "x", y: str = "y", breaks: int = 1, predictor: str = "mae") -> DataFrame:
    """(pixel.., break_loc1, break_x1, [break_loc2, break_x2,] mae, r2, mae_linear, r2_linear).

    A break at i parts the sorted points into [:i] and [i:]; every part holds two points at least. The first of the
    best candidates wins: least mae, or largest r2. Series too short for a break get nulls for it.
    """
    if breaks not in (1, 2) or predictor not in ("mae", "r2"):
        raise ValueError(f"breaks is 1 or 2, predictor mae or r2, not {breaks!r}, {predictor!r}")
    places = {f"break_{kind}{k}": "int" if kind == "loc" else "double" for k in range(1, breaks + 1) for kind in ("loc", "x")}

    def work(xs: np.ndarray, ys: np.ndarray) -> list[np.ndarray]:
        count, n = xs.shape
        best = np.full((len(places) + 2, count), np.nan)
        score = np.full(count, np.inf)
        for cuts in cuts_of(n, breaks):
            ends = [0, *cuts, n]
            fitted = np.concatenate([line(xs[:, a:b], ys[:, a:b]) for a, b in zip(ends, ends[1:], strict=False)], 1)
            mae, r2 = quality(ys, fitted)
            own = np.round(mae if predictor == "mae" else -r2, DIGITS)
            better = own < score  # never for NaN
            score[better] = own[better]
            now = [v for c in cuts for v in (np.full(count, c), xs[:, c])] + [mae, r2]
            best[:, better] = np.stack(now)[:, better]
        return [*best, *quality(ys, line(xs, ys))]

    outputs = {**places, "mae": "double", "r2": "double", "mae_linear": "double", "r2_linear": "double"}
    return per_series(gathered(obs, pixel, x, y).where("size(p) > 0"), outputs, work, lambda n: n)
