"""Filters and aggregates of observation series: (pixel.., date, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.spatial import spread_over

#: Observations that a task groups, in the mean.
ROWS = 1 << 19
BUCKETS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def in_season(obs: DataFrame, date: str = "date", months: tuple[int, int] = (7, 8), years: tuple[int, int] = (1985, 2017)) -> DataFrame:
    """Rows whose month and year lie in the given ranges, ends included."""
    d = F.col(date)
    return obs.where(F.month(d).between(*months) & F.year(d).between(*years))


def dealt(obs: DataFrame, pixel: list[str]) -> DataFrame:
    """obs with all of a pixel's rows in one task, some ROWS rows in each: what is then grouped by pixel and date, and by pixel, moves no more."""
    return spread_over(obs, ROWS, *pixel)


def mean_of_same_date(obs: DataFrame, pixel: list[str], date: str = "date", value: str = "value") -> DataFrame:
    """One row a date: the mean of its values that are not null."""
    return obs.groupBy(*pixel, date).agg(F.avg(value).alias(value))


def by_bucket(obs: DataFrame, pixel: list[str], bucket: str, how: str, date: str = "date", value: str = "value") -> DataFrame:
    """median, mean, max or min of the values that are not null in each calendar year, month or day."""
    how_to = {"median": F.percentile(value, 0.5), "mean": F.avg(value), "max": F.max(value), "min": F.min(value)}
    return obs.groupBy(*pixel, BUCKETS[bucket](date).alias(bucket)).agg(how_to[how].alias(value))


def valid_dates(obs: DataFrame, pixel: list[str], date: str = "date", value: str = "value") -> DataFrame:
    """Number of dates with a value that is not null."""
    return obs.groupBy(*pixel).agg(F.countDistinct(F.when(F.col(value).isNotNull(), F.col(date))).alias("n_dates"))


def valid_observations(obs: DataFrame, pixel: list[str], value: str = "value") -> DataFrame:
    return obs.groupBy(*pixel).agg(F.count(value).alias("nobs"))


def pairs_aggregated(obs: DataFrame, number: str, temperature: str, precipitation: str) -> DataFrame:
    """Mean of every two temperatures (in °C) and sum of every two precipitations (as a month's total)."""
    pair = F.floor(F.col(number) / 2).alias("pair")
    return obs.groupBy(pair).agg((F.avg(temperature) - 273.15).alias("t2m"), (F.sum(precipitation) * 30 * 10000).alias("tp"))


def at_point(obs: DataFrame, x: float, y: float, x0: float, y0: float, size: float) -> DataFrame:
    """The series of the cell (row, col) that holds a place, for a raster with its upper left corner at (x0, y0)."""
    return obs.where((F.col("col") == int((x - x0) // size)) & (F.col("row") == int((y0 - y) // size)))
