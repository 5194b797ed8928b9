"""Derived measures of objects: areas, change, rates, and the summary of a region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HECTARES = 0.09
METRES = 30.0
AREAS = ("area", "convex_area", "area_water_steady", "area_wgain", "area_wloss", "area_water_inside", "area_water", "area_total", "area_budget")
LENGTHS = ("equivalent_diameter", "perimeter")


def with_shares(df: DataFrame) -> DataFrame:
    """Adds water, total (nulls count as 0), budget and the three shares of the total."""
    df = df.withColumn("area_water", F.col("area_water_inside") + F.col("area_water_steady"))
    parts = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("area_water", "area_wloss", "area_wgain")]
    df = df.withColumns({"area_total": parts[0] + parts[1] + parts[2], "area_budget": F.col("area_wgain") - F.col("area_wloss")})
    share = lambda c: F.try_divide(F.col(c), F.col("area_total"))
    return df.withColumns({"perc_water": share("area_water"), "perc_wloss": share("area_wloss"), "perc_wgain": share("area_wgain")})


def in_hectares(df: DataFrame, factor: float = HECTARES) -> DataFrame:
    return df.withColumns({c: F.col(c) * factor for c in AREAS if c in df.columns})


def in_metres(df: DataFrame, factor: float = METRES) -> DataFrame:
    return df.withColumns({c: F.col(c) * factor for c in LENGTHS if c in df.columns})


def in_degrees(df: DataFrame) -> DataFrame:
    return df.withColumn("orientation", F.lit(90.0) - F.degrees("orientation"))


def with_change(df: DataFrame, period: str) -> DataFrame:
    """Start and end area, net and gross change, and rates in metres of shore a year, for a period such as '2000-2020'."""
    start, end = (int(x) for x in period.split("-"))
    years = float(end - start)
    a = F.col("area_water") + F.col("area_wloss")
    b = F.col("area_water") + F.col("area_wgain")
    df = df.withColumns({"area_start_ha": a, "area_end_ha": b, "stablewater_ha": F.col("area_water"), "grossincrease_ha": F.col("area_wgain"), "grossdecrease_ha": F.col("area_wloss")})
    percent = lambda x, y: F.try_divide(F.col(x), F.col(y)) * 100
    df = df.withColumn("netchange_ha", F.col("area_end_ha") - F.col("area_start_ha"))
    return df.withColumns(
        {
            "netchange_perc": (F.try_divide(F.col("area_end_ha"), F.col("area_start_ha")) - 1) * 100,
            "grossincrease_perc": percent("grossincrease_ha", "area_start_ha"),
            "grossdecrease_perc": percent("grossdecrease_ha", "area_end_ha"),
            "changerate_net": F.try_divide(F.col("netchange_ha") * 1e4, F.col("perimeter")) / years,
            "changerate_growth": F.try_divide(F.col("grossincrease_ha") * 1e4, F.col("perimeter")) / years,
        }
    )


def region_summary(df: DataFrame, *by: str) -> DataFrame:
    """The measures of a region (or of each group of `by`) in one aggregation."""
    a, b, s = F.col("area_start_ha"), F.col("area_end_ha"), F.col("stablewater_ha")
    total = lambda c: F.sum(c)
    parts = s + F.col("grossdecrease_ha") + F.col("grossincrease_ha")
    n = F.count("*")
    four_up, four_down = F.count_if(F.try_divide(b, a) > 4), F.count_if(F.try_divide(a, b) > 4)
    return df.groupBy(*by).agg(
        ((F.try_divide(total("area_end_ha"), total("area_start_ha")) - 1) * 100).alias("net_change_perc"),
        total("netchange_ha").alias("net_change_ha"),
        total("area_start_ha").alias("water_t0_ha"),
        total("area_end_ha").alias("water_t1_ha"),
        total("grossincrease_ha").alias("gross_increase_ha"),
        (F.try_divide(total("grossincrease_ha"), total("area_start_ha")) * 100).alias("gross_increase_perc"),
        total("grossdecrease_ha").alias("gross_decrease_ha"),
        (F.try_divide(total("grossdecrease_ha"), total("area_end_ha")) * 100).alias("gross_decrease_perc"),
        total("stablewater_ha").alias("stable_ha"),
        n.alias("n_objects"),
        F.avg(a).alias("mean_t0"),
        F.avg(b).alias("mean_t1"),
        F.percentile(a, 0.5).alias("median_t0"),
        F.percentile(b, 0.5).alias("median_t1"),
        F.max(a).alias("max_t0"),
        F.max(b).alias("max_t1"),
        four_up.alias("n_quadrupled"),
        (four_up / n * 100).alias("quadrupled_perc"),
        four_down.alias("n_quartered"),
        (four_down / n * 100).alias("quartered_perc"),
        F.count_if(F.try_divide(s, parts) * 100 > 95).alias("n_stable"),
    )


def total_change(df: DataFrame) -> DataFrame:
    """Total of water and gain over total of water and loss, less 1."""
    return df.agg((F.try_divide(F.sum(F.col("area_water") + F.col("area_wgain")), F.sum(F.col("area_water") + F.col("area_wloss"))) - 1).alias("total_change"))
