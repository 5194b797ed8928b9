"""Queries by name, each with SQL that gives the same rows where SQL can express it.

The driver tables stand in for rasters: parts of `lineitem` are pixels observed on ship dates; the components of
`embeddings` are bands of a scene, or a raster of one row a vector.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions import objects, projection, scene_names, spectral
from cairnfield.operators import breakpoints as bp
from cairnfield.operators import cells, outlines, scoring, series, spatial, trend, warp
from cairnfield.operators.components import shared_folder
from cairnfield.plans import pipelines
from cairnfield.sources import features, manifest, rasters, sinks, text, tiff
from cairnfield.streaming.ingest import run_once
from cairnfield.streaming.mosaic import Mosaic

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COLS = 64
EPOCH = "1970-01-01"


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- observation series -------------------------------------------------------------------------------------------

OBS_SQL = "SELECT l_partkey AS pixel, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS value FROM lineitem"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    return d.select(F.col("l_partkey").alias("pixel"), F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("value"))


def with_gaps(obs: DataFrame) -> DataFrame:
    """Every seventh value (by whole cents) is missing."""
    return obs.withColumn("value", F.when(F.pmod(F.round(F.col("value") * 100).cast("long"), F.lit(7)) != 0, F.col("value")))


GAPS_SQL = f"SELECT pixel, date, CASE WHEN CAST(round(value * 100) AS BIGINT) % 7 <> 0 THEN value END AS value FROM ({OBS_SQL})"


@query("obs_date_filter", f"SELECT pixel, CAST(date AS VARCHAR) AS date, value FROM ({OBS_SQL}) WHERE month(date) BETWEEN 7 AND 8 AND year(date) BETWEEN 1996 AND 1999")
def obs_date_filter(spark, sf_dir):
    return series.in_season(observations(spark, sf_dir), months=(7, 8), years=(1996, 1999)).withColumn("date", F.col("date").cast("string"))


@query("obs_dedup_mean", f"SELECT pixel, CAST(date AS VARCHAR) AS date, round(avg(value), 6) AS value FROM ({GAPS_SQL}) GROUP BY ALL")
def obs_dedup_mean(spark, sf_dir):
    return series.mean_of_same_date(with_gaps(observations(spark, sf_dir)), ["pixel"]).select("pixel", F.col("date").cast("string"), F.round("value", 6).alias("value"))


@query("nobs_distinct_dates", f"SELECT pixel, count(DISTINCT CASE WHEN value IS NOT NULL THEN date END) AS n_dates FROM ({GAPS_SQL}) GROUP BY pixel")
def nobs_distinct_dates(spark, sf_dir):
    return series.valid_dates(with_gaps(observations(spark, sf_dir)), ["pixel"])


@query("nobs_full", f"SELECT pixel, count(value) AS nobs FROM ({GAPS_SQL}) GROUP BY pixel")
def nobs_full(spark, sf_dir):
    return series.valid_observations(with_gaps(observations(spark, sf_dir)), ["pixel"])


def _bucket_query(bucket: str, how: str, source: str) -> None:
    part = {"year": "year", "month": "month", "day": "day"}[bucket]
    agg = {"median": "median", "mean": "avg", "max": "max", "min": "min"}[how]
    sql_source = GAPS_SQL if source == "lineitem" else "SELECT user_id AS pixel, CAST(ts AS DATE) AS date, value FROM events"

    @query(f"{bucket}_{how}", f"SELECT pixel, CAST({part}(date) AS INT) AS {bucket}, round({agg}(value), 6) AS value FROM ({sql_source}) GROUP BY 1, 2")
    def run(spark, sf_dir):
        if source == "lineitem":
            obs = with_gaps(observations(spark, sf_dir))
        else:
            obs = table(spark, sf_dir, "events").select(F.col("user_id").alias("pixel"), F.to_date("ts").alias("date"), "value")
        return series.by_bucket(obs, ["pixel"], bucket, how).withColumn("value", F.round("value", 6))


for _how in ("median", "mean", "max", "min"):
    _bucket_query("year", _how, "lineitem")
_bucket_query("month", "median", "lineitem")
_bucket_query("day", "median", "events")

PAIR_SQL = """SELECT pair, round(avg(t) - 273.15, 6) AS t2m, round(sum(p) * 30 * 10000, 3) AS tp
FROM (SELECT CAST(floor(event_id / 2) AS BIGINT) AS pair, value + 250 AS t, value / 1000 AS p FROM events) GROUP BY pair"""


@query("climate_pairs", PAIR_SQL)
def climate_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("i"), (F.col("value") + 250).alias("t"), (F.col("value") / 1000).alias("p"))
    return series.pairs_aggregated(e, "i", "t", "p").select("pair", F.round("t2m", 6).alias("t2m"), F.round("tp", 3).alias("tp"))


def _trend_sql(source: str, factor: float, least: int) -> str:
    mid = "(list_sort({0})[(len({0}) + 1) // 2] + list_sort({0})[len({0}) // 2 + 1]) / 2"
    return f"""
WITH obs AS ({source}),
s AS (SELECT pixel, count(*) AS n, list(x) AS xs, list(y) AS ys FROM obs GROUP BY pixel),
sl AS (
  SELECT a.pixel, list_sort(list((b.y - a.y) / (b.x - a.x))) AS s
  FROM obs a JOIN obs b ON a.pixel = b.pixel AND b.x > a.x GROUP BY a.pixel
), r AS (
  SELECT s.pixel, n, xs, ys, s, len(s) AS nt, sqrt(n * (n - 1) * (2 * n + 5) / 18.0) * 1.959963984540054::DOUBLE AS sd
  FROM s LEFT JOIN sl ON s.pixel = sl.pixel
), f AS (
  SELECT pixel, n, CASE WHEN n >= {least} AND nt > 0 THEN {mid.format("s")} END AS slope,
         {mid.format("ys")} AS my, {mid.format("xs")} AS mx, s,
         CAST(greatest(round_even((nt - sd) / 2, 0) - 1, 0) AS BIGINT) AS lo, CAST(least(round_even((nt + sd) / 2, 0), nt - 1) AS BIGINT) AS hi
  FROM r
)
SELECT pixel, CAST(n AS INT) AS nobs, round(slope * {factor}::DOUBLE, 6) AS slope,
       round(my - slope * mx, 6) AS intercept,
       CASE WHEN slope IS NOT NULL THEN round(s[lo + 1] * {factor}::DOUBLE, 6) END AS ci_low,
       CASE WHEN slope IS NOT NULL THEN round(s[hi + 1] * {factor}::DOUBLE, 6) END AS ci_high
FROM f"""


DAYS_SQL = f"SELECT pixel, CAST(date_diff('day', DATE '2014-07-01', date) AS DOUBLE) AS x, avg(value) AS y FROM ({OBS_SQL}) GROUP BY pixel, date"
YEARS_SQL = f"SELECT pixel, CAST(year(date) - 2014 AS DOUBLE) AS x, median(value) AS y FROM ({OBS_SQL}) GROUP BY pixel, year(date)"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


@query("theil_sen_full", _trend_sql(DAYS_SQL, trend.PER_DECADE_DAYS, trend.MIN_FOR_TREND))
def theil_sen_full(spark, sf_dir):
    obs = series.mean_of_same_date(series.dealt(observations(spark, sf_dir), ["pixel"]), ["pixel"])
    obs = obs.select("pixel", F.datediff("date", F.lit("2014-07-01").cast("date")).alias("x"), F.col("value").alias("y"))
    return _rounded(trend.robust_trend(obs, ["pixel"], factor=trend.PER_DECADE_DAYS, least=trend.MIN_FOR_TREND))


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = series.by_bucket(series.dealt(observations(spark, sf_dir), ["pixel"]), ["pixel"], "year", "median")
    return obs.select("pixel", (F.col("year") - 2014).alias("x"), F.col("value").alias("y"))


@query("theil_sen_yearly", _trend_sql(YEARS_SQL, trend.PER_DECADE_YEARS, trend.MIN_FOR_TREND))
def theil_sen_yearly(spark, sf_dir):
    return _rounded(trend.robust_trend(yearly(spark, sf_dir), ["pixel"], factor=trend.PER_DECADE_YEARS, least=trend.MIN_FOR_TREND))


@query("pairwise_median_slope", f"""
WITH obs AS ({YEARS_SQL}), sl AS (SELECT a.pixel, list_sort(list((b.y - a.y) / (b.x - a.x))) AS s FROM obs a JOIN obs b ON a.pixel = b.pixel AND b.x > a.x AND a.y <> 0 AND b.y <> 0 GROUP BY 1)
SELECT o.pixel, round((s[(len(s) + 1) // 2] + s[len(s) // 2 + 1]) / 2, 6) AS slope FROM (SELECT DISTINCT pixel FROM obs WHERE y <> 0) o LEFT JOIN sl ON o.pixel = sl.pixel""")
def pairwise_median_slope(spark, sf_dir):
    return _rounded(trend.pairwise_median_slope(yearly(spark, sf_dir), ["pixel"]))


def _break_sql(breaks: int, predictor: str) -> str:
    cuts = "SELECT n1.pixel, i.i AS i1, CAST(NULL AS BIGINT) AS i2 FROM n n1, LATERAL (SELECT unnest(range(2, n1.n - 1)) AS i) i"
    if breaks == 2:
        cuts = """SELECT n1.pixel, i.i AS i1, j.j AS i2 FROM n n1, LATERAL (SELECT unnest(range(2, n1.n - 1)) AS i) i,
                  LATERAL (SELECT unnest(range(i.i + 2, n1.n - 1)) AS j) j"""
    best = "mae" if predictor == "mae" else "-r2"
    second = ", CAST(b.i2 AS INT) AS break_loc2, p2.x AS break_x2" if breaks == 2 else ""
    join2 = "LEFT JOIN o p2 ON p2.pixel = b.pixel AND p2.k = b.i2" if breaks == 2 else ""
    return f"""
WITH o AS (SELECT pixel, x, y, row_number() OVER (PARTITION BY pixel ORDER BY x, y) - 1 AS k FROM ({YEARS_SQL})),
n AS (SELECT pixel, count(*) AS n FROM o GROUP BY pixel),
cuts AS ({cuts}),
seg AS (SELECT c.pixel, c.i1, c.i2, o.x, o.y, CASE WHEN k < i1 THEN 0 WHEN i2 IS NULL OR k < i2 THEN 1 ELSE 2 END AS part FROM cuts c JOIN o ON o.pixel = c.pixel),
fit AS (SELECT pixel, i1, i2, part, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM seg GROUP BY ALL),
f AS (SELECT s.pixel, s.i1, s.i2, s.y, a + b * x AS h FROM seg s JOIN fit ON fit.pixel = s.pixel AND fit.i1 = s.i1 AND fit.i2 IS NOT DISTINCT FROM s.i2 AND fit.part = s.part),
q AS (SELECT pixel, i1, i2, avg(abs(y - h)) AS mae, pow(covar_pop(y, h), 2) / nullif(var_pop(y) * var_pop(h), 0) AS r2 FROM f GROUP BY 1, 2, 3),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pixel ORDER BY round({best}, 9), i1, i2) AS r FROM q WHERE {predictor} IS NOT NULL) WHERE r = 1),
lf AS (SELECT pixel, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM o GROUP BY pixel HAVING count(*) > 1),
lin AS (SELECT o.pixel, avg(abs(y - a - b * x)) AS mae, pow(covar_pop(y, a + b * x), 2) / nullif(var_pop(y) * var_pop(a + b * x), 0) AS r2 FROM o JOIN lf ON o.pixel = lf.pixel GROUP BY o.pixel)
SELECT n.pixel, CAST(b.i1 AS INT) AS break_loc1, p1.x AS break_x1{second}, round(b.mae, 6) AS mae, round(b.r2, 6) AS r2, round(lin.mae, 6) AS mae_linear, round(lin.r2, 6) AS r2_linear
FROM n LEFT JOIN b ON b.pixel = n.pixel LEFT JOIN lin ON lin.pixel = n.pixel LEFT JOIN o p1 ON p1.pixel = b.pixel AND p1.k = b.i1 {join2}"""


def _break_query(breaks: int, predictor: str) -> None:
    @query(f"breakpoint{breaks}_{predictor}", _break_sql(breaks, predictor))
    def run(spark, sf_dir):
        return _rounded(bp.breakpoints(yearly(spark, sf_dir), ["pixel"], breaks=breaks, predictor=predictor))


_break_query(1, "mae")
_break_query(1, "r2")
_break_query(2, "mae")
_break_query(2, "r2")

# --- spectral ------------------------------------------------------------------------------------------------------

BANDS_SQL = "SELECT vec_id, list_transform(embedding[1:6], lambda v: CAST(v AS DOUBLE) + 1) AS b, CASE label % 3 WHEN 0 THEN 'TM' WHEN 1 THEN 'ETM' ELSE 'OLI' END AS sensor FROM embeddings"


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    b = F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double") + 1)
    sensor = F.when(F.col("label") % 3 == 0, "TM").when(F.col("label") % 3 == 1, "ETM").otherwise("OLI")
    return e.select("vec_id", b.alias("b"), sensor.alias("sensor"))


def _dot_sql(factors: tuple[float, ...]) -> str:
    return "0::DOUBLE" + "".join(f" + ({f!r})::DOUBLE * b[{k + 1}]" for k, f in enumerate(factors))


def _cap_query(sensor: str | None) -> None:
    def part(name: str) -> str:
        if sensor:
            return _dot_sql(spectral.TASSELED_CAP[sensor][name])
        return "CASE sensor " + " ".join(f"WHEN '{s}' THEN {_dot_sql(p[name])}" for s, p in spectral.TASSELED_CAP.items()) + " END"

    names = ("brightness", "greenness", "wetness")

    @query(f"tasseled_cap_{(sensor or 'auto').lower()}", f"SELECT vec_id, {', '.join(f'round({part(n)}, 9) AS {n}' for n in names)} FROM ({BANDS_SQL})")
    def run(spark, sf_dir):
        s = scenes(spark, sf_dir)
        return s.select("vec_id", *[F.round(spectral.tasseled_cap(F.col("b"), n, sensor or F.col("sensor")), 9).alias(n) for n in names])


for _sensor in ("TM", "ETM", "OLI", None):
    _cap_query(_sensor)


def _index_query(name: str) -> None:
    i, k = (x + 1 for x in spectral.NORMALISED[name])

    @query(name, f"SELECT vec_id, nullif((b[{i}] - b[{k}]) / nullif(b[{i}] + b[{k}], 0), 0) AS {name} FROM ({BANDS_SQL})")
    def run(spark, sf_dir):
        return scenes(spark, sf_dir).select("vec_id", spectral.normalised_difference(F.col("b"), name).alias(name))


for _name in spectral.NORMALISED:
    _index_query(_name)


@query("bai", f"SELECT vec_id, round(1 / nullif((0.1::DOUBLE - b[3]) * (0.1::DOUBLE - b[3]) + (0.06::DOUBLE - b[4]), 0), 6) AS bai FROM ({BANDS_SQL})")
def bai(spark, sf_dir):
    return scenes(spark, sf_dir).select("vec_id", F.round(spectral.burned_area(F.col("b")), 6).alias("bai"))


@query("dn_radiance", "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity <> 0 THEN (193.0 - -1.52) / (255.0 - 1.0) * (l_quantity - 1.0) + -1.52 ELSE 0 END, 6) AS radiance FROM lineitem")
def dn_radiance(spark, sf_dir):
    v = spectral.dn_to_radiance(F.col("l_quantity"), F.lit(-1.52), F.lit(193.0), F.lit(1.0), F.lit(255.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(v, 6).alias("radiance"))


@query("gain_reflectance", "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_extendedprice <> 0 THEN (2e-5 * l_extendedprice - 0.1) / sin(radians(20 + l_quantity)) ELSE 0 END, 6) AS reflectance, round(CASE WHEN l_extendedprice <> 0 THEN 0.012 * l_extendedprice - 60 ELSE 0 END, 6) AS radiance FROM lineitem")
def gain_reflectance(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    a = spectral.gain_to_reflectance(F.col("l_extendedprice"), F.col("l_quantity") + 20)
    b = spectral.gain_to_radiance(F.col("l_extendedprice"), 0.012, -60.0)
    return d.select("l_orderkey", "l_linenumber", F.round(a, 6).alias("reflectance"), F.round(b, 6).alias("radiance"))


@query("toa_reflectance", "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity <> 0 THEN 3.141592653589793::DOUBLE * l_quantity * 1.01 * 1.01 / (1536.0 * sin(radians(30 + l_linenumber))) ELSE 0 END, 9) AS reflectance FROM lineitem")
def toa_reflectance(spark, sf_dir):
    v = spectral.radiance_to_reflectance(F.col("l_quantity"), F.lit(30) + F.col("l_linenumber"), spectral.ESUN["TM"][3], 1.01)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(v, 9).alias("reflectance"))


@query("rgb_scale", f"SELECT vec_id, CAST(least(greatest(round_even((b[1] - 1 + 0.12) / 0.24 * 254 + 1, 0), 0), 255) AS INT) AS red FROM ({BANDS_SQL})")
def rgb_scale(spark, sf_dir):
    return scenes(spark, sf_dir).select("vec_id", spectral.to_byte_range(F.col("b")[0] - 1).alias("red"))


@query("pixel_grid", "SELECT o_orderkey, o_orderkey - (((o_orderkey % 30) + 30) % 30 - 15) AS aligned FROM orders")
def pixel_grid(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", spectral.aligned(F.col("o_orderkey")).alias("aligned"))


# --- masks and names -----------------------------------------------------------------------------------------------

QA_SQL = "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events"


def qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("qa_bits", f"SELECT event_id, (k & 6) <> 0 AS valid, {', '.join(f'((k & 255) >> {i}) & 1 AS bit{i}' for i in range(8))} FROM ({QA_SQL})")
def qa_bits(spark, sf_dir):
    return qa(spark, sf_dir).select("event_id", spectral.qa_valid(F.col("k")).alias("valid"), *[spectral.qa_bit(F.col("k"), i).alias(f"bit{i}") for i in range(8)])


@query("cfmask", f"SELECT event_id FROM ({QA_SQL}) WHERE k % 5 IN (0, 1)")
def cfmask(spark, sf_dir):
    return qa(spark, sf_dir).where(spectral.cfmask_valid(F.col("k") % 5)).select("event_id")


NAMES_SQL = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN (CASE o_custkey % 4 WHEN 0 THEN 'LT4' WHEN 1 THEN 'LT5' WHEN 2 THEN 'LE7' ELSE 'XX1' END) || lpad(CAST(o_custkey % 233 AS VARCHAR), 3, '0') || lpad(CAST(o_custkey % 90 AS VARCHAR), 3, '0') || strftime(o_orderdate, '%Y%j') || '_masked_S_32_8'
       WHEN o_orderkey % 3 = 1 THEN (CASE o_custkey % 4 WHEN 0 THEN 'LT04' WHEN 1 THEN 'LT05' WHEN 2 THEN 'LE07' ELSE 'LC08' END) || lpad(CAST(o_custkey % 233 AS VARCHAR), 3, '0') || lpad(CAST(o_custkey % 90 AS VARCHAR), 2, '0') || strftime(o_orderdate, '%Y%m%d') || '0101'[1:4] || '_masked_S_32_8'
       ELSE 'bad_name' END AS name, o_orderdate, o_custkey FROM orders"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "orders")
    c = F.col("o_custkey")
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    first = F.when(c % 4 == 0, "LT4").when(c % 4 == 1, "LT5").when(c % 4 == 2, "LE7").otherwise("XX1")
    second = F.when(c % 4 == 0, "LT04").when(c % 4 == 1, "LT05").when(c % 4 == 2, "LE07").otherwise("LC08")
    v1 = F.concat(first, pad(c % 233, 3), pad(c % 90, 3), F.date_format("o_orderdate", "yyyyDDD"), F.lit("_masked_S_32_8"))
    v2 = F.concat(second, pad(c % 233, 3), pad(c % 90, 2), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("0101_masked_S_32_8"))
    kind = F.col("o_orderkey") % 3
    return d.select("o_orderkey", F.when(kind == 0, v1).when(kind == 1, v2).otherwise("bad_name").alias("name"))


SPLIT_SQL = f"""SELECT o_orderkey, split_part(name, '_', 1) AS s, len(string_split(name, '_')) AS n FROM ({NAMES_SQL})"""


@query("parse_scene_names", f"""
SELECT o_orderkey, v AS version, CAST(CASE WHEN v = 'v1' THEN CAST(strptime(s[10:16], '%Y%j') AS DATE) WHEN v = 'v2' THEN CAST(strptime(s[11:18], '%Y%m%d') AS DATE) END AS VARCHAR) AS date,
  CASE WHEN len(s) = 16 THEN (CASE s[1:3] WHEN 'LT4' THEN 'TM' WHEN 'LT5' THEN 'TM' WHEN 'LE7' THEN 'ETM' WHEN 'LC8' THEN 'OLI' END)
       WHEN len(s) = 22 THEN (CASE s[1:4] WHEN 'LT04' THEN 'TM' WHEN 'LT05' THEN 'TM' WHEN 'LE07' THEN 'ETM' WHEN 'LC08' THEN 'OLI' END) END AS sensor,
  TRY_CAST(CASE WHEN len(s) = 16 THEN s[4:6] ELSE s[5:7] END AS INT) AS path, TRY_CAST(CASE WHEN len(s) = 16 THEN s[8:9] ELSE s[9:10] END AS INT) AS row
FROM (SELECT *, CASE WHEN n = 5 AND len(s) = 16 THEN 'v1' WHEN n = 5 AND len(s) = 22 THEN 'v2' END AS v FROM ({SPLIT_SQL}))""")
def parse_scene_names(spark, sf_dir):
    b = F.col("name")
    path, row = scene_names.path_row(b)
    return names(spark, sf_dir).select("o_orderkey", scene_names.naming_version(b).alias("version"), scene_names.scene_date(b).cast("string").alias("date"), scene_names.sensor_of(b).alias("sensor"), path.alias("path"), row.alias("row"))


@query("date_parts", "SELECT o_orderkey, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(dayofyear(d) AS INT) AS doy, CAST(date_diff('day', DATE '1970-01-01', d) + 719163 AS INT) AS ordinal, strftime(d, '%j') AS doy_text FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def date_parts(spark, sf_dir):
    d = F.to_date("o_orderdate")
    parts = {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "doy": F.dayofyear(d), "ordinal": scene_names.ordinal_day(d), "doy_text": scene_names.day_of_year_text(d.cast("string"))}
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(k) for k, v in parts.items()])


@query("tile_names", """SELECT c_custkey, split_part(n, '_', 2) AS period, rtrim(split_part(n, '_', 3), '-') AS site, ltrim(split_part(n, '_', 4), '-') AS lat, regexp_replace(split_part(n, '_', 5), '\\.tif$', '') AS lon, array_to_string(string_split(n, '_')[1:4], '_') AS base
FROM (SELECT c_custkey, 'trend_2000-2020_Z0' || c_nationkey || '-_-' || c_custkey % 90 || '_' || c_custkey % 180 || '.tif' AS n FROM customer)""")
def tile_names(spark, sf_dir):
    c = F.col("c_custkey")
    n = F.concat(F.lit("trend_2000-2020_Z0"), F.col("c_nationkey").cast("string"), F.lit("-_-"), (c % 90).cast("string"), F.lit("_"), (c % 180).cast("string"), F.lit(".tif"))
    d = table(spark, sf_dir, "customer").select("c_custkey", n.alias("n"))
    return d.select("c_custkey", *[v.alias(k) for k, v in scene_names.tile_parts(F.col("n")).items()], scene_names.without_last_token(F.col("n")).alias("base"))


@query("tiling", "SELECT p_partkey, x.x AS x_off, y.y AS y_off, least(250, p_size * 25 - x.x) AS x_len, least(250, 600 - y.y) AS y_len FROM part, LATERAL (SELECT unnest(range(0, CAST(p_size AS BIGINT) * 25, 250)) AS x) x, LATERAL (SELECT unnest(range(0, 600, 250)) AS y) y")
def tiling(spark, sf_dir):
    d = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size").cast("long") * 25).alias("xs"), F.lit(600).cast("long").alias("ys"))
    return spatial.tiling(d, "xs", "ys", 250, 250).drop("xs", "ys")


# --- rasters and objects -------------------------------------------------------------------------------------------

GRID_SQL = "SELECT vec_id AS row, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS col, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings"
MASK_SQL = f"SELECT row, col FROM ({GRID_SQL}) WHERE value > 0.1"
SIZE_SQL = "SELECT max(vec_id) + 1 AS nr FROM embeddings"
THRESHOLD = 0.1


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.from_array(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).where(F.col("value") > THRESHOLD).select("row", "col")


def n_rows(spark: SparkSession, sf_dir: str) -> int:
    return (table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] or 0) + 1


OFF_SQL = "(SELECT unnest([-1, 0, 1]) AS i) oi, (SELECT unnest([-1, 0, 1]) AS k) ok"
DILATE_SQL = f"SELECT DISTINCT row + i AS row, col + k AS col FROM ({MASK_SQL}), {OFF_SQL} WHERE row + i BETWEEN 0 AND (SELECT nr - 1 FROM ({SIZE_SQL})) AND col + k BETWEEN 0 AND {COLS - 1}"


@query("dilate3", DILATE_SQL)
def dilate3(spark, sf_dir):
    return cells.dilate(mask(spark, sf_dir), n_rows(spark, sf_dir), COLS)


@query("erode3", f"""
WITH m AS (SELECT row, col FROM ({GRID_SQL}) WHERE value > -0.1),
bad AS (SELECT DISTINCT g.row + i AS row, g.col + k AS col FROM ({GRID_SQL}) g, {OFF_SQL} WHERE g.value <= -0.1)
SELECT m.row, m.col FROM m LEFT JOIN bad ON m.row = bad.row AND m.col = bad.col WHERE bad.row IS NULL""")
def erode3(spark, sf_dir):
    return cells.erode(grid(spark, sf_dir).where("value > -0.1"), n_rows(spark, sf_dir), COLS)


def _label_sql(diagonal: bool) -> str:
    steps = [(i, k) for i in (-1, 0, 1) for k in (-1, 0, 1) if (i or k) and (diagonal or not (i and k))]
    values = ", ".join(f"({i}, {k})" for i, k in steps)
    return f"""
WITH RECURSIVE m AS ({MASK_SQL}), e AS (
  SELECT a.row * {COLS} + a.col AS u, b.row * {COLS} + b.col AS v FROM m a, (VALUES {values}) o(i, k), m b WHERE b.row = a.row + i AND b.col = a.col + k
), r AS (
  SELECT row * {COLS} + col AS id, row * {COLS} + col AS label FROM m
  UNION SELECT e.u, r.label FROM r JOIN e ON e.v = r.id WHERE r.label < e.u
), l AS (SELECT id // {COLS} AS row, id % {COLS} AS col, min(label) AS label FROM r GROUP BY id)"""


@query("components4", _label_sql(False) + " SELECT row, col, label FROM l")
def components4(spark, sf_dir):
    return cells.components(mask(spark, sf_dir), COLS)


@query("components8", _label_sql(True) + " SELECT label, count(*) AS area FROM l GROUP BY label")
def components8(spark, sf_dir):
    return cells.components(mask(spark, sf_dir), COLS, diagonal=True).groupBy("label").agg(F.count("*").alias("area"))


@query("label_numbers", _label_sql(False) + " SELECT row, col, dense_rank() OVER (ORDER BY label) AS label FROM l")
def label_numbers(spark, sf_dir):
    return cells.renumbered(cells.components(mask(spark, sf_dir), COLS))


@query("object_zonal", _label_sql(False) + f""", big AS (SELECT label FROM l GROUP BY label HAVING count(*) >= 3),
edge AS (SELECT DISTINCT label FROM l, ({SIZE_SQL}) s WHERE row = 0 OR row = nr - 1 OR col = 0 OR col = {COLS - 1})
SELECT l.label, count(*) AS area, round(min(g.value), 9) AS p_min, round(avg(g.value), 9) AS p_mean, round(max(g.value), 9) AS p_max
FROM l JOIN ({GRID_SQL}) g ON g.row = l.row AND g.col = l.col WHERE l.label IN (SELECT label FROM big) AND l.label NOT IN (SELECT label FROM edge) GROUP BY l.label""")
def object_zonal(spark, sf_dir):
    labels = cells.components(mask(spark, sf_dir), COLS)
    labels = cells.without_border(cells.without_small(labels, 3), n_rows(spark, sf_dir), COLS)
    areas = labels.groupBy("label").agg(F.count("*").alias("area"))
    stats = cells.zonal(labels, grid(spark, sf_dir), "p_")
    return areas.join(stats, "label").select("label", "area", *[F.round(c, 9).alias(c) for c in ("p_min", "p_mean", "p_max")])


@query("object_shape", _label_sql(False) + f""", w AS (
  SELECT label, count(*) AS area, avg(row) AS cr, avg(col) AS cc FROM l GROUP BY label
), sh AS (SELECT a.label, count(*) AS n FROM l a JOIN l b ON a.label = b.label AND abs(a.row - b.row) + abs(a.col - b.col) = 1 GROUP BY a.label)
SELECT w.label, area, round(cr, 6) AS centroid_row, round(cc, 6) AS centroid_col, round(sqrt(area * 4 / pi()), 6) AS equivalent_diameter,
       CAST(area * 4 - coalesce(sh.n, 0) AS DOUBLE) AS perimeter FROM w LEFT JOIN sh ON sh.label = w.label""")
def object_shape(spark, sf_dir):
    out = cells.shape(cells.components(mask(spark, sf_dir), COLS))
    return _rounded(out.select("label", "area", "centroid_row", "centroid_col", "equivalent_diameter", "perimeter"))


@query("block_grid", f"SELECT CAST(floor(row / 25) AS BIGINT) AS block_row, CAST(floor(col / 25) AS BIGINT) AS block_col, round(sum(value), 6) AS value FROM ({GRID_SQL}) GROUP BY 1, 2")
def block_grid(spark, sf_dir):
    return _rounded(cells.blocks(grid(spark, sf_dir), 25, "value"))


@query("sobel", f"""
SELECT g.row + i AS row, g.col + k AS col, round(sqrt((pow(sum(i * (CASE WHEN k = 0 THEN 2.0 ELSE 1.0 END) / 4 * value), 2) + pow(sum(k * (CASE WHEN i = 0 THEN 2.0 ELSE 1.0 END) / 4 * value), 2)) / 2), 9) AS value
FROM ({GRID_SQL}) g, {OFF_SQL} GROUP BY 1, 2 HAVING count(*) = 9""")
def sobel(spark, sf_dir):
    return cells.sobel(grid(spark, sf_dir)).withColumn("value", F.round("value", 9))


def _gauss_sql(sigma: float) -> str:
    w = cells.gaussian_weights(sigma)
    r = len(w) // 2
    values = ", ".join(f"({k - r}, {x!r}::DOUBLE)" for k, x in enumerate(w))
    one = f"SELECT g.row AS row, g.col AS col, sum(w * h.value) / sum(w) AS value FROM ({GRID_SQL}) g, (VALUES {values}) o(d, w), ({GRID_SQL}) h WHERE h.row = g.row + d AND h.col = g.col GROUP BY 1, 2"
    return f"WITH a AS ({one}) SELECT g.row, g.col, round(sum(w * h.value) / sum(w), 9) AS value FROM a g, (VALUES {values}) o(d, w), a h WHERE h.row = g.row AND h.col = g.col + d GROUP BY 1, 2"


@query("gaussian", _gauss_sql(1.0))
def gaussian(spark, sf_dir):
    return cells.gaussian(grid(spark, sf_dir), 1.0).withColumn("value", F.round("value", 9))


@query("terrain_slope", f"""
WITH g AS ({GRID_SQL}) SELECT g.row, g.col, round(degrees(atan(sqrt(pow((r.value - l.value) / 60, 2) + pow((d.value - u.value) / 60, 2)))), 9) AS value
FROM g JOIN g l ON l.row = g.row AND l.col = g.col - 1 JOIN g r ON r.row = g.row AND r.col = g.col + 1 JOIN g u ON u.row = g.row - 1 AND u.col = g.col JOIN g d ON d.row = g.row + 1 AND d.col = g.col""")
def terrain_slope(spark, sf_dir):
    return cells.terrain_slope(grid(spark, sf_dir)).withColumn("value", F.round("value", 9))


@query("local_maxima", f"""
WITH g AS ({GRID_SQL}) SELECT a.row, a.col, a.value FROM g a JOIN g b ON b.row BETWEEN a.row - 1 AND a.row + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1
WHERE a.value > 0.2 GROUP BY ALL HAVING max(b.value) = a.value""")
def local_maxima(spark, sf_dir):
    return cells.local_maxima(grid(spark, sf_dir), 0.2)


HIST_SQL = f"""WITH g AS ({GRID_SQL}), e AS (SELECT min(value) AS lo, max(value) AS hi FROM g),
c AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 256)) AS BIGINT), 255) AS bin, count(*) AS n FROM g, e GROUP BY 1),
h AS (SELECT b.bin, coalesce(n, 0) AS n, lo + (hi - lo) / 256 * (b.bin + 0.5::DOUBLE) AS centre FROM (SELECT unnest(range(0, 256)) AS bin) b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin)"""


@query("otsu", HIST_SQL + """, s AS (SELECT bin, centre, sum(n) OVER w AS n1, sum(n * centre) OVER w AS s1, sum(n) OVER r AS n2, sum(n * centre) OVER r AS s2 FROM h
WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING), r AS (ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT round(centre, 9) AS threshold FROM s WHERE n1 > 0 AND n2 > 0 ORDER BY n1 * n2 * pow(s1 / n1 - s2 / n2, 2) DESC, bin LIMIT 1""")
def otsu(spark, sf_dir):
    return _rounded9(cells.otsu(grid(spark, sf_dir)))


@query("yen", HIST_SQL + """, p AS (SELECT bin, centre, n / (SELECT sum(n) FROM h) AS p FROM h),
s AS (SELECT bin, centre, sum(p) OVER w AS p1, sum(p * p) OVER w AS q1, sum(p * p) OVER r AS q2 FROM p
WINDOW w AS (ORDER BY bin ROWS UNBOUNDED PRECEDING), r AS (ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT round(centre, 9) AS threshold FROM s WHERE q1 * q2 > 0 AND p1 * (1 - p1) > 0 ORDER BY ln(pow(p1 * (1 - p1), 2) / (q1 * q2)) DESC, bin LIMIT 1""")
def yen(spark, sf_dir):
    return _rounded9(cells.yen(grid(spark, sf_dir)))


def _rounded9(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])


@query("two_means", """
WITH v AS (SELECT l_suppkey AS label, l_extendedprice AS value, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS k FROM lineitem),
t AS (SELECT a.label, a.value, a.k - 1 AS n1, sum(a.value) OVER (PARTITION BY a.label ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s1, count(*) OVER (PARTITION BY a.label) AS n, sum(a.value) OVER (PARTITION BY a.label) AS s, lag(a.value) OVER (PARTITION BY a.label ORDER BY k) AS below FROM v a)
SELECT label, max_by(value, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1)) AS threshold FROM t WHERE n1 > 0 AND value > below GROUP BY label""")
def two_means(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("label"), F.col("l_extendedprice").alias("value"))
    return cells.two_means(d)


@query("zonal_minmeanmax", "SELECT o_custkey AS label, min(l_quantity) AS q_min, round(avg(l_quantity), 9) AS q_mean, max(l_quantity) AS q_max FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def zonal_minmeanmax(spark, sf_dir):
    places = lambda df, key: df.select(F.col(key).alias("row"), F.lit(0).alias("col"), "*")
    zones = places(table(spark, sf_dir, "orders"), "o_orderkey").select("row", "col", F.col("o_custkey").alias("label"))
    values = places(table(spark, sf_dir, "lineitem"), "l_orderkey").select("row", "col", F.col("l_quantity").alias("value"))
    return _rounded9(cells.zonal(zones, values, "q_"))


OBJ_SQL = """SELECT l_partkey AS label, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS area_water_inside, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity / 8 ELSE 0 END) AS area_water_steady,
  sum(CASE WHEN l_returnflag = 'A' THEN l_quantity / 4 ELSE 0 END) AS area_wgain, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity / 4 ELSE 0 END) AS area_wloss, CAST(count(*) AS DOUBLE) AS perimeter FROM lineitem GROUP BY 1"""


def object_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, q = table(spark, sf_dir, "lineitem"), F.col("l_quantity")
    pick = lambda c, v, x: F.sum(F.when(F.col(c) == v, x).otherwise(0.0))
    return d.groupBy(F.col("l_partkey").alias("label")).agg(
        pick("l_linestatus", "F", q).alias("area_water_inside"), pick("l_linestatus", "O", q / 8).alias("area_water_steady"),
        pick("l_returnflag", "A", q / 4).alias("area_wgain"), pick("l_returnflag", "R", q / 4).alias("area_wloss"), F.count("*").cast("double").alias("perimeter"),
    )


SHARES_SQL = f"SELECT *, area_wgain - area_wloss AS area_budget, area_water / nullif(area_total, 0) AS perc_water, area_wloss / nullif(area_total, 0) AS perc_wloss, area_wgain / nullif(area_total, 0) AS perc_wgain FROM (SELECT *, area_water + area_wloss + area_wgain AS area_total FROM (SELECT *, area_water_inside + area_water_steady AS area_water FROM ({OBJ_SQL})))"
CHANGE_SQL = f"""SELECT *, netchange_ha * 1e4 / nullif(perimeter, 0) / 20 AS changerate_net, grossincrease_ha * 1e4 / nullif(perimeter, 0) / 20 AS changerate_growth FROM (
SELECT label, perimeter * 30 AS perimeter, s AS area_start_ha, e AS area_end_ha, w AS stablewater_ha, g AS grossincrease_ha, l AS grossdecrease_ha, e - s AS netchange_ha, (e / nullif(s, 0) - 1) * 100 AS netchange_perc, g / nullif(s, 0) * 100 AS grossincrease_perc, l / nullif(e, 0) * 100 AS grossdecrease_perc
FROM (SELECT label, perimeter, w, g, l, w + l AS s, w + g AS e FROM (SELECT label, perimeter, area_water * 0.09 AS w, area_wgain * 0.09 AS g, area_wloss * 0.09 AS l FROM ({SHARES_SQL}))))"""
CHANGE_COLUMNS = ["area_start_ha", "area_end_ha", "stablewater_ha", "grossincrease_ha", "grossdecrease_ha", "netchange_ha", "netchange_perc", "grossincrease_perc", "grossdecrease_perc", "changerate_net", "changerate_growth"]


def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = objects.in_metres(objects.in_hectares(objects.with_shares(object_table(spark, sf_dir))))
    return objects.with_change(d, "2000-2020").select("label", "perimeter", *CHANGE_COLUMNS)


@query("object_shares", f"SELECT label, round(area_water, 6) AS area_water, round(area_total, 6) AS area_total, round(area_budget, 6) AS area_budget, round(perc_water, 6) AS perc_water, round(perc_wloss, 6) AS perc_wloss, round(perc_wgain, 6) AS perc_wgain FROM ({SHARES_SQL})")
def object_shares(spark, sf_dir):
    return _rounded(objects.with_shares(object_table(spark, sf_dir)).select("label", "area_water", "area_total", "area_budget", "perc_water", "perc_wloss", "perc_wgain"))


@query("object_change", f"SELECT label, perimeter, {', '.join(f'round({c}, 6) AS {c}' for c in CHANGE_COLUMNS)} FROM ({CHANGE_SQL})")
def object_change(spark, sf_dir):
    return _rounded(changed(spark, sf_dir))


@query("regional_stats", f"""SELECT g AS region, round((sum(area_end_ha) / nullif(sum(area_start_ha), 0) - 1) * 100, 6) AS net_change_perc, round(sum(netchange_ha), 6) AS net_change_ha, round(sum(area_start_ha), 6) AS water_t0_ha, round(sum(area_end_ha), 6) AS water_t1_ha,
round(sum(grossincrease_ha), 6) AS gross_increase_ha, round(sum(grossincrease_ha) / nullif(sum(area_start_ha), 0) * 100, 6) AS gross_increase_perc, round(sum(grossdecrease_ha), 6) AS gross_decrease_ha, round(sum(grossdecrease_ha) / nullif(sum(area_end_ha), 0) * 100, 6) AS gross_decrease_perc,
round(sum(stablewater_ha), 6) AS stable_ha, count(*) AS n_objects, round(avg(area_start_ha), 6) AS mean_t0, round(avg(area_end_ha), 6) AS mean_t1, round(median(area_start_ha), 6) AS median_t0, round(median(area_end_ha), 6) AS median_t1, round(max(area_start_ha), 6) AS max_t0, round(max(area_end_ha), 6) AS max_t1,
count(*) FILTER (WHERE area_end_ha / nullif(area_start_ha, 0) > 4) AS n_quadrupled, round(count(*) FILTER (WHERE area_end_ha / nullif(area_start_ha, 0) > 4) / count(*) * 100, 6) AS quadrupled_perc,
count(*) FILTER (WHERE area_start_ha / nullif(area_end_ha, 0) > 4) AS n_quartered, round(count(*) FILTER (WHERE area_start_ha / nullif(area_end_ha, 0) > 4) / count(*) * 100, 6) AS quartered_perc,
count(*) FILTER (WHERE stablewater_ha / nullif(stablewater_ha + grossdecrease_ha + grossincrease_ha, 0) * 100 > 95) AS n_stable FROM (SELECT *, label % 7 AS g FROM ({CHANGE_SQL})) GROUP BY g""")
def regional_stats(spark, sf_dir):
    out = objects.region_summary(changed(spark, sf_dir).withColumn("region", F.col("label") % 7), "region")
    return out.select([F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


@query("total_perc", f"SELECT round(sum(area_water + area_wgain) / nullif(sum(area_water + area_wloss), 0) - 1, 9) AS total_change FROM ({SHARES_SQL})")
def total_perc(spark, sf_dir):
    return _rounded9(objects.total_change(objects.with_shares(object_table(spark, sf_dir))))


# --- joins, overlays, top picks -------------------------------------------------------------------------------------


@query("filter_objects", f"SELECT label FROM ({SHARES_SQL}) WHERE perc_wgain <= 0.1 AND area_water > 500")
def filter_objects(spark, sf_dir):
    return scoring.filtered_objects(objects.with_shares(object_table(spark, sf_dir)), "perc_wgain <= 0.1 and area_water > 500").select("label")


@query("zone_left_joins", "SELECT p_partkey AS label, p_size AS area, coalesce(i.n, 0) AS inside, g.q AS margin FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) i ON i.l_partkey = p_partkey LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) g ON g.l_partkey = p_partkey")
def zone_left_joins(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("label"), F.col("p_size").alias("area"))
    d = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "label")
    i = d.where("l_linestatus = 'F'").groupBy("label").agg(F.count("*").alias("inside"))
    g = d.where("l_returnflag = 'R'").groupBy("label").agg(F.sum("l_quantity").alias("margin"))
    return spatial.with_attributes(p, [i, g], "label").withColumn("inside", F.coalesce("inside", F.lit(0).cast("long")))


@query("aux_full_join", "SELECT coalesce(a.k, b.k) AS k, a.n AS orders, b.n AS lines FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k")
def aux_full_join(spark, sf_dir):
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.count("*").alias("lines"))
    return spatial.with_attributes(a, [b], "k", "full_outer")


@query("layers_by_name", "SELECT l_orderkey AS key, max(l_quantity) FILTER (WHERE l_linenumber = 1) AS tcb, max(l_quantity) FILTER (WHERE l_linenumber = 2) AS tcg, max(l_quantity) FILTER (WHERE l_linenumber = 3) AS tcw FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def layers_by_name(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key"), "l_linenumber").agg(F.max("l_quantity").alias("value"))
    named = d.withColumn("name", F.when(F.col("l_linenumber") == 1, "tcb").when(F.col("l_linenumber") == 2, "tcg").when(F.col("l_linenumber") == 3, "tcw"))
    return spatial.stacked(named, ["key"], "name", ["tcb", "tcg", "tcw"])


@query("update_coalesce", "SELECT c_custkey, coalesce(o.m, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o_custkey = c_custkey")
def update_coalesce(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    right = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return spatial.updated(left, right, ["c_custkey"], ["c_acctbal"])


FISH_SQL = "SELECT i * 7 + k AS cell, -1000.0 + i * 1000 AS xmin, -1000.0 + (i + 1) * 1000 AS xmax, k * 4.0 AS ymin, (k + 1) * 4.0 AS ymax FROM (SELECT unnest(range(0, 12)) AS i), (SELECT unnest(range(0, 7)) AS k)"


@query("fishnet_join", f"SELECT c_custkey, cell FROM customer JOIN ({FISH_SQL}) f ON c_acctbal >= xmin AND c_acctbal < xmax AND c_nationkey >= ymin AND c_nationkey < ymax")
def fishnet_join(spark, sf_dir):
    i = spark.range(12).select(F.col("id").alias("i"))
    k = spark.range(7).select(F.col("id").alias("k"))
    f = i.join(k, F.lit(True)).select((F.col("i") * 7 + F.col("k")).alias("cell"), (F.col("i") * 1000 - 1000.0).alias("xmin"), (F.col("i") * 1000 + 0.0).alias("xmax"), (F.col("k") * 4.0).alias("ymin"), (F.col("k") * 4.0 + 4.0).alias("ymax"))
    return spatial.in_boxes(table(spark, sf_dir, "customer"), f, "c_acctbal", "c_nationkey", 500.0).select("c_custkey", "cell")


@query("boxes_meet", """WITH b AS (SELECT s_suppkey AS k, s_acctbal AS x, s_nationkey * 100.0 AS y FROM supplier)
SELECT a.k AS k, c.k AS r_k FROM b a JOIN b c ON c.x <= a.x + 200 + 50 AND c.x + 200 >= a.x - 50 AND c.y <= a.y + 150 + 50 AND c.y + 150 >= a.y - 50""")
def boxes_meet(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    b = s.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("xmin"), (F.col("s_acctbal") + 200).alias("xmax"), (F.col("s_nationkey") * 100.0).alias("ymin"), (F.col("s_nationkey") * 100.0 + 150).alias("ymax"))
    return spatial.meeting_boxes(b, b, 500.0, 50.0).select("k", "r_k")


@query("raster_sample", f"SELECT c_custkey, g.value FROM customer LEFT JOIN ({GRID_SQL}) g ON g.col = CAST(floor((c_acctbal + 1000) / 200) AS BIGINT) AND g.row = CAST(floor((24 - c_nationkey) / 0.5) AS BIGINT)")
def raster_sample(spark, sf_dir):
    points = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 200).alias("x"), (F.col("c_nationkey") * 2.0).alias("y"))
    return spatial.sampled(points, grid(spark, sf_dir), "x", "y", -5.0, 48.0, 1.0).select("c_custkey", "value")


@query("mosaic_overlay", "SELECT l_suppkey, l_linenumber, max_by(v, o) AS value FROM (SELECT l_suppkey, l_linenumber, l_orderkey * 10 + l_quantity / 100 AS o, CASE WHEN l_quantity % 3 = 0 THEN 0 ELSE l_quantity END AS v FROM lineitem) WHERE v <> 0 GROUP BY 1, 2")
def mosaic_overlay(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    v = F.when(F.col("l_quantity") % 3 == 0, 0.0).otherwise(F.col("l_quantity"))
    d = d.select("l_suppkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_quantity") / 100).alias("ordinal"), v.alias("value"))
    return spatial.overlay(d, ["l_suppkey", "l_linenumber"])


@query("stale_outputs", "SELECT i.k AS k, o.made IS NULL OR o.made < i.newest AS process FROM (SELECT l_partkey AS k, max(l_shipdate) AS newest FROM lineitem GROUP BY 1) i LEFT JOIN (SELECT o_custkey AS k, max(o_orderdate) AS made FROM orders GROUP BY 1) o ON o.k = i.k")
def stale_outputs(spark, sf_dir):
    inputs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_shipdate").alias("ts"))
    outputs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("ts"))
    return spatial.stale(outputs, inputs, "k")


@query("unmet_tiles", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)")
def unmet_tiles(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_linenumber = 1").select(F.col("l_partkey").alias("p_partkey"))
    return spatial.unmet(table(spark, sf_dir, "part").select("p_partkey"), done, ["p_partkey"])


@query("class_scoring", f"SELECT vec_id, CASE WHEN a >= b AND a >= c THEN 1 WHEN b >= c THEN 12 ELSE 21 END AS class, round(greatest(a, b, c), 9) AS confidence FROM (SELECT vec_id, x / (x + y + z) AS a, y / (x + y + z) AS b, z / (x + y + z) AS c FROM (SELECT vec_id, exp(b[1]) AS x, exp(b[2]) AS y, exp(b[3]) AS z FROM ({BANDS_SQL})))")
def class_scoring(spark, sf_dir):
    def softmax(x):
        import numpy as np

        e = np.exp(x)
        return e / e.sum(1, keepdims=True)

    d = scenes(spark, sf_dir).select("vec_id", *[F.col("b")[k].alias(f"b{k}") for k in range(3)])
    return scoring.classified(d, ["b0", "b1", "b2"], [1, 12, 21], softmax).select("vec_id", "class", F.round("confidence", 9).alias("confidence"))


@query("point_series", f"SELECT l_shipdate, value FROM (SELECT l_suppkey AS row, l_linenumber AS col, CAST(l_shipdate AS DATE)::VARCHAR AS l_shipdate, l_quantity AS value FROM lineitem) WHERE row = 7 AND col = 3")
def point_series(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("row"), F.col("l_linenumber").alias("col"), F.to_date("l_shipdate").cast("string").alias("l_shipdate"), F.col("l_quantity").alias("value"))
    return series.at_point(d, 1105.0, 7770.0, 1000.0, 8000.0, 30.0).select("l_shipdate", "value")


# --- more of rasters and objects ------------------------------------------------------------------------------------

CROSS_SQL = "(VALUES (0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)) o(i, k)"
INSIDE_SQL = f"row BETWEEN 0 AND (SELECT nr - 1 FROM ({SIZE_SQL})) AND col BETWEEN 0 AND {COLS - 1}"


def _spread_sql(source: str, offsets: str = OFF_SQL) -> str:
    return f"SELECT * FROM (SELECT DISTINCT s.row + i AS row, s.col + k AS col FROM {source} s, {offsets}) WHERE {INSIDE_SQL}"


def _rest_sql(source: str) -> str:
    return f"SELECT g.row, g.col FROM g LEFT JOIN {source} m ON m.row = g.row AND m.col = g.col WHERE m.row IS NULL"


@query("closing3", f"WITH g AS ({GRID_SQL}), d AS ({DILATE_SQL}), e AS ({_rest_sql('d')}), x AS ({_spread_sql('e')}) SELECT d.row, d.col FROM d LEFT JOIN x ON x.row = d.row AND x.col = d.col WHERE x.row IS NULL")
def closing3(spark, sf_dir):
    return cells.closing(mask(spark, sf_dir), n_rows(spark, sf_dir), COLS)


@query("opening_cross", f"""WITH g AS ({GRID_SQL}), m AS (SELECT row, col FROM g WHERE value > -0.1), e AS ({_rest_sql('m')}), x AS ({_spread_sql('e', CROSS_SQL)}),
s AS (SELECT m.row, m.col FROM m LEFT JOIN x ON x.row = m.row AND x.col = m.col WHERE x.row IS NULL) {_spread_sql('s', CROSS_SQL)}""")
def opening_cross(spark, sf_dir):
    n = n_rows(spark, sf_dir)
    inner = cells.eroded(grid(spark, sf_dir).where("value > -0.1"), n, COLS, cells.CROSS)
    return cells.dilate(inner, n, COLS, cells.CROSS)


@query("fill_holes", _label_sql(False).replace(f"m AS ({MASK_SQL})", f"m AS (SELECT row, col FROM ({GRID_SQL}) WHERE value <= -0.1)", 1) + f""",
small AS (SELECT label FROM l GROUP BY label HAVING count(*) < 4)
SELECT row, col FROM ({GRID_SQL}) WHERE value > -0.1 UNION ALL SELECT row, col FROM l WHERE label IN (SELECT label FROM small)""")
def fill_holes(spark, sf_dir):
    return cells.without_holes(grid(spark, sf_dir).where("value > -0.1"), n_rows(spark, sf_dir), COLS, 4)


@query("local_threshold", _gauss_sql(1 / 3).replace("round(sum(w * h.value) / sum(w), 9)", "round(sum(w * h.value) / sum(w) - 0.05, 9)"))
def local_threshold(spark, sf_dir):
    return cells.local_threshold(grid(spark, sf_dir), 0.05).withColumn("value", F.round("value", 9))


@query("objects_off_nodata", _label_sql(False) + f""", near AS ({_spread_sql(f"(SELECT row, col FROM ({GRID_SQL}) WHERE value < -0.3)", CROSS_SQL)}),
bad AS (SELECT DISTINCT label FROM l JOIN near USING (row, col) UNION SELECT label FROM l, ({SIZE_SQL}) s WHERE row = 0 OR row = nr - 1 OR col = 0 OR col = {COLS - 1})
SELECT row, col, label FROM l WHERE label NOT IN (SELECT label FROM bad)""")
def objects_off_nodata(spark, sf_dir):
    nodata = grid(spark, sf_dir).where("value < -0.3").select("row", "col")
    return cells.without_border_or(cells.components(mask(spark, sf_dir), COLS), nodata, n_rows(spark, sf_dir), COLS)


@query("wanted_labels", _label_sql(False) + ", w AS (SELECT label FROM l GROUP BY label HAVING count(*) >= 3) SELECT row, col, CASE WHEN label IN (SELECT label FROM w) THEN label ELSE 0 END AS label FROM l")
def wanted_labels(spark, sf_dir):
    labels = cells.components(mask(spark, sf_dir), COLS)
    return cells.kept_labels(labels, labels.groupBy("label").agg(F.count("*").alias("n")).where("n >= 3"))


@query("scatter_attribute", _label_sql(False) + ", a AS (SELECT label, count(*) AS n FROM l GROUP BY label) SELECT row, col, CASE WHEN n > 2 THEN n * 0.09::DOUBLE ELSE -9999 END AS value FROM l JOIN a USING (label)")
def scatter_attribute(spark, sf_dir):
    labels = cells.components(mask(spark, sf_dir), COLS)
    table_ = labels.groupBy("label").agg(F.count("*").alias("n"))
    return cells.scattered(table_, labels, F.when(F.col("n") > 2, F.col("n") * 0.09))


@query("object_polygons", _label_sql(False) + """, runs AS (SELECT label, row, col - row_number() OVER (PARTITION BY label, row ORDER BY col) AS island, col FROM l),
s AS (SELECT label, row, min(col) AS a, max(col) + 1 AS b FROM runs GROUP BY label, row, island),
t AS (SELECT label, format('(({} {}, {} {}, {} {}, {} {}, {} {}))', a, row, b, row, b, row + 1, a, row + 1, a, row) AS ring FROM s)
SELECT label, 'MULTIPOLYGON (' || string_agg(ring, ', ' ORDER BY ring) || ')' AS geometry FROM t GROUP BY label""")
def object_polygons(spark, sf_dir):
    return sinks.cell_polygons(cells.components(mask(spark, sf_dir), COLS))


def _ring_sql(label: str) -> str:
    """The rings of l (row, col, part), which are walked from every segment on; that of the least segment is the ring's text."""
    return f""", sd AS (SELECT {label} AS label, part, unnest([{{'flat': true, 'line': row, 'pos': col, 'dir': 2}}, {{'flat': true, 'line': row + 1, 'pos': col, 'dir': 0}},
  {{'flat': false, 'line': col, 'pos': row, 'dir': 3}}, {{'flat': false, 'line': col + 1, 'pos': row, 'dir': 1}}]) AS s FROM l),
ed AS (SELECT label, part, s.flat AS flat, s.line AS line, s.pos AS pos, min(s.dir) AS dir FROM sd GROUP BY 1, 2, 3, 4, 5 HAVING count(*) = 1),
isl AS (SELECT *, pos - row_number() OVER (PARTITION BY part, dir, line ORDER BY pos) AS island FROM ed),
ru AS (SELECT label, part, dir, flat, line, min(pos) AS a, max(pos) + 1 AS b FROM isl GROUP BY label, part, dir, flat, line, island),
fl AS (SELECT *, CASE WHEN dir IN (0, 3) THEN a ELSE b END AS p, CASE WHEN dir IN (0, 3) THEN b ELSE a END AS q FROM ru),
sg AS (SELECT label, part, dir, CASE WHEN flat THEN line ELSE p END AS r0, CASE WHEN flat THEN p ELSE line END AS c0, CASE WHEN flat THEN line ELSE q END AS r1, CASE WHEN flat THEN q ELSE line END AS c1 FROM fl),
si AS (SELECT *, (r0 * {COLS + 1} + c0) * 4 + dir AS id FROM sg),
nx AS (SELECT a.id, max_by(b.id, (b.dir - a.dir + 4) % 4) AS nxt FROM si a JOIN si b ON a.part = b.part AND a.r1 = b.r0 AND a.c1 = b.c0 WHERE (b.dir - a.dir + 4) % 4 IN (1, 3) GROUP BY a.id),
wk AS (SELECT id AS start, id, 0 AS step FROM si UNION ALL SELECT start, nxt, step + 1 FROM wk JOIN nx USING (id) WHERE nxt > start),
cl AS (SELECT start FROM wk JOIN nx USING (id) WHERE nxt = start)
"""


@query("object_outlines", _label_sql(True) + f""", p0 AS (
  SELECT row * {COLS} + col AS id, row * {COLS} + col AS part FROM m UNION SELECT e4.u, p0.part FROM p0 JOIN (SELECT u, v FROM e WHERE abs(u - v) = {COLS} OR (abs(u - v) = 1 AND u // {COLS} = v // {COLS})) e4 ON e4.v = p0.id WHERE p0.part < e4.u
)""" + f", l2 AS (SELECT l.row, l.col, l.label, min(part) AS part FROM l JOIN p0 ON p0.id = l.row * {COLS} + l.col GROUP BY ALL)" + _ring_sql("label").replace("FROM l)", "FROM l2)") + f"""
SELECT si.label, si.part, start AS ring, CAST(sum(c0 * -r1 + r0 * c1) / 2 AS BIGINT) AS area,
  string_agg(c0 || ' ' || r0, ', ' ORDER BY step) || ', ' || first(c0 || ' ' || r0 ORDER BY step) AS points
FROM wk JOIN cl USING (start) JOIN si USING (id) GROUP BY si.label, si.part, start""")
def object_outlines(spark, sf_dir):
    found = outlines.rings(cells.components(mask(spark, sf_dir), COLS, diagonal=True), COLS)
    text = F.array_join(F.transform("points", lambda p: F.concat_ws(" ", p["col"].cast("string"), p["row"].cast("string"))), ", ")
    return found.select("label", "part", "ring", F.col("area").cast("long").alias("area"), text.alias("points"))


PROBA_SQL = f"SELECT row, col, abs(value) AS p0, abs(value) / 2 AS p2, abs(value) / 4 AS p3, value FROM ({GRID_SQL})"


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.abs("value")
    return grid(spark, sf_dir).select("row", "col", F.array(v, F.lit(0.0), v / 2, v / 4).alias("p"), "value")


@query("object_growth", _label_sql(False) + f""", core AS (SELECT l.* FROM l JOIN ({GRID_SQL}) g ON g.row = l.row AND g.col = l.col WHERE g.value > 0.11),
own AS (SELECT row + i AS row, col + k AS col, label, count(*) AS n FROM core, {OFF_SQL} GROUP BY 1, 2, 3),
inn AS (SELECT c.* FROM core c JOIN own o USING (row, col, label), ({SIZE_SQL}) s WHERE n = (3 - CAST(row = 0 AS INT) - CAST(row = nr - 1 AS INT)) * (3 - CAST(col = 0 AS INT) - CAST(col = {COLS - 1} AS INT))),
outer_ AS (SELECT * FROM (SELECT DISTINCT row + i AS row, col + k AS col, label FROM l, {OFF_SQL}) WHERE {INSIDE_SQL}),
ring AS (SELECT o.* FROM outer_ o LEFT JOIN inn x ON x.row = o.row AND x.col = o.col AND x.label = o.label WHERE x.row IS NULL),
t AS (SELECT label, sum(p0) AS s0, sum(p2) AS s2, sum(p3) AS s3 FROM ring JOIN ({PROBA_SQL}) USING (row, col) GROUP BY label),
n AS (SELECT label, count(*) AS n FROM inn GROUP BY label)
SELECT label, round(coalesce(n, 0) + s0, 6) AS lake_area, round(s2, 6) AS grow_area, round(s3, 6) AS shrink_area, round(s2 / nullif(coalesce(n, 0) + s0 + s3, 0) * 100, 6) AS grow_perc, round(s3 / nullif(coalesce(n, 0) + s0 + s3, 0) * 100, 6) AS shrink_perc FROM t LEFT JOIN n USING (label)""")
def object_growth(spark, sf_dir):
    n, p = n_rows(spark, sf_dir), probabilities(spark, sf_dir)
    labels = cells.components(mask(spark, sf_dir), COLS)
    core = labels.join(p.where("value > 0.11").select("row", "col"), ["row", "col"], "left_semi")
    return _rounded(cells.growth(*cells.object_margins(labels, core, n, COLS), p))


MARGIN_SQL = _label_sql(False) + f""", g AS ({GRID_SQL}), core AS (SELECT row, col FROM g WHERE value > 0.11), rest AS ({_rest_sql("core")}), near AS ({_spread_sql("rest")}),
inn AS (SELECT c.row, c.col FROM core c LEFT JOIN near x ON x.row = c.row AND x.col = c.col WHERE x.row IS NULL),
la AS (SELECT l.* FROM l JOIN inn USING (row, col)),
lb AS (SELECT d.* FROM (SELECT row + i AS row, col + k AS col, max(label) AS label FROM l, {OFF_SQL} GROUP BY 1, 2) d LEFT JOIN inn x ON x.row = d.row AND x.col = d.col WHERE x.row IS NULL AND d.{INSIDE_SQL.replace(" AND col", " AND d.col")})"""


def margin_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = mask(spark, sf_dir)
    core = grid(spark, sf_dir).where("value > 0.11").select("row", "col")
    return cells.margins(m, core, cells.components(m, COLS), n_rows(spark, sf_dir), COLS)


@query("margin_stats", MARGIN_SQL + f""" SELECT b.label, round(s0, 6) AS area_water_steady, round(s2, 6) AS area_wgain, round(s3, 6) AS area_wloss, coalesce(a.n, 0)::DOUBLE AS area_water_inside
FROM (SELECT label, sum(p0) AS s0, sum(p2) AS s2, sum(p3) AS s3 FROM lb JOIN ({PROBA_SQL}) USING (row, col) GROUP BY label) b LEFT JOIN (SELECT label, count(*) AS n FROM la GROUP BY label) a USING (label)""")
def margin_stats(spark, sf_dir):
    return _rounded(cells.margin_stats(*margin_labels(spark, sf_dir), probabilities(spark, sf_dir)))


@query("change_blocks", MARGIN_SQL + f""", c AS (SELECT coalesce(b.row, a.row) AS row, coalesce(b.col, a.col) AS col, coalesce(p2, 0) AS gain, coalesce(p3, 0) AS loss, coalesce(p0, 0) + CASE WHEN a.row IS NULL THEN 0 ELSE 1 END AS stable
  FROM (SELECT row, col, p0, p2, p3 FROM (SELECT DISTINCT row, col FROM lb WHERE label <> 0) JOIN ({PROBA_SQL}) USING (row, col)) b FULL JOIN (SELECT DISTINCT row, col FROM la WHERE label <> 0) a ON a.row = b.row AND a.col = b.col),
t AS (SELECT row // 25 AS block_row, col // 25 AS block_col, sum(gain) AS gain, sum(loss) AS loss, sum(stable) AS stable FROM c GROUP BY 1, 2)
SELECT block_row, block_col, round((gain - loss) / 0.5625::DOUBLE * 0.09::DOUBLE, 6) AS netchange, round(gain / 0.5625::DOUBLE * 0.09::DOUBLE, 6) AS grossgain, round(loss / 0.5625::DOUBLE * 0.09::DOUBLE, 6) AS grossloss, round(stable * 0.09::DOUBLE, 6) AS waterstable,
  round((stable + loss) * 0.09::DOUBLE, 6) AS area_start_ha, round((stable + gain) * 0.09::DOUBLE, 6) AS area_end_ha, round((stable + loss) / 0.5625::DOUBLE * 0.09::DOUBLE, 6) AS limnicity_start, round((stable + gain) / 0.5625::DOUBLE * 0.09::DOUBLE, 6) AS limnicity_end FROM t""")
def change_blocks(spark, sf_dir):
    return _rounded(cells.change_blocks(cells.change_cells(*margin_labels(spark, sf_dir), probabilities(spark, sf_dir)), 25))


@query("segments_threshold", _label_sql(False) + " SELECT row, col, label FROM l")
def segments_threshold(spark, sf_dir):
    classes = grid(spark, sf_dir).withColumn("class", F.when(F.col("value") > THRESHOLD, 14).otherwise(0))
    return pipelines.segments(classes, n_rows(spark, sf_dir), COLS, "simple")


@query("segments_watershed")
def segments_watershed(spark, sf_dir):
    classes = grid(spark, sf_dir).withColumn("class", F.lit(0))
    return pipelines.segments(classes, n_rows(spark, sf_dir), COLS, "watershed", mask_above=-0.2, peaks_above=0.02, sigma=1.0)


@query("object_solidity")
def object_solidity(spark, sf_dir):
    out = scoring.solidity(cells.components(mask(spark, sf_dir), COLS, diagonal=True))
    return _rounded9(out)


# --- places and resampling ------------------------------------------------------------------------------------------


def _utm_sql() -> str:
    sine, turn = "sin(radians(lat))", f"radians(lon - {projection.central_meridian(8)})"
    east = "".join(f" + {a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(projection.ALPHA, 1))
    north = "".join(f" + {a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(projection.ALPHA, 1))
    return f"""SELECT c_custkey, round(500000 + {projection.RADIUS!r}::DOUBLE * (eta{east}), 3) AS easting, round({projection.RADIUS!r}::DOUBLE * (xi{north}), 3) AS northing, round(lon, 7) AS lon, round(lat, 7) AS lat
FROM (SELECT *, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(1 + t * t)) AS eta
FROM (SELECT *, sinh(atanh({sine}) - {projection.ROOT!r}::DOUBLE * atanh({projection.ROOT!r}::DOUBLE * {sine})) AS t, {turn} AS turn
FROM (SELECT c_custkey, -138 + c_acctbal / 4000 AS lon, 60 + c_nationkey * 0.5::DOUBLE AS lat FROM customer)))"""


@query("utm_round_trip", _utm_sql())
def utm_round_trip(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select("c_custkey", (F.lit(-138.0) + F.col("c_acctbal") / 4000).alias("lon"), (F.lit(60.0) + F.col("c_nationkey") * 0.5).alias("lat"))
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), 8)
    d = d.select("c_custkey", x.alias("easting"), y.alias("northing"))
    lon, lat = projection.from_utm(F.col("easting"), F.col("northing"), 8)
    return d.select("c_custkey", F.round("easting", 3).alias("easting"), F.round("northing", 3).alias("northing"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


TARGET_SQL = f"SELECT row AS r, col AS c, row * 1.3::DOUBLE + 0.27 AS v, col * 0.7::DOUBLE + 0.43 AS u FROM ({GRID_SQL})"


def _resample_query(method: str) -> None:
    one = {
        "nearest": "CASE WHEN d <= 0.5 AND d > -0.5 THEN 1.0::DOUBLE ELSE 0 END",
        "bilinear": "greatest(1 - abs(d), 0)",
        "cubic": "CASE WHEN abs(d) < 1 THEN (1.5::DOUBLE * abs(d) - 2.5::DOUBLE) * d * d + 1 WHEN abs(d) < 2 THEN ((-0.5::DOUBLE * abs(d) + 2.5::DOUBLE) * abs(d) - 4) * abs(d) + 2 ELSE 0 END",
    }[method]
    weights = [one.replace("d)", f"({x} - g.{y}))").replace("* d ", f"* ({x} - g.{y}) ").replace("d <", f"({x} - g.{y}) <").replace("d >", f"({x} - g.{y}) >") for x, y in (("v", "row"), ("u", "col"))]
    w = f"({weights[0]}) * ({weights[1]})"

    @query(f"resample_{method}", f"""SELECT t.r, t.c, round(sum(w * value) / nullif(sum(w), 0), 7) AS value FROM ({TARGET_SQL}) t LEFT JOIN (
SELECT t.r, t.c, {w} AS w, g.value FROM ({TARGET_SQL}) t JOIN ({GRID_SQL}) g ON g.row BETWEEN CAST(floor(v) AS BIGINT) - 1 AND CAST(floor(v) AS BIGINT) + 2 AND g.col BETWEEN CAST(floor(u) AS BIGINT) - 1 AND CAST(floor(u) AS BIGINT) + 2) x
ON x.r = t.r AND x.c = t.c AND w <> 0 GROUP BY t.r, t.c""")
    def run(spark, sf_dir):
        g = grid(spark, sf_dir)
        t = g.select(F.col("row").alias("r"), F.col("col").alias("c"), (F.col("row") * 1.3 + 0.27).alias("v"), (F.col("col") * 0.7 + 0.43).alias("u"))
        return spatial.resampled(t, g, ["r", "c"], "v", "u", method).withColumn("value", F.round("value", 7))


for _method in ("nearest", "bilinear", "cubic"):
    _resample_query(_method)


@query("box_union", "SELECT c_nationkey, min(c_acctbal) AS xmin, max(c_acctbal + 10) AS xmax, min(c_custkey) AS ymin, max(c_custkey + 5) AS ymax FROM customer GROUP BY 1")
def box_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    b = c.select("c_nationkey", F.col("c_acctbal").alias("xmin"), (F.col("c_acctbal") + 10).alias("xmax"), F.col("c_custkey").alias("ymin"), (F.col("c_custkey") + 5).alias("ymax"))
    return spatial.box_union(b, "c_nationkey")


@query("newer_tiles", "SELECT l_orderkey, l_linenumber FROM lineitem LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS made FROM orders GROUP BY 1) ON o_custkey = l_partkey WHERE l_shipdate > coalesce(made - INTERVAL 1000 DAY, TIMESTAMP '1900-01-01')")
def newer_tiles(spark, sf_dir):
    tiles = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz").alias("ts"))
    made = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderdate").cast("timestamp_ntz") - F.expr("interval 1000 days")).alias("ts"))
    return spatial.newer_only(tiles, made, "k").select("l_orderkey", "l_linenumber")


@query("training_points", f"""WITH g AS ({GRID_SQL}), b AS (SELECT *, s_suppkey % 5 AS k FROM supplier),
box AS (SELECT s_nationkey AS cell, 400.0 * s_nationkey AS xmin, 400.0 * s_nationkey + 500 AS xmax, 0.0 AS ymin, 20.0 AS ymax FROM (SELECT DISTINCT s_nationkey FROM supplier)),
p AS (SELECT c_custkey AS id, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
f AS (SELECT id, any_value(x) AS x, any_value(y) AS y, min(cell) AS cell FROM p JOIN box ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax GROUP BY id HAVING count(*) = 1)
SELECT id, cell, round(a.value, 9) AS ndvi_ciu, round(-a.value, 9) AS ndvi_cil, round(a.value + a.value, 9) AS ndvi_cirange, 'Z056' AS zone FROM f LEFT JOIN g a ON a.col = CAST(floor(x / 200) AS BIGINT) AND a.row = CAST(floor((2000 - y) / 200) AS BIGINT)""")
def training_points(spark, sf_dir):
    g = grid(spark, sf_dir)
    i = F.col("s_nationkey") * 400.0
    boxes = table(spark, sf_dir, "supplier").select("s_nationkey").distinct().select(F.col("s_nationkey").alias("cell"), i.alias("xmin"), (i + 500).alias("xmax"), F.lit(0.0).alias("ymin"), F.lit(20.0).alias("ymax"))
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    out = pipelines.training_set(points, boxes, {"ndvi_ciu": g, "ndvi_cil": g.withColumn("value", -F.col("value"))}, 0.0, 2000.0, 200.0, 500.0, "Z056")
    return _rounded9(out.select("id", "cell", "ndvi_ciu", "ndvi_cil", "ndvi_cirange", "zone"))


@query("first_scene", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders o WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders x WHERE x.o_custkey = o.o_custkey) GROUP BY 1")
def first_scene(spark, sf_dir):
    first = F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(first)


@query("stage_report", "SELECT 'warp' AS stage, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL) AS failed FROM orders")
def stage_report(spark, sf_dir):
    return manifest.report(table(spark, sf_dir, "orders").withColumn("ok", F.col("o_orderstatus") == "F"), "warp", "ok")


@query("masked_rgb", f"SELECT vec_id, CASE WHEN label % 2 > 0 THEN greatest(red, 1) ELSE 0 END AS red FROM (SELECT e.vec_id, label, CAST(least(greatest(round_even((b[1] - 1 + 0.12) / 0.24 * 254 + 1, 0), 0), 255) AS INT) AS red FROM ({BANDS_SQL}) b JOIN embeddings e ON e.vec_id = b.vec_id)")
def masked_rgb(spark, sf_dir):
    label = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    d = scenes(spark, sf_dir).join(label, "vec_id")
    return d.select("vec_id", spectral.masked_byte(spectral.to_byte_range(F.col("b")[0] - 1), F.col("label") % 2).alias("red"))


@query("point_text", "SELECT s_suppkey, 'POINT (' || s_suppkey || ' ' || s_nationkey || ')' AS wkt, CAST(TIMESTAMP '1900-01-01' + to_hours(s_suppkey * 1000) AS VARCHAR) AS at, CAST(s_suppkey AS DOUBLE) AS ulx, CAST(s_nationkey + 9 AS DOUBLE) AS uly, CAST(s_suppkey + 7 AS DOUBLE) AS lrx, CAST(s_nationkey AS DOUBLE) AS lry FROM supplier")
def point_text(spark, sf_dir):
    x, y = F.col("s_suppkey"), F.col("s_nationkey")
    ring = F.format_string('{"type":"Polygon","coordinates":[[[%d,%d],[%d,%d],[%d,%d],[%d,%d],[%d,%d]]]}', x, y + 9, x + 7, y + 9, x + 7, y, x, y, x, y + 9)
    corners = scene_names.ring_corners(ring)
    names_ = ("ulx", "uly", "lrx", "lry")
    at = scene_names.hours_since_1900(x * 1000).cast("string")
    return table(spark, sf_dir, "supplier").select("s_suppkey", scene_names.point_wkt(x, y).alias("wkt"), at.alias("at"), *[c.alias(n) for c, n in zip(corners, names_, strict=True)])


# --- texts and features ---------------------------------------------------------------------------------------------


@query("metadata_value", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS text, CAST(o_custkey AS DOUBLE) AS number FROM orders")
def metadata_value(spark, sf_dir):
    content = F.concat(F.lit("GROUP = SUN\r\n  DATE = "), F.col("o_orderdate").cast("string"), F.lit("\n  SUN_ELEVATION = "), F.col("o_custkey").cast("string"), F.lit("\n  SUN_ELEVATION_2 = 0\nEND"))
    d = table(spark, sf_dir, "orders").select("o_orderkey", content.alias("content"))
    return d.select("o_orderkey", text.value_of(F.col("content"), "SUN_ELEVATION").alias("v")).select("o_orderkey", "v.*")


@query("instrument_of", "SELECT s_suppkey, 'S' || s_nationkey AS instrument FROM supplier")
def instrument_of(spark, sf_dir):
    xml = F.format_string("<scene><meta id='%d'><instrument>S%d</instrument></meta><instrument>other</instrument></scene>", "s_suppkey", "s_nationkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.instrument(xml).alias("instrument"))


@query("site_paths", "SELECT 'Z' || n_nationkey AS name, '/data/' || n_name AS data_dir, '/data/' || n_regionkey || '.shp' AS fishnet_file FROM nation")
def site_paths(spark, sf_dir):
    name = F.concat(F.lit("Z"), F.col("n_nationkey").cast("string"))
    n = table(spark, sf_dir, "nation").select(name.alias("name"), F.concat(F.lit("N:\\old\\"), "n_name").alias("data_dir"), F.concat(F.lit("/mnt/x/"), F.col("n_regionkey").cast("string"), F.lit(".shp")).alias("fishnet_file"))
    return text.site_table(n, "/data/")


@query("sun_distances", "SELECT CAST(s_suppkey * 6 + k AS INT) AS doy, k + s_nationkey / 64 AS d FROM supplier, (SELECT unnest(range(0, 6)) AS k)")
def sun_distances(spark, sf_dir):
    pair = lambda k: F.concat((F.col("s_suppkey") * 6 + k).cast("string"), F.lit(","), (F.lit(k) + F.col("s_nationkey") / 64).cast("string"))
    lines = table(spark, sf_dir, "supplier").select(F.concat_ws(",", *[pair(k) for k in range(6)]).alias("value"))
    return text.distances(lines.unionByName(spark.createDataFrame([("DOY,d,DOY,d,DOY,d,DOY,d,DOY,d,DOY,d",)], "value string")))


@query("scaled_bands", "SELECT l_orderkey, l_linenumber, round(nullif(l_linenumber - 1, 0) / 10000, 9) AS b1, round(nullif(l_quantity, 0) / 10000, 9) AS b2 FROM lineitem")
def scaled_bands(spark, sf_dir):
    b = spectral.scaled(F.array((F.col("l_linenumber") - 1).cast("double"), F.col("l_quantity").cast("double")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", b.alias("b")).select("l_orderkey", "l_linenumber", F.round(F.col("b")[0], 9).alias("b1"), F.round(F.col("b")[1], 9).alias("b2"))


@query("valid_scenes", f"""SELECT basename, date IS NOT NULL AS valid_name, coalesce(month(date) BETWEEN 7 AND 8 AND year(date) BETWEEN 1996 AND 1999, false) AS process FROM (
SELECT *, CASE WHEN n = 5 AND len(s) = 16 THEN CAST(try_strptime(s[10:16], '%Y%j') AS DATE) WHEN n = 5 AND len(s) = 22 THEN CAST(try_strptime(s[11:18], '%Y%m%d') AS DATE) END AS date
FROM (SELECT name || '.tif' AS basename, split_part(name, '_', 1) AS s, len(string_split(name, '_')) AS n FROM ({NAMES_SQL})))""")
def valid_scenes(spark, sf_dir):
    files = names(spark, sf_dir).select(F.concat("name", F.lit(".tif")).alias("basename"))
    return manifest.manifest(files, (7, 8), (1996, 1999)).select("basename", "valid_name", "process")


@query("feature_boxes", "SELECT s_suppkey AS id, 'Polygon' AS kind, s_acctbal AS xmin, s_acctbal + 30 AS xmax, s_nationkey - 5.5 AS ymin, s_nationkey + 2.0 AS ymax FROM supplier")
def feature_boxes(spark, sf_dir):
    x, y = F.col("s_acctbal"), F.col("s_nationkey").cast("double")
    shaped = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), features.box(x, y - 5.5, x + 30, y + 2).alias("geometry"))
    line = F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "value", F.lit("]}"))
    read = features.features(sinks.as_features(shaped).select(line.alias("value")))
    return read.select(F.col("properties")["id"].cast("long").alias("id"), "kind", "xmin", "xmax", "ymin", "ymax")


@query("typed_layers", f"SELECT row, col, CASE WHEN value > 0.1 THEN 14 ELSE 0 END AS class, CAST(coalesce(CASE WHEN value > 0.1 THEN value END, -1) AS FLOAT)::DOUBLE AS confidence FROM ({GRID_SQL})")
def typed_layers(spark, sf_dir):
    g = grid(spark, sf_dir)
    known = g.select("row", "col", F.when(F.col("value") > 0.1, 14).alias("class"), F.when(F.col("value") > 0.1, F.col("value")).alias("confidence"))
    out = sinks.layers(known, {"class": ("tinyint", 0), "confidence": ("float", -1.0)})
    return out.withColumns({"class": F.col("class").cast("int"), "confidence": F.col("confidence").cast("double")})


def _layer_files(spark, cells_, bands, kind, nodata, step):
    """A folder of raster files of cells in the shared folder."""
    path = f"{shared_folder(spark)}/rasters-{uuid.uuid4().hex}"
    rasters.write_rasters(cells_, path, bands, rasters.Georeference(500000.0, 7000000.0, 30.0, 32608), kind, nodata, step)
    return path


def _at_centre():
    """row and col in the whole raster, by the centres of cells of files that start at (500000, 7000000)."""
    return [F.floor((7000000.0 - F.col("y")) / 30).alias("row"), F.floor((F.col("x") - 500000.0) / 30).alias("col")]


@query("layers_round_trip", f"SELECT row, col, 500000 + 30 * (col + 0.5::DOUBLE) AS x, 7000000 - 30 * (row + 0.5::DOUBLE) AS y, CAST(CASE WHEN value > 0.1 THEN value END AS FLOAT)::DOUBLE AS confidence, CAST(row % 90 + 1 AS DOUBLE) AS class FROM ({GRID_SQL})")
def layers_round_trip(spark, sf_dir):
    g = grid(spark, sf_dir).select("row", "col", F.when(F.col("value") > 0.1, F.col("value")).alias("confidence"), (F.col("row") % 90 + 1).alias("class"))
    found = tiff.cells(spark, _layer_files(spark, g, ["confidence", "class"], "float32", -1.0, 32))
    return found.select(*_at_centre(), "x", "y", F.col("b")[0].alias("confidence"), F.col("b")[1].alias("class"))


@query("raster_window", f"SELECT row, col, CAST(value AS FLOAT)::DOUBLE AS value FROM ({GRID_SQL}) WHERE row % 50 BETWEEN 20 AND 39 AND col BETWEEN 10 AND 40")
def raster_window(spark, sf_dir):
    """The same window of every file."""
    path = _layer_files(spark, grid(spark, sf_dir), ["value"], "float32", -99.0, 50)
    found = tiff.windowed(spark, path, (20, 40, 0, 50)).select(*_at_centre(), F.col("b")[0].alias("value"))
    return found.where("col between 10 and 40")


@query("raster_headers", f"SELECT row // 100 AS tile, 1 AS bands, CAST(max(row) - (row // 100) * 100 + 1 AS INT) AS rows, CAST(max(col) + 1 AS INT) AS cols, 500000::DOUBLE AS x, 7000000 - 3000 * (row // 100)::DOUBLE AS y, 32608 AS epsg FROM ({GRID_SQL}) GROUP BY row // 100")
def raster_headers(spark, sf_dir):
    found = tiff.headers(spark, _layer_files(spark, grid(spark, sf_dir), ["value"], "float64", None, 100))
    return found.select(F.regexp_extract("path", r"tile_(\d+)_", 1).cast("long").alias("tile"), "bands", "rows", "cols", "x", "y", "epsg")


@query("shape_moments", _label_sql(False) + """, mo AS (SELECT label, count(*) AS n, var_pop(CAST(row AS DOUBLE)) + 1 / 12::DOUBLE AS rr, var_pop(CAST(col AS DOUBLE)) + 1 / 12::DOUBLE AS cc, CASE WHEN abs(covar_pop(CAST(row AS DOUBLE), CAST(col AS DOUBLE))) > 1e-9 THEN covar_pop(CAST(row AS DOUBLE), CAST(col AS DOUBLE)) ELSE 0 END AS rc FROM l GROUP BY label),
ei AS (SELECT *, (rr + cc) / 2 + sqrt(pow((rr - cc) / 2, 2) + rc * rc) AS l1, greatest((rr + cc) / 2 - sqrt(pow((rr - cc) / 2, 2) + rc * rc), 0) AS l2 FROM mo)
SELECT label, n AS area, round(4 * sqrt(l1), 6) AS major_axis, round(4 * sqrt(l2), 6) AS minor_axis, round(sqrt(1 - l2 / l1), 6) AS eccentricity,
  CASE WHEN abs(rr - cc) > 1e-9 OR abs(rc) > 1e-9 THEN round(0.5::DOUBLE * atan2(2 * rc, cc - rr), 6) END AS orientation FROM ei""")
def shape_moments(spark, sf_dir):
    labels = cells.components(mask(spark, sf_dir), COLS)
    s = cells.shape(labels)
    # an object that is alike in all directions has no orientation
    turned = F.when(F.col("major_axis") - F.col("minor_axis") > 1e-6, F.col("orientation"))
    return _rounded(s.select("label", "area", "major_axis", "minor_axis", "eccentricity", turned.alias("orientation")))


@query("process_order", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS archive, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS process, 0 AS auto FROM orders")
def process_order(spark, sf_dir):
    done = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select("o_orderkey", *[manifest.priority(done, o).alias(o) for o in ("archive", "process", "auto")])


@query("feature_stack", f"""WITH g AS ({GRID_SQL}), s AS (SELECT g.row, g.col, degrees(atan(sqrt(pow((r.value * 100 - l.value * 100) / 60, 2) + pow((d.value * 100 - u.value * 100) / 60, 2)))) AS slope
FROM g JOIN g l ON l.row = g.row AND l.col = g.col - 1 JOIN g r ON r.row = g.row AND r.col = g.col + 1 JOIN g u ON u.row = g.row - 1 AND u.col = g.col JOIN g d ON d.row = g.row + 1 AND d.col = g.col)
SELECT g.row, g.col, round(value, 9) AS tcb_slp, round(value + 1, 9) AS tcb_ict, round(value - 1, 9) AS tcb_cil, round(value * 2, 9) AS tcb_ciu,
  CASE WHEN value > 0 THEN round(-value, 9) END AS ndvi_slp, CASE WHEN value > 0 THEN round(value / 2, 9) END AS ndvi_ict, CASE WHEN value > 0 THEN round(value / 4, 9) END AS ndvi_cil, NULL::DOUBLE AS ndvi_ciu,
  round(value * 100, 9) AS dem, round(slope, 9) AS slope FROM g LEFT JOIN s ON s.row = g.row AND s.col = g.col""")
def feature_stack(spark, sf_dir):
    g, v = grid(spark, sf_dir), F.col("value")
    tcb = g.select("row", "col", F.array(v, v + 1, v - 1, v * 2).alias("b"))
    ndvi = g.where("value > 0").select("row", "col", F.array(-v, v / 2, v / 4).alias("b"))
    out = pipelines.feature_stack({"tcb": tcb, "ndvi": ndvi}, g.withColumn("value", v * 100), 500000.0, 7000000.0, 30.0, 8)
    return _rounded9(out.drop("lon", "lat"))


@query("segments_local_threshold", _label_sql(False).replace(f"m AS ({MASK_SQL})", f"m AS (SELECT row, col FROM ({_gauss_sql(1 / 3)}) WHERE value * 4 > 0.3)", 1) + " SELECT row, col, label FROM l")
def segments_local_threshold(spark, sf_dir):
    classes = grid(spark, sf_dir).select("row", "col", F.lit(0).alias("class"), (F.col("value") * 4).alias("value"))
    return pipelines.segments(classes, n_rows(spark, sf_dir), COLS, "local_threshold")


@query("object_perimeter", _label_sql(False) + """, s AS (SELECT unnest([-1, 1, 0, 0]) AS i, unnest([0, 0, -1, 1]) AS k),
inner_ AS (SELECT a.row, a.col FROM l a, s, l b WHERE b.row = a.row + i AND b.col = a.col + k AND b.label = a.label GROUP BY 1, 2 HAVING count(*) = 4),
edge AS (SELECT l.* FROM l LEFT JOIN inner_ n ON n.row = l.row AND n.col = l.col WHERE n.row IS NULL),
near AS (SELECT a.row, a.col, any_value(a.label) AS label, count(*) FILTER (abs(b.row - a.row) + abs(b.col - a.col) = 1) AS sides, count(*) FILTER (abs(b.row - a.row) + abs(b.col - a.col) = 2) AS corners
  FROM edge a JOIN edge b ON b.label = a.label AND b.row BETWEEN a.row - 1 AND a.row + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 GROUP BY 1, 2)
SELECT label, round(sum(CASE WHEN sides IN (2, 3) AND corners <= 2 THEN 1 WHEN (sides = 0 AND corners = 2) OR (sides = 1 AND corners = 3) THEN sqrt(2)
  WHEN sides = 1 AND corners IN (1, 2) THEN (1 + sqrt(2)) / 2 ELSE 0 END), 6) AS perimeter FROM near GROUP BY label""")
def object_perimeter(spark, sf_dir):
    return _rounded(cells.perimeter(cells.components(mask(spark, sf_dir), COLS)))


# --- warps between systems ------------------------------------------------------------------------------------------


def _degrees_sql(source: str, zone: int) -> str:
    """source (px, py, ..) with lon and lat in degrees."""
    north = "".join(f" - {b!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(projection.BETA, 1))
    east = "".join(f" - {b!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(projection.BETA, 1))
    lat = "".join(f" + {d!r}::DOUBLE * sin({2 * j} * chi)" for j, d in enumerate(projection.DELTA, 1))
    return f"""SELECT *, degrees(atan2(sinh(east), cos(north))) + {projection.central_meridian(zone)} AS lon, degrees(chi{lat}) AS lat
FROM (SELECT *, asin(sin(north) / cosh(east)) AS chi FROM (SELECT *, xi{north} AS north, eta{east} AS east
FROM (SELECT *, py / {projection.RADIUS!r}::DOUBLE AS xi, (px - 500000) / {projection.RADIUS!r}::DOUBLE AS eta FROM ({source}))))"""


def _metres_sql(source: str, zone: int) -> str:
    """source (lon, lat, ..) with mx and my in metres."""
    sine, turn = "sin(radians(lat))", f"radians(lon - ({projection.central_meridian(zone)}))"
    east = "".join(f" + {a!r}::DOUBLE * cos({2 * j} * xi2) * sinh({2 * j} * eta2)" for j, a in enumerate(projection.ALPHA, 1))
    north = "".join(f" + {a!r}::DOUBLE * sin({2 * j} * xi2) * cosh({2 * j} * eta2)" for j, a in enumerate(projection.ALPHA, 1))
    return f"""SELECT *, 500000 + {projection.RADIUS!r}::DOUBLE * (eta2{east}) AS mx, {projection.RADIUS!r}::DOUBLE * (xi2{north}) AS my
FROM (SELECT *, atan2(t, cos(turn)) AS xi2, atanh(sin(turn) / sqrt(1 + t * t)) AS eta2
FROM (SELECT *, sinh(atanh({sine}) - {projection.ROOT!r}::DOUBLE * atanh({projection.ROOT!r}::DOUBLE * {sine})) AS t, {turn} AS turn FROM ({source})))"""


#: Candidates are the cells of zone 9 that lie within two of a source cell's middle there.
_THERE_SQL = _metres_sql(_degrees_sql(f"SELECT 500000 + 30 * (col + 0.5::DOUBLE) AS px, 7000000 - 30 * (row + 0.5::DOUBLE) AS py FROM ({GRID_SQL})", 8), 9)
_BACK_SQL = _metres_sql(_degrees_sql(f"""SELECT DISTINCT 30 * (CAST(floor(mx / 30) AS BIGINT) + i + 0.5::DOUBLE) AS px, 30 * (CAST(floor(my / 30) AS BIGINT) + k + 0.5::DOUBLE) AS py
FROM ({_THERE_SQL}), (SELECT unnest([-2, -1, 0, 1, 2]) AS i) oi, (SELECT unnest([-2, -1, 0, 1, 2]) AS k) ok""", 9), 8)


@query("warp_zones", f"""SELECT px AS x, py AS y, round(g.value, 9) AS value FROM ({_BACK_SQL}) b
JOIN ({GRID_SQL}) g ON g.row = CAST(floor((7000000 - my) / 30) AS BIGINT) AND g.col = CAST(floor((mx - 500000) / 30) AS BIGINT)""")
def warp_zones(spark, sf_dir):
    """The raster of zone 8 as one of zone 9, where it lies outside the zone's own six degrees; nearest cells."""
    source = warp.Grid(500000.0, 7000000.0, 30.0, n_rows(spark, sf_dir), COLS, 8)
    target = warp.covering(source, 9, 30.0)
    found = warp.warped(grid(spark, sf_dir), source, target)
    x, y = projection.cell_centres(F.col("row"), F.col("col"), target.x0, target.y0, target.size)
    return found.select(x.alias("x"), y.alias("y"), F.round("value", 9).alias("value"))


@query("newest_mosaic", """SELECT user_id // 10 AS tile, user_id AS row, length(event_type) AS col, value, event_id FROM events WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id, length(event_type) ORDER BY ts DESC, event_id DESC) = 1""")
def newest_mosaic(spark, sf_dir):
    """Events as observations of cells, streamed from three files, a batch each, into a mosaic by tile."""
    e = table(spark, sf_dir, "events").select(F.expr("user_id div 10").alias("tile"), F.col("user_id").alias("row"), F.length("event_type").cast("long").alias("col"), "value", "ts", "event_id")
    folder = f"{shared_folder(spark)}/mosaic-{uuid.uuid4().hex}"
    e.repartition(3, "event_id").write.parquet(f"{folder}/in")
    arriving = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    kept = Mosaic(f"{folder}/mosaic", order=("ts", "event_id"))
    run_once(arriving, kept.commit, f"{folder}/offsets").awaitTermination()
    return kept.read(spark).drop("ts")
