"""File listings as DataFrames: the manifest of scenes, and what is stale or missing in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions import scene_names as N


def listed(spark: SparkSession, folder: str, pattern: str = "*.tif", recursive: bool = False) -> DataFrame:
    """(filepath, basename, timestamp, length) of a folder's files; their contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return _facts(reader.load(folder))


def listed_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The same for an explicit list of files."""
    return _facts(spark.read.format("binaryFile").load(paths))


def _facts(files: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.col("path").alias("filepath"), name.alias("basename"), F.col("modificationTime").alias("timestamp"), "length")


def manifest(files: DataFrame, months: tuple[int, int] = (7, 8), years: tuple[int, int] = (1985, 2017)) -> DataFrame:
    """Dates, sensor and validity of each listed file; names that cannot be read are kept as invalid."""
    date = N.scene_date(F.col("basename"))
    out = files.withColumns({"date": date, "sensor": N.sensor_of(F.col("basename")), "naming_version": N.naming_version(F.col("basename"))})
    d = F.col("date")
    out = out.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d), "doy": F.dayofyear(d), "ordinal_day": N.ordinal_day(d)})
    valid = F.col("naming_version").isNotNull() & d.isNotNull()
    fits = F.col("month").between(*months) & F.col("year").between(*years)
    return out.withColumns({"valid_name": valid, "valid_filter": F.coalesce(valid & fits, F.lit(False))}).withColumn("process", F.col("valid_name") & F.col("valid_filter"))


def archives(files: DataFrame) -> DataFrame:
    """Base names of archives (.tar.gz, .zip, .7z ..), without directories and endings."""
    return files.withColumn("scene", F.regexp_replace("basename", r"\.(tar\.gz|tgz|tar\.bz|zip|7z)$", "")).where(F.col("scene") != F.col("basename"))


def report(items: DataFrame, stage: str, ok: str) -> DataFrame:
    """Number of finished and failed items of a stage."""
    return items.groupBy(F.lit(stage).alias("stage")).agg(F.count_if(F.col(ok)).alias("finished"), F.count_if(~F.coalesce(F.col(ok), F.lit(False))).alias("failed"))


def priority(done: Column, order: str) -> Column:
    """0 for files that go first and 1 for the others: archive takes those that are done first, process those that are not.

    With auto, or any other order, all are alike.
    """
    first = {"archive": done, "process": ~done}.get(order, F.lit(True))
    return F.when(F.coalesce(first, F.lit(order == "process")), 0).otherwise(1)


def in_order(files: DataFrame, order: str = "auto", done: str = "done") -> DataFrame:
    """files by priority and then by path."""
    return files.orderBy(priority(F.col(done), order), "filepath")


def folders(files: DataFrame) -> DataFrame:
    """(folder, n_files): the names of the folders that hold the listed files."""
    return files.groupBy(F.element_at(F.split("filepath", "/"), -2).alias("folder")).agg(F.count("*").alias("n_files"))


def readiness(files: DataFrame, bands: int = 6) -> DataFrame:
    """For each folder, whether it has one metadata file, a mask (and of which kind) and all band files of a scene.

    The older mask is taken where both kinds are there.
    """
    name = F.lower("basename")
    meta = name.endswith(".xml") & ~name.contains(".aux.")
    count = lambda c: F.count_if(c)
    out = files.groupBy(F.regexp_extract("filepath", r"^(.*)/[^/]*$", 1).alias("folder")).agg(
        count(meta).alias("n_meta"), count(name.endswith("cfmask.tif")).alias("n_cfmask"), count(name.endswith("pixel_qa.tif")).alias("n_qa"),
        count(name.rlike(r"band\d+\.tif$")).alias("n_bands"),
    )
    kind = F.when(F.col("n_cfmask") > 0, "cfmask").when(F.col("n_qa") > 0, "pixel_qa")
    return out.select("folder", (F.col("n_meta") == 1).alias("meta_ok"), kind.alias("mask_kind"), (F.col("n_bands") >= bands).alias("bands_ok")).withColumn("ready", F.col("meta_ok") & F.col("mask_kind").isNotNull() & F.col("bands_ok"))
