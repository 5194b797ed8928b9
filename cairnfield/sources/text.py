"""Text sources: key = value metadata, XML, site tables, the Earth-Sun distance table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def value_of(text: Column, feature: str) -> Column:
    """struct(text, number): the value of the first 'KEY = value' line whose key contains the feature."""
    key = lambda line: F.split(line, "=", 2)[0]
    held = F.filter(F.split(text, "\r?\n"), lambda line: line.contains("=") & key(line).contains(feature))
    value = F.trim(F.split(F.get(held, F.lit(0)), "=", 2)[1])
    return F.struct(value.alias("text"), value.try_cast("double").alias("number"))


def metadata(spark: SparkSession, path: str, feature: str) -> DataFrame:
    """(file, text, number): the first 'KEY = value' line of each file whose key contains the feature."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), value_of(F.col("value"), feature).alias("v"))
    return files.select("file", "v.*").where("text is not null")


def instrument(xml: Column) -> Column:
    """The text of the first <instrument> element."""
    return F.xpath_string(xml, F.lit("(//instrument)[1]"))


def site_table(df: DataFrame, base: str = "") -> DataFrame:
    """A table of sites; path columns keep their last part, below base."""
    df = df.drop(*[c for c in df.columns if c in ("", "_c0")])
    for c in (c for c in df.columns if c.endswith("_dir") or c.endswith("_file")):
        last = F.element_at(F.split(F.col(c), r"[\\/]"), -1)
        df = df.withColumn(c, F.concat(F.lit(base), last) if base else last)
    return df


def sites(spark: SparkSession, path: str, base: str = "") -> DataFrame:
    """The table of sites in a file, keyed by name."""
    return site_table(spark.read.option("header", "true").csv(path), base)


def distances(lines: DataFrame) -> DataFrame:
    """(doy, d) of lines (value) with six pairs of columns each; lines that hold no numbers are left out."""
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.struct(F.get("v", k * 2).try_cast("int").alias("doy"), F.get("v", k * 2 + 1).try_cast("double").alias("d"))))
    return lines.select(F.split("value", ",").alias("v")).select(pairs.alias("p")).select("p.doy", "p.d").where("doy is not null and d is not null")


def sun_distance(spark: SparkSession, path: str) -> DataFrame:
    """The Earth-Sun distances of a file, as distances() reads them."""
    return distances(spark.read.text(path))
