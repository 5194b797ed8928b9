"""Vector data as GeoJSON: files of features as tables of boxes, and rows as features with a geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Coordinates and properties stay text until it is known what they are.
COLLECTION = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"


def features(texts: DataFrame, column: str = "value") -> DataFrame:
    """(properties, kind, coordinates, xmin, xmax, ymin, ymax) of each feature of GeoJSON texts.

    The box goes around all positions of the geometry; a feature without a geometry has nulls.
    """
    found = texts.select(F.explode(F.from_json(column, COLLECTION)["features"]).alias("f")).select("f.properties", "f.geometry.type", "f.geometry.coordinates")
    position = F.lit(rf"\[\s*({NUMBER})\s*,\s*({NUMBER})")
    ends = {}
    for k, axis in ((1, "x"), (2, "y")):
        numbers = F.transform(F.regexp_extract_all("coordinates", position, k), lambda v: v.cast("double"))
        numbers = F.when(F.size(numbers) > 0, numbers)
        ends |= {f"{axis}min": F.array_min(numbers), f"{axis}max": F.array_max(numbers)}
    return found.withColumnRenamed("type", "kind").withColumns(ends)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The features of GeoJSON files, each a collection."""
    return features(spark.read.text(path, wholetext=True))


def point(x: Column, y: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    ring = F.array(*[F.array(x, y) for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))])
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def polygons(rings: Column) -> Column:
    """A geometry of an array of outer rings, each an array of positions."""
    return F.struct(F.lit("MultiPolygon").alias("type"), F.transform(rings, lambda r: F.array(r)).alias("coordinates"))
