"""Sinks: tables that are made only if absent, typed layers by tile, polygons as text and GeoJSON, provenance columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def if_absent(df: DataFrame, path: str, kind: str = "parquet", *by: str) -> None:
    """Writes df unless the path is there already."""
    df.write.mode("ignore").format(kind).option("header", "true").partitionBy(*by).save(path)


def with_provenance(df: DataFrame, **facts: str) -> DataFrame:
    """A map column of how a layer was made: algorithm, years, months, mode, version."""
    return df.withColumn("provenance", F.create_map(*[F.lit(x) for kv in sorted(facts.items()) for x in kv]))


def cell_rings(labels: DataFrame) -> DataFrame:
    """(label, rings): each object as rings of unit squares; runs of cells in a row are one rectangle."""
    w = "row_number() over (partition by label, row order by col)"
    runs = labels.select("label", "row", "col", (F.col("col") - F.expr(w)).alias("island")).groupBy("label", "row", "island").agg(F.min("col").alias("a"), (F.max("col") + 1).alias("b"))
    low = F.col("row") + 1
    ring = F.array(*[F.array(F.col(x).cast("long"), y.cast("long")) for x, y in (("a", F.col("row")), ("b", F.col("row")), ("b", low), ("a", low), ("a", F.col("row")))])
    return runs.groupBy("label").agg(F.array_sort(F.collect_list(ring)).alias("rings"))


def cell_polygons(labels: DataFrame) -> DataFrame:
    """(label, geometry): each object as WKT of unit squares; runs of cells in a row are one rectangle."""
    text = lambda r: F.concat(F.lit("(("), F.array_join(F.transform(r, lambda p: F.array_join(p.cast("array<string>"), " ")), ", "), F.lit("))"))
    parts = cell_rings(labels).select("label", F.array_sort(F.transform("rings", text)).alias("r"))
    return parts.select("label", F.concat(F.lit("MULTIPOLYGON ("), F.array_join("r", ", "), F.lit(")")).alias("geometry"))


def as_features(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One line of JSON an object: a GeoJSON feature with its attributes as properties.

    The geometry column holds a struct of sources.features, or WKT, which is given as the property wkt with a null geometry.
    """
    text = dict(df.dtypes)[geometry] == "string"
    rest = F.struct(*[c for c in df.columns if c != geometry], *([F.col(geometry).alias("wkt")] if text else []))
    shape = F.lit(None).cast("struct<type: string>") if text else F.col(geometry)
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), rest.alias("properties")), {"ignoreNullFields": "false"}).alias("value"))


def layers(cells: DataFrame, kinds: dict[str, tuple[str, float]]) -> DataFrame:
    """cells (row, col, ..) with each named layer in its type and its nodata value where it is null.

    kinds: for each layer its SQL type and nodata, such as {"class": ("tinyint", 0), "confidence": ("float", -1)}.
    """
    return cells.select("row", "col", *[F.coalesce(F.col(n).cast(kind), F.lit(nodata).cast(kind)).alias(n) for n, (kind, nodata) in kinds.items()])


def write_layers(cells: DataFrame, path: str, kinds: dict[str, tuple[str, float]], step: int = 250, mode: str = "errorifexists", **facts: str) -> None:
    """Writes typed layers in folders of square tiles, with how they were made in a provenance column."""
    by_tile(with_provenance(layers(cells, kinds), **facts, **{f"nodata_{n}": str(v) for n, (_, v) in kinds.items()}), path, step, mode)


def by_tile(cells: DataFrame, path: str, step: int = 250, mode: str = "errorifexists") -> None:
    """Writes cells (row, col, ..) in folders of square tiles, so that a window's readers open its tiles alone."""
    tiled = cells.withColumns({"tile_row": F.expr(f"row div {step}"), "tile_col": F.expr(f"col div {step}")})
    tiled.repartition("tile_row", "tile_col").write.mode(mode).partitionBy("tile_row", "tile_col").parquet(path)
