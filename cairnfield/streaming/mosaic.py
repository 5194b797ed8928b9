"""A mosaic that is kept over time: the newest value of each cell, in versions of tiles that are swapped at once.

    <folder>/tiles/batch=<n>     all cells of the tiles that batch n changed
    <folder>/manifest-<n>        (tile, batch): the version of every tile after batch n

A batch reads and writes the tiles that it touches alone. It is there once its manifest is whole, which Spark's success marker
tells; a batch that was killed leaves the version before it, and the same batch run again overwrites what it has left. So a stream
that hands batches on by number, as foreachBatch does, gives the rows of one run over all of them, whatever order they come in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mosaic:
    """cell names a cell within its tile; of rows of one cell the one that is last by order is kept.

    Order columns should tell rows apart, else any of the last ones may stay. Rows with a null value are no observations; rows
    without a tile form a tile of their own.
    """

    folder: str
    tile: str = "tile"
    cell: tuple[str, ...] = ("row", "col")
    order: tuple[str, ...] = ("stamp",)
    value: str = "value"

    def newest(self, rows: DataFrame) -> DataFrame:
        keys = [self.tile, *self.cell]
        rest = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("__last"))
        return last.select(*keys, *[F.col("__last")[c].alias(c) for c in rest]).select(rows.columns)

    def _files(self, spark: SparkSession) -> tuple:
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches that are there, whose manifests have not been cleared."""
        system, path = self._files(spark)
        marked = system.globStatus(path(f"{self.folder}/manifest-*/_SUCCESS")) or []
        return sorted(int(m.getPath().getParent().getName().rsplit("-", 1)[1]) for m in marked)

    def manifest(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/manifest-{number}")

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The cells after a batch, by default the last one that is there; an error where there is none."""
        number = self.versions(spark)[-1] if number is None else number
        tiles, named = spark.read.parquet(f"{self.folder}/tiles"), self.manifest(spark, number)
        same = tiles[self.tile].eqNullSafe(named[self.tile]) & (tiles["batch"] == named["batch"])
        return tiles.join(named, same, "left_semi").drop("batch")

    def commit(self, batch: DataFrame, number: int) -> None:
        """Adds a batch; for foreachBatch. Batches before it must be there, and it may come again."""
        spark = batch.sparkSession
        before = [n for n in self.versions(spark) if n < number]
        rows = self.newest(batch.where(F.col(self.value).isNotNull()))
        if before:
            met = rows.select(F.col(self.tile).alias("__met")).distinct()
            held = self.read(spark, before[-1])
            held = held.join(met, held[self.tile].eqNullSafe(F.col("__met")), "left_semi")
            rows = self.newest(held.unionByName(rows))
        rows.write.mode("overwrite").parquet(f"{self.folder}/tiles/batch={number}")
        made = spark.read.schema(rows.schema).parquet(f"{self.folder}/tiles/batch={number}").select(self.tile).distinct()
        named = made.withColumn("batch", F.lit(number).cast("long"))
        if before:
            old, new = self.manifest(spark, before[-1]), made.withColumnRenamed(self.tile, "__met")
            named = named.unionByName(old.join(new, old[self.tile].eqNullSafe(new["__met"]), "left_anti"))
        named.write.mode("overwrite").parquet(f"{self.folder}/manifest-{number}")

    def clear(self, spark: SparkSession) -> None:
        """Deletes tiles that the last version does not name and the manifests before it; no reader of these may be under way."""
        system, path = self._files(spark)
        *old, last = self.versions(spark)
        used = {r.batch for r in self.manifest(spark, last).select("batch").distinct().collect()}  # one number a batch
        for status in system.globStatus(path(f"{self.folder}/tiles/batch=*")) or []:
            number = int(status.getPath().getName().split("=")[1])
            if number < last and number not in used:
                system.delete(status.getPath(), True)
        for number in old:
            system.delete(path(f"{self.folder}/manifest-{number}"), True)
