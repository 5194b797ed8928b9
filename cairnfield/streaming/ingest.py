"""Incremental ingest: new files of a folder run through a pipeline once each, as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnfield.functions.scene_names import is_input_tile, tile_parts

FILES = "path string, modificationTime timestamp, length long, content binary"


def tile_events(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (filepath, basename, period, site, lat, lon) of input tiles that arrive in a folder."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").load(folder)
    named = files.select(F.col("path").alias("filepath"), F.element_at(F.split("path", "/"), -1).alias("basename"))
    return named.where(is_input_tile(F.col("basename"))).withColumns(tile_parts(F.col("basename")))


def run_once(events: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands what has arrived since the last run to work, batch by batch, and stops.

    A batch may come again after a failure, with the same number; work should overwrite by it.
    """
    return events.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
