"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space 0x09-0x0D and 0x20, as the word and line contracts name it.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode, our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cairnfield-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """The application's part of the shared folder."""
    return f"{shared_dir(spark)}/cairnfield/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_stored(spark: SparkSession) -> None:
    """Deletes all that the application has stored. Results read from it, so write those elsewhere before."""
    dropped(spark, own_dir(spark))


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends at files that outlive executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII takes the fast built-in, which does just that."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def beside(docs: DataFrame) -> DataFrame:
    """docs with every column but doc_id and text under a positional name, which no operator's output clashes with."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"column{k}" for k, c in enumerate(docs.columns)])


def named_as(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, under their own names, of rows that an operator has made from beside(docs)."""
    return out.select(beside(docs).columns).toDF(*docs.columns)


def parts_of(batch, column: int, rows: int, octets: int = 4 << 20) -> Iterator:  # noqa: ANN001
    """Slices of an Arrow batch of `rows` rows at most and, but for single longer texts, `octets` bytes of a text column."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + octets, side="right"))
        end = max(at + 1, min(at + rows, full))
        yield batch.slice(at, end - at)
        at = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
