import random

import pytest
from pyspark.sql import functions as F

from cairnfield.streaming.ingest import run_once
from cairnfield.streaming.mosaic import Mosaic

SCHEMA = "tile long, row long, col long, value double, stamp long, id long"


def made(n=400, seed=3):
    rng = random.Random(seed)
    return [(rng.choice([None, 0, 1, 2, 3]), rng.randrange(4), rng.randrange(4), rng.choice([None, float(k)]), rng.randrange(20), k) for k in range(n)]


def wanted(rows):
    best = {}
    for r in rows:
        if r[3] is not None and (r[:3] not in best or r[4:] > best[r[:3]][4:]):
            best[r[:3]] = r
    return sorted(best.values(), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("tile", "row", "col", "value", "stamp", "id").collect()), key=repr)


def test_a_killed_stream_gives_the_rows_of_one_run(spark, tmp_path):
    rows = made()
    for k in range(4):
        spark.createDataFrame(rows[k::4], SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    m = Mosaic(f"file://{tmp_path}/mosaic", order=("stamp", "id"))
    runs = []

    def work(batch, number):
        runs.append(number)
        if runs == [0, 1]:  # its tiles are half there, its manifest is not
            batch.limit(3).write.parquet(f"{m.folder}/tiles/batch={number}")
            raise RuntimeError("killed")
        m.commit(batch, number)

    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    with pytest.raises(Exception, match="killed"):
        run_once(stream(), work, f"file://{tmp_path}/checkpoint").awaitTermination()
    first = found(m.read(spark))
    assert m.versions(spark) == [0] and 0 < len(first)
    run_once(stream(), work, f"file://{tmp_path}/checkpoint").awaitTermination()
    assert runs == [0, 1, 1, 2, 3] and found(m.read(spark)) == wanted(rows) and found(m.read(spark, 0)) == first
    m.commit(spark.createDataFrame(rows[:5], SCHEMA), 3)  # comes again with other rows: nothing is newer
    m.clear(spark)
    assert m.versions(spark) == [3] and len(found(m.read(spark))) <= len(wanted(rows))


def test_untouched_tiles_keep_their_version(spark, tmp_path):
    m = Mosaic(f"file://{tmp_path}/m", order=("stamp", "id"))
    m.commit(spark.createDataFrame([(1, 0, 0, 1.0, 5, 0), (2, 0, 0, 2.0, 5, 1)], SCHEMA), 0)
    m.commit(spark.createDataFrame([(2, 0, 0, 9.0, 4, 2), (2, 0, 1, 3.0, 1, 3)], SCHEMA), 1)
    m.commit(spark.createDataFrame([], SCHEMA), 2)
    assert {tuple(r) for r in m.manifest(spark, 2).select("tile", "batch").collect()} == {(1, 0), (2, 1)}
    assert found(m.read(spark)) == [(1, 0, 0, 1.0, 5, 0), (2, 0, 0, 2.0, 5, 1), (2, 0, 1, 3.0, 1, 3)]
    m.clear(spark)
    assert found(m.read(spark)) == [(1, 0, 0, 1.0, 5, 0), (2, 0, 0, 2.0, 5, 1), (2, 0, 1, 3.0, 1, 3)]


def test_an_empty_first_batch(spark, tmp_path):
    m = Mosaic(f"file://{tmp_path}/m")
    empty = spark.createDataFrame([], SCHEMA)
    m.commit(empty, 0)
    assert m.read(spark).count() == 0 and m.newest(empty).count() == 0
    m.commit(spark.createDataFrame([(7, 1, 1, 1.0, 1, 1)] * 3, SCHEMA).withColumn("value", F.col("value")), 1)
    assert found(m.read(spark)) == [(7, 1, 1, 1.0, 1, 1)]
