import os

import pyarrow as pa

from cairnfield.llm._shared import drop_stored, own_dir, parts_of, stored


def test_stored_tables_go_when_they_are_dropped(spark):
    df = stored(spark.range(5), "some")
    assert df.count() == 5 and os.listdir(own_dir(spark).removeprefix("file://"))
    drop_stored(spark)
    assert not os.path.exists(own_dir(spark).removeprefix("file://"))
    assert stored(spark.range(3), "more").count() == 3


def test_parts_hold_rows_and_bytes_at_most():
    texts = ["a" * 10, None, "", "é" * 30, "b" * 500, "c", "d", "e"]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts, pa.string())], names=["i", "text"])
    parts = [p.column(0).to_pylist() for p in parts_of(batch, 1, 3, 80)]
    assert parts == [[0, 1, 2], [3], [4], [5, 6, 7]]
    assert list(parts_of(batch.slice(0, 0), 1, 3)) == []
