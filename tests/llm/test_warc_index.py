import base64
import hashlib
import random
from datetime import datetime

from pyspark.sql import functions as F

from cairnfield.llm._shared import new_path
from cairnfield.llm.warc_index import END, LoserTree, capture_histories, merge_runs, read_warc, sort_key, sorted_runs, url_key, write_warc

KIND = "page_id long, url string, html string, captured timestamp, archive string"
WHEN = datetime(2024, 1, 1)


def pages(spark, rows):
    return spark.createDataFrame([(*r, WHEN, "x") for r in rows], KIND).repartition(3)


def test_loser_tree_merges_any_runs():
    rng = random.Random(7)
    for _ in range(200):
        runs = [sorted(rng.randint(0, 9) for _ in range(rng.randint(0, 8))) for _ in range(rng.randint(0, 9))]
        got = [runs[r][p] for r, p in LoserTree(runs)]
        assert got == sorted(x for r in runs for x in r)


def test_round_trip_of_hard_payloads(spark):
    hard = ["", None, "a" + END + "b", END, "WARC/1.1\r\nWARC-Type: response" + END, "é \U0001f600\x00z", "Content-Length: 3\r\n", "x\n", "\r\n", "long " * 50_000]
    rows = [(i, f"http://h.example/a b\n{i}", h) for i, h in enumerate(hard)] + [(None, None, "lone"), (90, "http://x", "é \U0001f600\x00z"), (90, "http://x", "é \U0001f600\x00z")]
    path = new_path(spark, "warc-test")
    own = write_warc(pages(spark, rows), path)
    got = read_warc(spark, path, own).collect()
    assert len(got) == len(rows)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        raw = html.encode()
        assert r.payload_bytes == len(raw)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        same = max((i for i, _, h in rows if (h or "") == html and i is not None), default=None)
        if r.page_id is None or same == r.page_id:
            assert r.record_type == "response" and r.refers_to is None and bytes(r.payload) == raw
        else:
            assert r.record_type == "revisit" and r.refers_to == same and r.payload is None


def test_no_revisit_is_lost_at_a_buffers_end(spark):
    n = 300_000
    rows = spark.range(n, numPartitions=4).selectExpr("id as page_id", "'http://h.example/' || id as url", "'' as html", "timestamp'2024-01-01' as captured")
    path = new_path(spark, "warc-many")
    got = read_warc(spark, path, write_warc(rows, path)).agg(F.count("*").alias("n"), F.countDistinct("page_id").alias("ids"), F.sum((F.col("record_type") == "revisit").cast("int")).alias("revisits")).first()
    assert (got.n, got.ids, got.revisits) == (n, n, n - 1)


def test_small_payloads_are_not_revisits(spark):
    rows = [(1, "http://a", "ab"), (2, "http://a", "ab"), (3, "http://a", "abcd"), (4, "http://a", "abcd")]
    got = {r.page_id: r.record_type for r in capture_histories(pages(spark, rows), min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_histories_are_in_one_global_order(spark):
    rng = random.Random(3)
    rows = [(i, f"http://www.h{rng.randint(0, 3)}.example/p{rng.randint(0, 2)}", str(i)) for i in range(300)] + [(None, None, "n")]
    runs = sorted_runs(pages(spark, rows).drop("archive"), "runs-test")
    assert runs.select("run").distinct().count() > 1
    merged = merge_runs(runs, rows_a_task=40)
    assert merged.rdd.getNumPartitions() > 3
    got = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in merged.collect()]
    assert len(got) == 301 and got == sorted(got)
    assert ")" == got[0][0] and "example,h0)/p0" in {k for k, _, _ in got}


def test_empty_table(spark):
    assert capture_histories(pages(spark, [])).count() == 0


def test_columns_that_clash_take_no_part(spark):
    names = ["payload_bytes", "payload_digest", "response_id", "__block", "run", "place", "url_key", "sort_key", "record_type"]
    rows = [(i, "http://a", "ab", WHEN, *["x"] * len(names)) for i in range(3)]
    got = capture_histories(spark.createDataFrame(rows, ["page_id", "url", "html", "captured", *names])).collect()
    assert [(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got] == [(0, "revisit", 2, 2), (1, "revisit", 2, 2), (2, "response", None, 2)]


def test_sort_keys_sort_as_their_parts(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, -5, 0, 7, 2**62]), rng.choice(["http://a.b/c", "http://a.b", "http://é.b/", None]), "", rng.choice([None, WHEN, datetime(1960, 5, 5)])) for _ in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, captured timestamp").withColumn("k", url_key(F.col("url")))
    parts = [(r.k, r.captured, r.page_id) for r in df.orderBy("k", "captured", "page_id").collect()]
    assert parts == [(r.k, r.captured, r.page_id) for r in df.orderBy(sort_key(F.col("k"), F.col("captured"), F.col("page_id"))).collect()]
