"""Web archives and their index of captures.

Pages are written as WARC records by Spark's text writer, whose line separator is the blank line that ends a record;
so commits, retries and remote stores are Spark's business. Every record of one write carries the write's own id right
after its version line, and the reader splits files at that whole sequence, which no payload can hold. The blank line
before it is no part of the delimiter: Hadoop's line reader forgets a partial match at the end of its buffer, so a run of
line ends before a delimiter that starts with line ends hides it. Records read are counted against rows written.

The index is merged externally: each task's captures, sorted by URL key and time, are one run in the shared folder; a
range partitioning by (URL key, time, page), held as one sortable string, cuts all runs into slices, and every task merges
its slices of the runs through a loser tree. Ranges cover the page id too, so a URL with a third of all captures is spread
over many tasks.

Defined cases: null html is an empty payload; a null url has an empty URL key; equal payloads are revisits of the one
with the largest page_id (rows that repeat this page_id are responses too; a null page_id is never referred to, and
is a revisit where another page has its payload); white space in a URL is percent-encoded in the archive; other columns
take no part, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import new_path, stored, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_REVISIT_BYTES = 0
#: Digests of repeated payloads that may be broadcast: at most so many rows of 60 bytes.
BROADCAST_ROWS = 200_000
#: Captures that a task merges: some 50 MB of keys.
MERGE_ROWS = 250_000
CAPTURE = ("page_id", "url", "html", "captured")
END = "\r\n\r\n"
EPOCH = 1_704_067_200


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1, from four 40-bit parts of its hexadecimal form."""
    out = []
    for k in range(4):
        part = F.conv(F.substring(F.sha1(payload), 10 * k + 1, 10), 16, 10).cast("long")
        for j in range(8):
            at = F.shiftright(part, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1
            out.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*out)


def url_key(url: Column) -> Column:
    """The URL's sort key: host labels reversed, then port, path and query; lower case, no scheme, no leading www."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://(?:www\d*\.)?", "")
    host = F.regexp_extract(bare, r"^([^/:?#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(bare, r"^[^/:?#]*", ""))


def with_payloads(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html, captured) with the payload's size and digest."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": base32_sha1(body)})


def referred(pages: DataFrame, min_bytes: int) -> DataFrame:
    """pages with response_id: the largest page_id of the rows with an equal payload, if another row has it."""
    known = with_payloads(pages.select(*CAPTURE))
    groups = known.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    repeated = groups.agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = stored(repeated, "repeated-payloads")
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return known.join(F.broadcast(repeated) if small else repeated, ["payload_digest", "payload_bytes"], "left")


def record_id(page_id: Column) -> Column:
    hexed = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    return F.concat(F.lit("<urn:uuid:00000000-0000-4000-"), F.substring(hexed, 1, 4), F.lit("-"), F.substring(hexed, 5, 12), F.lit(">"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> str:
    """Writes a record for each row of pages (page_id, url, html, captured timestamp); returns the write's id."""
    own = str(uuid.uuid4())
    rows = referred(pages, min_bytes)
    visit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    size = F.col("payload_bytes").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    block = F.when(visit, http).otherwise(F.concat(http, F.coalesce("html", F.lit(""))))
    when = F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\s\p{Cntrl}]", "%20")
    refers = F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
        record_id(F.col("response_id")), F.lit("\r\nX-Refers-To-Page: "), F.col("response_id").cast("string"), F.lit("\r\n"),
    )
    record = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Warcinfo-ID: <urn:uuid:{own}>\r\nWARC-Type: "), F.when(visit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), F.coalesce(record_id(F.col("page_id")), F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>")),
        F.lit("\r\nX-Page: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Date: "), F.coalesce(when, F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n"),
        F.when(visit, refers).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("__block").cast("string"), F.lit(END), F.col("__block"),
    )
    rows.withColumn("__block", block).select(record.alias("value")).write.option("lineSep", END).text(path)
    return own


def read_warc(spark: SparkSession, path: str, own: str) -> DataFrame:
    """The records of a write: page_id, url, captured, record_type, refers_to, payload_bytes, payload_digest, payload, archive.

    payload is null for revisits, whose size and digest are those of the full payload.
    """
    # holds no blank line, and a blank line stands before it: no match that starts earlier can reach into it
    first = f"WARC/1.1\r\nWARC-Warcinfo-ID: <urn:uuid:{own}>\r\n"
    raw = spark.read.option("lineSep", first).text(path).select("value", F.col("_metadata.file_name").alias("archive")).where("value <> ''")
    head = F.substring_index("value", END, 1)
    rows = raw.select(
        F.concat(F.lit("\r\n"), head, F.lit("\r\n")).alias("head"),
        F.expr("substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + 5)").alias("rest"),
        "archive",
    )

    def named(name: str) -> Column:
        return F.substring_index(F.substring_index(F.col("head"), f"\r\n{name}: ", -1), "\r\n", 1)

    def maybe(name: str) -> Column:
        return F.when(F.contains(F.col("head"), F.lit(f"\r\n{name}: ")), named(name))

    # each record still has its blank line, which Content-Length cuts away
    rows = rows.select(
        F.nullif(named("X-Page"), F.lit("")).cast("long").alias("page_id"),
        named("WARC-Target-URI").alias("url"),
        F.to_timestamp(F.nullif(named("WARC-Date"), F.lit("")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        named("WARC-Type").alias("record_type"),
        maybe("X-Refers-To-Page").cast("long").alias("refers_to"),
        F.substring_index(named("WARC-Payload-Digest"), ":", -1).alias("stated_digest"),
        named("Content-Length").cast("long").alias("block_bytes"),
        F.col("rest").cast("binary").alias("rest"),
        "archive",
    )
    block = F.expr("substring(rest, 1, cast(block_bytes as int))")
    http_head = F.substring_index(F.expr("cast(substring(rest, 1, 400) as string)"), END, 1)
    rows = rows.withColumns({"block": block, "http_bytes": F.octet_length(http_head) + 4, "stated_bytes": F.regexp_extract(http_head, r"Content-Length: (\d+)", 1).cast("long")})
    payload = F.when(F.col("record_type") == "response", F.expr("substring(block, http_bytes + 1)"))
    rows = rows.withColumn("payload", payload)
    return rows.select(
        "page_id", "url", "captured", "record_type", "refers_to",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("stated_bytes")).alias("payload_bytes"),
        F.coalesce(base32_sha1(F.col("payload")), F.col("stated_digest")).alias("payload_digest"),
        "payload", "archive",
    )


class LoserTree:
    """Merges k sorted sequences of keys: inner nodes hold losers, so the next winner costs log2 k comparisons."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = max(1, len(runs))
        self.nodes = [-1] * self.k
        for leaf in range(len(runs)):
            self._play(leaf)

    def _before(self, x: int, y: int) -> bool:
        """Whether run x's next key comes before run y's; ended runs come last, ties go to the earlier run."""
        if self.at[x] >= len(self.runs[x]):
            return False
        if self.at[y] >= len(self.runs[y]):
            return True
        p, q = self.runs[x][self.at[x]], self.runs[y][self.at[y]]
        return p < q or p == q and x < y

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.nodes[node]
            if other < 0:  # the first to come waits here
                self.nodes[node] = winner
                return
            if self._before(other, winner):
                self.nodes[node], winner = winner, other
            node //= 2
        self.nodes[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in run) in the order of the keys."""
        while self.runs:
            w = self.nodes[0]
            if self.at[w] >= len(self.runs[w]):
                return
            yield w, self.at[w]
            self.at[w] += 1
            self._play(w)


def sort_key(url_key: Column, captured: Column, page_id: Column) -> Column:
    """One string that sorts as (URL key, time, page) do, nulls first: numbers as hexadecimal digits with the sign turned."""

    def digits(number: Column) -> Column:
        turned = F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        return F.when(number.isNull(), "0").otherwise(F.concat(F.lit("1"), turned))

    return F.concat(url_key, F.lit("\x00"), digits(F.unix_micros(captured)), digits(page_id.cast("long")))


def sorted_runs(captures: DataFrame, name: str = "capture-runs") -> DataFrame:
    """captures with url_key, sort_key, and the run (one for each task) and place that its sorted file gives each row."""
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    keyed = keyed.withColumn("sort_key", sort_key(F.col("url_key"), F.col("captured"), F.col("page_id")))
    ordered = keyed.sortWithinPartitions("sort_key").withColumn("__id", F.monotonically_increasing_id())
    # the id's high bits number the task, the low 33 the row
    return stored(ordered.withColumns({"run": F.shiftright("__id", 33), "place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id"), name)


def merge_runs(runs: DataFrame, rows_a_task: int = MERGE_ROWS) -> DataFrame:
    """The rows of all runs in one global order: partitions follow each other by (url_key, captured, page_id)."""
    n = max(1, -(-runs.count() // rows_a_task))
    sliced = runs.repartitionByRange(n, "sort_key").sortWithinPartitions("run", "place")
    at = [sliced.columns.index(c) for c in ("run", "sort_key")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        keys, owner = whole.column(at[1]).to_pylist(), whole.column(at[0]).to_numpy()
        starts = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist()]
        slices = [keys[s:e] for s, e in zip(starts, [*starts[1:], len(owner)], strict=True)]
        merged = whole.take(pa.array([starts[r] + p for r, p in LoserTree(slices)], pa.int64()))
        yield from merged.to_batches(max_chunksize=10_000)

    return sliced.mapInArrow(run, sliced.schema)


def capture_histories(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes pages as archives in the shared folder, reads them back, and merges their index.

    A URL's captures stand together in order of time, with what read_warc says of each but for the payload.
    """
    path = new_path(pages.sparkSession, "warc")
    own = write_warc(pages, path, min_bytes)
    runs = sorted_runs(read_warc(pages.sparkSession, path, own).drop("payload"))
    read, written = runs.count(), pages.count()
    if read != written:
        raise RuntimeError(f"{read} records read of {written} written to {path}")
    return merge_runs(runs)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", F.timestamp_seconds(F.col("page_id") + EPOCH).alias("captured"))
    out = capture_histories(pages)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}',
    CAST(((CAST('0x' || substr(h, CAST((i // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY h, payload_bytes) AS response_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response_id THEN response_id END AS refers_to
FROM d
"""
