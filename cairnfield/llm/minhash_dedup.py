"""Near-duplicate documents: minima of many universal hashes, banding, signature and exact verification, components.

A document's set holds its distinct 5-word shingles. Documents of one set are one class and its smallest doc_id stands
for it, so copies cost one row each. A signature keeps 8 bits of each of 512 minima; the first of them form bands, and
documents that agree in a whole band share a bucket. Pairs are never listed within a bucket: each member is compared
with the bucket's smallest doc_id, and once those links are joined to components, only members of buckets that still
span several components are compared with one another, in blocks of bounded size inside a task, which let out only
pairs whose signatures agree enough. Every pair let out is confirmed on the full shingle sets. No link between different
components of a bucket is lost, and no bucket is capped.

Defined cases: null or blank text has an empty set and is linked with nothing; a null doc_id is linked with nothing,
its component_id is null and it is not kept; rows that repeat a doc_id are one document that holds the links of all of
them, each row with its own n_shingles; other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import dropped, new_path, parts_of, stored, table
from cairnfield.llm.components import components

WORDS = 5
HASHES = 512
#: Chance that a pair at the threshold shares no band; standard deviations of slack when signatures are compared.
MISS = 1e-4
SLACK = 4
#: Members of a bucket that are compared with one another at once; members of a star that share a task's group.
BLOCK = 1024
STAR = 256
SLICE_BYTES = 1 << 22

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SHINGLE = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _slice_words(raw: np.ndarray) -> np.ndarray:
    held = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cells = _mix(_BYTE[_LOWER[raw[held]]] + place.astype(np.uint64) * _PLACE)
    return _mix(np.add.reduceat(cells, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    parts, at = [], 0
    while len(raw) - at > SLICE_BYTES:
        white = np.flatnonzero(_SPACE[raw[at + SLICE_BYTES :]])
        if not len(white):
            break
        end = at + SLICE_BYTES + int(white[0])
        parts.append(_slice_words(raw[at:end]))
        at = end
    parts.append(_slice_words(raw[at:]))
    return np.concatenate(parts)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; of the whole sequence if it has fewer words."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = min(len(words), WORDS)
    total = np.full(len(words) - n + 1, np.uint64(n), np.uint64)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * _SHINGLE[k]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 8 bits of the minima of HASHES universal hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(least, (_A[:, None] * x[None, k : k + 256] + _B[:, None]).min(1), out=least)
    return least.astype(np.uint8)


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest rows, 7 at most, that miss a pair at the threshold by MISS at most with 32 bands."""
    for rows in range(7, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))
        if bands <= 32:
            return bands, rows
    raise ValueError(percent)


def agreement(percent: int) -> int:
    """The least number of equal signature bytes that a pair at the threshold is expected to have, less the slack."""
    p = percent / 100 + (1 - percent / 100) / 256
    return math.floor(HASHES * p - SLACK * math.sqrt(HASHES * p * (1 - p)))


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents x bands) 64-bit keys: the band's number over its bytes themselves, so equal keys are equal bytes."""
    keys = np.zeros((len(signatures), bands, 8), np.uint8)
    keys[:, :, :rows] = signatures[:, : bands * rows].reshape(-1, bands, rows)
    keys[:, :, 7] = np.arange(bands)
    return keys.view("<i8")[:, :, 0]


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, sig, bands); the 128-bit fingerprint is equal where sets are."""
    bands, rows = banding(percent)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in parts_of(batch, 1, 1000):
                sets = [shingle_set(t) for t in part.column(1).to_pylist()]
                sigs = np.array([signature(s) for s in sets]).reshape(-1, HASHES)
                with np.errstate(over="ignore"):
                    fp1 = np.array([_mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    fp2 = np.array([np.bitwise_xor.reduce(_mix(s + _PLACE)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                keys = band_keys(sigs, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
                sizes = pa.array([len(s) for s in sets], pa.int64())
                columns = [part.column(0), sizes, pa.array(fp1), pa.array(fp2), pa.array([s.tobytes() for s in sigs], pa.binary()), lists]
                yield pa.record_batch(columns, names=["doc_id", "n_shingles", "fp1", "fp2", "sig", "bands"])

    kinds = "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kinds)


def compare(pairs: DataFrame, payload: DataFrame, prepare: Callable, test: Callable) -> DataFrame:
    """The rows (a, b, n) of pairs whose payloads pass test(prepare(a's), prepare(b's)).

    n says how many partners a may have in the bucket that gave the pair. By it pairs are salted, without a join that would
    bring all pairs of a to one task: what a has is sent once to every STAR of them, and a task holds one star's head and one
    partner at a time.
    """
    # powers of two, so that buckets of about one size share their heads
    spread = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") / STAR, F.lit(1.0))))).cast("long")
    salted = pairs.withColumn("spread", spread).withColumn("salt", F.pmod(F.xxhash64("b"), F.col("spread")))
    heads = salted.select("a", "spread", "salt").distinct().select("a", "spread", "salt", F.col("a").alias("doc_id"), F.lit(0).alias("member"), F.lit(0).cast("long").alias("n"))
    need = heads.union(salted.select("a", "spread", "salt", "b", F.lit(1), "n"))
    dealt = need.hint("merge").join(payload, "doc_id").repartition("a", "spread", "salt").sortWithinPartitions("a", "spread", "salt", "member")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, heads = None, []
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            for a, spread, salt, doc_id, member, n, value in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if (a, spread, salt) != group:
                    group, heads = (a, spread, salt), []
                own = prepare(value)
                if not member:
                    heads.append(own)
                elif any(test(h, own) for h in heads):
                    found[0].append(a)
                    found[1].append(doc_id)
                    found[2].append(n)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in found], names=["a", "b", "n"])

    return dealt.select("a", "spread", "salt", "doc_id", "member", "n", "payload").mapInArrow(run, "a long, b long, n long")


def open_buckets(at: DataFrame) -> DataFrame:
    """(key, n, most, outside) of the buckets whose members, but for the hub, are of several components.

    at: (key, hub, doc_id, component). most is a component with most members, outside the number of those of others: only pairs
    with one of these are left to compare, as the hub has been compared with all.
    """
    sizes = at.where("doc_id <> hub").groupBy("key", "component").agg(F.count("*").alias("n"))
    whole = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
    return whole.where("parts > 1").select("key", "n", F.col("top.component").alias("most"), (F.col("n") - F.col("top.n")).alias("outside"))


def residual(at: DataFrame, buckets: DataFrame) -> DataFrame:
    """(key, ask, part, n, asks, doc_id, component): what is to be compared, in squares of BLOCK members of an open bucket a side.

    A square holds a block of the members outside the bucket's largest component (asks = 1) and a part of all members
    (asks = 0), so a bucket writes its n rows once for each block of those outside.
    """
    own = at.join(buckets, "key").where("doc_id <> hub")
    across, down = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("n") / BLOCK)
    each = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    hashed = lambda n: F.pmod(F.xxhash64("doc_id"), n)
    columns = ["key", "ask", "part", "n", "asks", "doc_id", "component"]
    member = own.withColumns({"part": hashed(down), "ask": F.explode(each(across)), "asks": F.lit(0)}).select(columns)
    asking = own.where("component <> most").withColumns({"ask": hashed(across), "part": F.explode(each(down)), "asks": F.lit(1)})
    return member.union(asking.select(columns))


def pairs_within(squares: DataFrame, bands: int, rows: int, least: int) -> DataFrame:
    """Pairs (a, b, n) of different components in one bucket of n whose signatures agree in `least` bytes or more.

    squares: the rows of residual() with their signatures, sig. A pair is let out in the first band that it shares alone; where
    both of a pair ask, it is let out twice.
    """

    def close(key: int, asks: np.ndarray, ids: np.ndarray, parts: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ask, member = np.flatnonzero(asks), np.flatnonzero(~asks)
        out_a, out_b = [], []
        step = max(1, (1 << 23) // max(1, len(member) * HASHES))
        for k in range(0, len(ask), step):
            own = ask[k : k + step]
            alike = (sigs[own, None, :] == sigs[None, member, :]).sum(2, dtype=np.int32) >= least
            alike &= parts[own, None] != parts[None, member]
            i, j = np.nonzero(alike)
            i, j = own[i], member[j]
            same = (sigs[i, : bands * rows] == sigs[j, : bands * rows]).reshape(-1, bands, rows).all(2)
            first = same.argmax(1) == key >> 56 if len(i) else np.zeros(0, bool)
            out_a.append(np.minimum(ids[i], ids[j])[first])
            out_b.append(np.maximum(ids[i], ids[j])[first])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, held = None, []

        def flush() -> pa.RecordBatch:
            asks, ids, parts, sigs = zip(*held, strict=True)
            matrix = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, HASHES)
            a, b = close(group[0], np.array(asks) == 1, np.array(ids), np.array(parts), matrix)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([group[3]] * len(a), pa.int64())], names=["a", "b", "n"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if row[:4] != group:
                    if held:
                        yield flush()
                    group, held = row[:4], []
                held.append(row[4:])
        if held:
            yield flush()

    dealt = squares.select("key", "ask", "part", "n", "asks", "doc_id", "component", "sig").repartition("key", "ask", "part")
    return dealt.sortWithinPartitions("key", "ask", "part", "doc_id").mapInArrow(run, "a long, b long, n long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    Documents are linked if 100 * intersection >= percent * union of their sets; component_id is the smallest doc_id
    that links reach.
    """
    spark = docs.sparkSession
    bands, rows = banding(percent)
    least = agreement(percent)
    path = new_path(spark, "signatures")
    signatures(docs, percent).write.option("compression", "zstd").parquet(path)
    signed = spark.read.parquet(path)
    linked = signed.where("doc_id is not null and n_shingles > 0")
    classes = stored(linked.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep")), "classes")
    own = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("fp1")).alias("fp1"), "fp2")
    members = stored(own.join(classes, ["fp1", "fp2"], "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "members")
    reps = stored(linked.join(classes.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi").join(classes.hint("merge"), ["fp1", "fp2"], "left_semi").select("doc_id", "sig", "bands"), "reps")
    dropped(spark, path)

    exploded = reps.select("doc_id", F.explode("bands").alias("key"))
    hubs = stored(exploded.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")
    grouped = stored(exploded.join(hubs, "key"), "buckets")
    asked = grouped.select("doc_id").distinct()
    texts = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").alias("payload")).join(asked.hint("merge"), "doc_id", "left_semi"), "texts")
    sigs = reps.select("doc_id", F.col("sig").alias("payload"))

    def signature_test(x: np.ndarray, y: np.ndarray) -> bool:
        return int((x == y).sum()) >= least

    def exact_test(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    star = grouped.where("doc_id <> hub").groupBy(F.col("hub").alias("a"), F.col("doc_id").alias("b")).agg(F.max("n").alias("n"))
    star = stored(star, "star")
    likely = compare(star, sigs, lambda v: np.frombuffer(v, np.uint8), signature_test)
    edge = stored(compare(likely, texts, shingle_set, exact_test), "star-links").select(F.col("a").alias("u"), F.col("b").alias("v"))

    first = components(edge)
    at = grouped.where("n > 2").join(first.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "hub", "doc_id", F.coalesce("component_id", "doc_id").alias("component"))
    at = stored(at, "residual")
    rest = residual(at, stored(open_buckets(at), "open")).join(reps.select("doc_id", "sig"), "doc_id")
    across = stored(pairs_within(rest, bands, rows, least), "across")
    more = compare(across, texts, shingle_set, exact_test).select(F.col("a").alias("u"), F.col("b").alias("v"))
    # rows that repeat a doc_id may be in several classes
    several = members.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v"), F.count("*").alias("n")).where("n > 1 and u <> v")
    several = members.join(several.select("doc_id", "u"), "doc_id").select("u", F.col("rep").alias("v"))
    final = components(edge.union(more).union(several))

    label = F.coalesce("component_id", "rep")
    out = members.join(final.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", "n_shingles", label.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)
), sym AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, x AS r FROM sym UNION SELECT sym.x, reach.r FROM sym JOIN reach ON sym.y = reach.doc_id WHERE reach.r < sym.x),
low AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.r, d.doc_id) AS component_id,
       d.doc_id = coalesce(low.r, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
