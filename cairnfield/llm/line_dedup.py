"""Line deduplication over levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line stripped of ASCII white space at both ends with A-Z lower-cased; keys are held as 128 bits
(two seeded 64-bit hashes). Batches of documents arrive newest first. Each batch is merge-anti-joined with the runs so
far: keys that no run holds enter the batch's own run with the largest doc_id, the others with their count alone. When
a level holds `fanout` runs they are compacted into one run of the next level. A key's total over all runs decides
whether its lines go, and the run that first saw it names the document that keeps them.

Defined cases: null or empty text is one empty line; a null doc_id takes no part in counting and keeps all lines;
repeated rows of one doc_id count as one document and are treated alike; other columns are passed through, but for
those that have the name of an output column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import ASCII_SPACE, ascii_lower, beside, dropped, new_path, stored, table

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 3
SECOND_SEED = "cairnfield line key"
#: Lines that are taken as frequent, at most.
FREQUENT = 10_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of a key; at 10^12 distinct lines a collision anywhere has a chance of about 10^-15."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(SECOND_SEED), key).alias("h2")


def long_keys(text: Column, min_chars: int) -> Column:
    """Structs (pos, h1, h2) of the lines, from 0, whose keys have min_chars code points or more."""
    at = F.transform(lines_of(text), lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key")))
    long = F.filter(at, lambda x: F.length(x["key"]) >= min_chars)
    return F.transform(long, lambda x: F.struct(x["pos"].alias("pos"), *key_hashes(x["key"])))


class LineRuns:
    """Levelled sorted runs (h1, h2, n_docs, keeper) in the shared folder; keeper is null in rows of counts alone."""

    SCHEMA = "h1 long, h2 long, n_docs long, keeper long"

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def rows(self) -> DataFrame:
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*paths)

    def _write(self, run: DataFrame, level: int) -> None:
        path = new_path(self.spark, f"line-run-{level}")
        run.sortWithinPartitions("h1", "h2").write.option("compression", "zstd").parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self.totals(self.spark.read.schema(self.SCHEMA).parquet(*old))
            self.levels[level] = []
            self._write(merged, level + 1)
            for p in old:
                dropped(self.spark, p)

    @staticmethod
    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def add(self, batch: DataFrame) -> None:
        """batch: (doc_id, h1, h2), each pair of document and key once; its documents are older than all before."""
        keys = batch.groupBy("h1", "h2").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        if self.levels:
            keys = stored(keys, "line-batch")
            seen = self.rows().select("h1", "h2")
            fresh = keys.hint("merge").join(seen, ["h1", "h2"], "left_anti")
            known = keys.hint("merge").join(seen, ["h1", "h2"], "left_semi")
            keys = fresh.unionByName(known.withColumn("keeper", F.lit(None).cast("long")))
        self._write(keys.select("h1", "h2", "n_docs", "keeper"), 0)


def repeats(keyed: DataFrame, hot: DataFrame) -> DataFrame:
    """keyed with the keeper of each line in hot (h1, h2, n_docs, keeper); other lines are left out.

    Keys that hold a FREQUENT-th of all occurrences in hot or more are FREQUENT at most, so they are broadcast, however large the table is;
    the lines of the others, none of which is more than that share, meet theirs by a join.
    """
    every = hot.agg(F.sum("n_docs").cast("decimal(38,0)").alias("n")).first()["n"] or 0
    often = F.col("n_docs").cast("decimal(38,0)") * FREQUENT >= F.lit(every)
    columns = ["h1", "h2", "keeper"]
    frequent = F.broadcast(hot.where(often).select(columns))
    common = keyed.join(frequent, ["h1", "h2"])
    others = keyed.join(frequent.drop("keeper"), ["h1", "h2"], "left_anti").join(hot.where(~often).select(columns).hint("merge"), ["h1", "h2"])
    return common.unionByName(others)


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(doc_id, text_hash, gone): for each text of a document, the sorted places of the lines that go from it."""
    spark = docs.sparkSession
    held = docs.where(F.col("doc_id").isNotNull())
    cuts = held.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("c")).first()
    cuts = sorted(set(cuts["c"] or []), reverse=True)
    batch = reduce(lambda n, c: n + (F.col("doc_id") <= F.lit(c)).cast("int"), cuts, F.lit(0))
    # texts are hashed before their lines are spread, or else they would be for every line
    keyed = held.select("doc_id", F.xxhash64("text").alias("text_hash"), batch.alias("batch"), long_keys(F.col("text"), min_chars).alias("keys"))
    keyed = stored(keyed.withColumn("k", F.explode("keys")).select("doc_id", "text_hash", "k.pos", "k.h1", "k.h2", "batch"), "line-keys", "batch")
    runs = LineRuns(spark)
    for i in range(len(cuts) + 1):
        # a document's repeated lines and rows must count once; its rows are all in one batch
        runs.add(keyed.where(F.col("batch") == i).select("doc_id", "h1", "h2").distinct())
    hot = stored(LineRuns.totals(runs.rows()).where(F.col("n_docs") >= min_docs), "line-hot")
    drops = repeats(keyed, hot).where(F.col("doc_id") < F.col("keeper"))
    # places are the same in rows that repeat a document and its text
    return drops.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def without(lines: Column, gone: Column) -> Column:
    """The lines but for those at the sorted places `gone`, by a mask that is made of the gaps between them."""
    ends = F.arrays_zip(F.concat(F.array(F.lit(-1)), F.slice(gone, 1, F.size(gone) - 1)).alias("a"), gone.alias("b"))
    mask = F.flatten(F.transform(ends, lambda e: F.concat(F.array_repeat(F.lit(False), e["b"] - e["a"] - 1), F.array(F.lit(True)))))
    # the array around them binds both to a name, so that they are made once
    bound = F.array(F.struct(lines.alias("lines"), mask.alias("mask")))
    return F.transform(bound, lambda s: F.filter(s["lines"], lambda _, i: ~F.coalesce(F.get(s["mask"], i), F.lit(False))))[0]


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """docs plus n_lines, kept_text and n_dropped.

    Keys of min_chars code points or more found in min_docs documents or more lose their lines except in the largest
    doc_id that holds them.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    gone = repeated_lines(docs.select("doc_id", "text"), min_chars, min_docs, batches).withColumnRenamed("doc_id", "id")
    own = beside(docs)
    both = own.join(gone, (F.col("doc_id") == F.col("id")) & (F.xxhash64("text") == F.col("text_hash")), "left")
    kept = F.array_join(without(lines_of(F.col("text")), F.col("gone")), "\n")
    text = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
    n_lines = F.size(lines_of(F.col("text"))).cast("long")
    out = both.select(*own.columns, n_lines.alias("n_lines"), text.alias("kept_text"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
    return out.toDF(*docs.columns, "n_lines", "kept_text", "n_dropped")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), hot AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE h.k IS NOT NULL AND l.doc_id <> h.keeper) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE h.k IS NULL OR l.doc_id = h.keeper), '')) AS kept_sha256
FROM lines l LEFT JOIN hot h ON l.k = h.k
GROUP BY l.doc_id
"""
