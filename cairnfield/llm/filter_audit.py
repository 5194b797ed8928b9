"""What filters of documents take out together: per part and order of the filters, what each step removes, and Shapley shares.

A document's failures are a mask of bits, one a filter. A part's counts of masks fix its removal polynomial, the multilinear
function of x_A .. x_E that says how many documents go when each filter is switched on by x: a mask m of failures is removed by
1 - prod(1 - x_i for i in m). Its corners (x of zeros and ones) say what any set of filters removes; the integral of its
derivative by x_i along the diagonal is filter i's Shapley share, the mean of what it removes over all orders. Coefficients are
whole numbers and the integral is taken with fractions, so shares times the number of orders are exact.

Masks are counted by Spark. Duplicates need no join of all texts: a document fails E unless no smaller doc_id has its text, so the
rows of the least doc_id of each digest, which an aggregation finds that is combined before it is shuffled, are counted apart
from all others. Polynomials are made in tasks, of 32 counts a part.

Defined cases: a null text is an empty one; a null source is the empty part; a null doc_id is not smaller than any and has no
smaller one, so it does not fail E, nor does a repeated row of the least doc_id; a doc_id with several label rows counts as good or
toxic if one of them says so, null labels say nothing; rows that repeat count one by one; an empty table has no parts; other
columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import UPPER, stored, table

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
MARKS = r"[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
#: Labels are copied so often, and a document looks for its own in one of the copies, so that a doc_id of many rows is spread.
SALTS = 8
COUNTS = "part string, mask int, n long, good long, toxic long"
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_failures(text: Column) -> Column:
    """The mask of the filters that look at a text alone, A to D."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))

    def mask(w: Column) -> Column:
        fails = [F.size(w) < MIN_WORDS, 100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * F.size(w), 100 * capitals.cast("long") > UPPER_PERCENT * F.length(text), F.rlike(text, F.lit(MARKS))]
        return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))

    return F.get(F.transform(F.array(words), mask), F.lit(0))  # the array binds the words to a name, so they are made once


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs plus good and toxic, 0 or 1; the join's keys are salted on both sides.

    The join is by merging, whatever the labels' size: a change to a broadcast while masks are made would make them twice.
    """
    said = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    own = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    own = own.where("good + toxic > 0").withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = docs.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    both = spread.join(own.hint("merge"), (F.col("doc_id") == F.col("id")) & (F.col("salt") == F.col("at")), "left")
    return both.select(*docs.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """COUNTS: for each part and mask that occurs, documents, and those of them that are labelled good or toxic."""
    text = F.coalesce("text", F.lit(""))
    each = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), own_failures(text).alias("mask"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("digest"))
    each = stored(labelled(each, labels), "failures")
    by = ["part", "mask", "good", "toxic"]
    everyone = each.groupBy(*by).agg(F.count("*").alias("n"))
    # rows of one doc_id and text are one row, so neither a frequent text nor a frequent doc_id is one task's
    rows = each.where("doc_id is not null").groupBy("digest", "doc_id", *by).agg(F.count("*").alias("n"))
    least = each.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = rows.join(least, ["digest", "doc_id"], "left_semi").select(*by, "n")
    without = each.where("doc_id is null").groupBy(*by).agg(F.count("*").alias("n"))
    unique = firsts.unionByName(without).groupBy(*by).agg(F.sum("n").alias("unique"))
    both = everyone.join(unique, by, "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
    split = F.array(*[F.struct((F.col("mask") + m).cast("int").alias("mask"), n.alias("n")) for m, n in ((0, F.col("unique")), (DUPLICATE, F.col("n") - F.col("unique")))])
    flat = both.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return flat.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def polynomial(counts: list[int]) -> list[int]:
    """Coefficients, by the set of variables as a mask, of the removal polynomial of counts by mask of failures.

    prod(1 - x_i for i in m) is the sum of (-1)^|T| x^T over the subsets T of m, so x^T gets -(-1)^|T| of every count above T.
    """
    above = list(counts)
    for bit in (1 << k for k in range(len(counts).bit_length() - 1)):
        above = [above[s] + above[s | bit] if not s & bit else above[s] for s in range(len(counts))]
    return [0, *(-((-1) ** s.bit_count()) * above[s] for s in range(1, len(counts)))]


def corners(coefficients: list[int]) -> list[int]:
    """The polynomial at every corner: what each set of filters removes."""
    at = list(coefficients)
    for bit in (1 << k for k in range(len(at).bit_length() - 1)):
        at = [at[s] + at[s ^ bit] if s & bit else at[s] for s in range(len(at))]
    return at


def shares(coefficients: list[int], filters: int) -> list[Fraction]:
    """The integral from 0 to 1 of the derivative by each variable where all equal t: x^T gives t^(|T| - 1), hence 1 / |T|."""
    return [sum((Fraction(c, s.bit_count()) for s, c in enumerate(coefficients) if s >> k & 1), Fraction(0)) for k in range(filters)]


def audit_rows(part: str, counts: dict[str, list[int]]) -> Iterator[tuple]:
    """RESULT's rows of one part; counts by mask of all documents (n), of good and of toxic ones."""
    total, every = sum(counts["n"]), factorial(len(FILTERS))
    formula = polynomial(counts["n"])
    gone, good, toxic = corners(formula), corners(polynomial(counts["good"])), corners(polynomial(counts["toxic"]))
    share = [s * every for s in shares(formula, len(FILTERS))]
    if any(s.denominator != 1 for s in share):
        raise ArithmeticError("a share times the number of orders is not whole")
    whole = len(gone) - 1
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            now = before | 1 << k
            removed = gone[now] - gone[before]
            yield (
                part, "".join(FILTERS[i] for i in order), step, total - gone[now], removed, gone[1 << k] - removed, gone[whole] - gone[whole ^ 1 << k],
                good[now] - good[before], toxic[now] - toxic[before], int(share[k]),
            )
            before = now


def audit(counts: DataFrame) -> DataFrame:
    """RESULT of COUNTS: a row for each part, order of the filters and step in it."""
    size = 1 << len(FILTERS)
    held = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts")  # 32 at most

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        for batch in batches:
            for part, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = {c: np.zeros(size, object) for c in ("n", "good", "toxic")}
                for r in rows:
                    for c, v in counts.items():
                        v[r["mask"]] += r[c]
                columns = zip(*audit_rows(part, {c: v.tolist() for c, v in counts.items()}), strict=True)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in RESULT.split(", ")])

    return counts.groupBy("part").agg(held).mapInArrow(run, RESULT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
WITH told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
texts AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS text, coalesce(t.good, 0) AS good, coalesce(t.toxic, 0) AS toxic,
         regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents d LEFT JOIN told t USING (doc_id)
), docs AS (
  SELECT part, good, toxic, [
      len(words) < 50,
      100 * len(list_distinct(words)) < 65 * len(words),
      100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM texts
), masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS letter, ascii(filter_order[step]) - 64 AS k,
         list_transform(range(1, step), lambda j: ascii(filter_order[j]) - 64) AS before
  FROM orders, range(1, 6) r(step)
), counted AS (
  SELECT part, filter_order, step, letter,
         sum(n) FILTER (WHERE NOT gone AND NOT fails[k]) AS kept,
         sum(n) FILTER (WHERE NOT gone AND fails[k]) AS removed,
         sum(n) FILTER (WHERE gone AND fails[k]) AS redundant,
         sum(n) FILTER (WHERE fails[k] AND len(list_filter(fails, lambda f: f)) = 1) AS unique_fails,
         sum(good) FILTER (WHERE NOT gone AND fails[k]) AS good_lost,
         sum(toxic) FILTER (WHERE NOT gone AND fails[k]) AS toxic_lost
  FROM (SELECT m.*, s.*, len(list_filter(before, lambda j: fails[j])) > 0 AS gone FROM masks m, steps s)
  GROUP BY ALL
)
SELECT part, filter_order, step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
