"""License scan by canonical digest. DataFrame functions only.

A text's canonical form drops copyright lines, lower-cases A-Z, maps equivalent spellings to one, and keeps letters
and digits alone, so that case, punctuation, hyphens, white space and line breaks do not matter. The SHA-256 of the
whole canonical text is hash-joined to the digests of known licences. So is that of every single line, as a text of its
own, which finds one-line notices inside longer documents. Canonical forms are made in one pass; its digests are written
to the shared folder with a number for each row, by which notices come back to their row.

Defined cases: null text is an empty text; a text with an empty canonical form matches nothing; a null doc_id is answered
as any other, and so are repeated rows, one by one; a known table may name several licences for one text, of which the
smallest id is reported; other columns take no part, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._licenses import KNOWN, SPELLINGS
from cairnfield.llm._shared import ascii_lower, stored, table

COPYRIGHT_LINE = r"\n[^\p{L}\p{N}\n]*(?:copyright *(?:\(c\)|[©:<\[0-9])|\(c\) *[0-9]|©|all rights reserved)[^\n]*"
NOT_A_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks; words stand two blanks apart until spellings are mapped."""
    bare = F.regexp_replace(ascii_lower(F.concat(F.lit("\n"), F.coalesce(text, F.lit("")))), COPYRIGHT_LINE, "\n")
    spaced = F.replace(F.concat(F.lit("  "), F.regexp_replace(bare, NOT_A_WORD, "  "), F.lit("  ")), F.lit("\n"), F.lit("  \n  "))
    same = reduce(lambda c, s: F.replace(c, F.lit(f" {s[0]} "), F.lit(f" {s[1]} ")), SPELLINGS.items(), spaced)
    return F.replace(same, F.lit(" "), F.lit(""))


def whole(lines: Column) -> Column:
    return F.replace(lines, F.lit("\n"), F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license_id) of known (license_id, text)."""
    canon = known.select("license_id", whole(canonical_lines(F.col("text"))).alias("c")).where("c <> ''")
    return canon.groupBy(digest(F.col("c")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def known_licenses(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(t).alias("text")) for k, t in KNOWN.items()])
    return spark.range(1).select(F.inline(rows))


def licenses_in(spark: SparkSession, folder: str) -> DataFrame:
    """(license_id, text): a known table of the files of a folder, each a licence named after its file without .txt."""
    name = F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.txt$", "")
    return spark.read.text(folder, wholetext=True).select(name.alias("license_id"), F.col("value").alias("text"))


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, canonical_sha256, license_id, notices) for each row of docs.

    license_id: the licence that the whole text is, or null. notices: the sorted ids, joined by commas, of licences
    that single lines of the text are; '' where there are none.
    """
    found = known_digests(known)
    canon = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    own = F.filter(F.split("lines", "\n"), lambda x: x != "")
    made = canon.select("doc_id", digest(whole(F.col("lines"))).alias("digest"), F.array_distinct(F.transform(own, digest)).alias("lines"))
    made = stored(made.withColumn("row", F.monotonically_increasing_id()), "license-digests")
    line = made.select("row", F.explode("lines").alias("digest")).join(found, "digest")
    notices = line.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    out = made.drop("lines").join(found, "digest", "left").join(notices, "row", "left")
    return out.select("doc_id", F.lower(F.hex("digest")).alias("canonical_sha256"), "license_id", F.coalesce("notices", F.lit("")).alias("notices"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def oracle_sql() -> str:
    def canon(text: str) -> str:
        low = f"translate(chr(10) || coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        bare = f"regexp_replace({low}, '{COPYRIGHT_LINE}', chr(10), 'g')"
        out = f"replace('  ' || regexp_replace({bare}, '{NOT_A_WORD}', '  ', 'g') || '  ', chr(10), '  ' || chr(10) || '  ')"
        for a, b in SPELLINGS.items():
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"replace({out}, ' ', '')"

    values = ", ".join(f"('{k}', {_sql_text(t)})" for k, t in KNOWN.items())
    return f"""
WITH known AS (
  SELECT sha256(c) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, replace({canon("text")}, chr(10), '') AS c FROM (VALUES {values}) v(license_id, text))
  WHERE c <> '' GROUP BY 1
), canon AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, {canon("text")} AS lines FROM documents),
notices AS (
  SELECT n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT n, unnest(string_split(lines, chr(10))) AS line FROM canon) JOIN known ON sha256(line) = digest
  WHERE line <> '' GROUP BY 1
)
SELECT c.doc_id, sha256(replace(lines, chr(10), '')) AS canonical_sha256, k.license_id, coalesce(n.notices, '') AS notices
FROM canon c LEFT JOIN known k ON k.digest = sha256(replace(lines, chr(10), '')) LEFT JOIN notices n ON n.n = c.n
"""
