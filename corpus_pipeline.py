"""The corpus pipeline: language ID, toxicity, line dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined cases: rows that repeat a doc_id go through every stage one by one, but for near-duplicates, where they are one
document and stay or go together; other columns pass through unread, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm import language_id, line_dedup, minhash_dedup, packing, toxicity
from cairnfield.llm._shared import beside, named_as, stored, table

#: The least score of the best language; a text that every one-versus-rest classifier turns down firmly scores less.
MIN_LANGUAGE_SCORE = 0.25
#: Near-duplicates share at least so many hundredths of their shingles.
SIMILARITY_PERCENT = 80

#: SQL cannot express trained classifiers; tests hold the stages against plain Python.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that resemble no learned language (language_id says by which bound).

    Null and empty texts have no letter and go. Where no document is labelled, no language is known to resemble, and all
    documents with a letter stay. A null doc_id is judged as any other.
    """
    model = language_id.learn_model(docs, ~language_id.held_out())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    good = (F.col("lang_pred") != language_id.UND) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return named_as(language_id.identify(beside(docs), model, strict=True).where(good), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are scored toxic. Null and empty texts score what the intercept says; without labels of both
    classes nothing goes."""
    model = toxicity.learn_model(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return named_as(toxicity.score_toxicity(beside(docs), model).where("predicted = 0"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of texts; every document stays. A null text stays null, a null doc_id keeps all lines."""
    out = line_dedup.dedup_lines(beside(docs))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    out = named_as(out.withColumn("text", text), docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the smallest doc_id. Rows that repeat it stay together; a null doc_id stays, and so
    do null and empty texts, which are like no other."""
    found = minhash_dedup.near_duplicates(docs.select("doc_id", "text"), SIMILARITY_PERCENT)
    gone = stored(found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "duplicates")
    return named_as(beside(docs).join(gone.hint("merge"), "doc_id", "left_anti"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences. A null text is an end id alone."""
    out = packing.pack(docs)
    crc = F.crc32("ids").alias("ids_crc32")
    return out.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "tier", "step_group")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stored(stage(spark, out, sf_dir), f"stage-{name}")
    return out
