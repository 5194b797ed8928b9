"""Language identification with string kernels.

The kernel of two texts is the number of n-grams (n = 1..3 together, the blended spectrum) that both hold, over the root
of the product of their own numbers. Nyström landmarks stand for the kernel's space, and one-versus-rest ridge
regression over the landmarks gives a score for each language. Whole batches of texts are scored by two matrix
products: presence of the landmarks' n-grams times the landmarks' presence, then kernel values times weights.

Texts are lower-cased and every non-letter becomes one gap symbol. A letter is its code point, so an n-gram's code holds
up to three of them in 63 bits and any number of scripts keeps its n-grams apart.

A score tells languages apart, not whether a text is of any: a text unlike every landmark scores near 0.5. So the share
of a text's n-grams that some landmark holds is measured too. Its bound is learned from the landmarks, each held against
the others: KNOWN_SHARE of the share that nine of ten landmarks reach, in the language where that is least. Short texts
have chance on their side: the bound is less by the one-sided 95 % error of a share of as many letters.

Defined cases: null text, and text without a letter, is `und` with score 0; so is every text if there is no labelled
row to learn from; rows with null lang, text or doc_id are not learned from; repeated rows are answered one by one; of
rows that repeat a doc_id and lang, one is learned from, that with the least hash of its text; other columns are passed
through, but for those that have the name of an output column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnfield.llm._shared import parts_of, stored, table

UND = "und"
#: Bounds of the labelled sample: rows and landmarks for each language, those with the smallest hash of doc_id.
ROWS_PER_LANG = 300
LANDMARKS_PER_LANG = 32
RIDGE = 1e-3
#: Bits of a symbol: the gap, or a letter's code point plus one.
BITS = 21
GAP = 1
GAPS = np.array([GAP, GAP << BITS | GAP, GAP << 2 * BITS | GAP << BITS | GAP])
#: Texts that are scored together, and codes of the vocabulary in one matrix product.
BATCH = 256
BLOCK = 16_384
#: Part of the landmarks' own share of known n-grams that a text must reach, and the normal quantile of its error.
KNOWN_SHARE = 0.85
ERROR = 1.645


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@lru_cache(1)
def letter_points() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def all_grams(text: str) -> np.ndarray:
    """Codes of the text's n-grams of one to three symbols, repeated ones too."""
    point = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    one = np.where(letter_points()[point], point + GAP, GAP).astype(np.int64)
    two = one[:-1] << BITS | one[1:]
    return np.concatenate([one, two, two[:-1] << BITS | one[2:]])


@dataclass
class Grams:
    """Distinct n-grams of a number of texts, text after text: how many each has, and for each its text, code, count and
    place in a kernel's vocabulary, -1 for none."""

    texts: int
    own: np.ndarray
    row: np.ndarray
    codes: np.ndarray
    counts: np.ndarray
    at: np.ndarray


@dataclass
class Kernel:
    """Landmarks as presence of n-grams: the sorted codes of all, and presence (codes x landmarks)."""

    codes: np.ndarray
    presence: np.ndarray

    @cached_property
    def holders(self) -> np.ndarray:
        """How many landmarks hold each code."""
        return self.presence.sum(1, dtype=np.int64)

    @property
    def letters(self) -> str:
        """The letters of the landmarks."""
        return "".join(chr(c - GAP) for c in self.codes[(self.codes > GAP) & (self.codes < 1 << BITS)])

    def look_up(self, texts: list[str]) -> Grams:
        found = [np.unique(all_grams(t), return_counts=True) for t in texts]
        own = np.array([len(g) for g, _ in found])
        codes, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        return Grams(len(texts), own, np.repeat(np.arange(len(texts)), own), codes, counts, places(self.codes, codes))

    def known(self, grams: Grams, by: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the share of its n-grams with a letter that at least `by` landmarks hold, and its letters."""
        n = np.where(np.isin(grams.codes, GAPS), 0, grams.counts)
        total = lambda which: np.bincount(grams.row, np.where(which, n, 0), grams.texts)
        hit = (grams.at >= 0) & (self.holders[np.maximum(grams.at, 0)] >= by)
        return total(hit) / np.maximum(1, total(True)), total(grams.codes < 1 << BITS)

    def products(self, grams: Grams) -> np.ndarray:
        """Kernel values, texts x landmarks: a product of presence matrices, over a block of codes at a time."""
        row, at = grams.row[grams.at >= 0], grams.at[grams.at >= 0]
        shared = np.zeros((grams.texts, self.presence.shape[1]), np.float32)
        for low in range(0, len(self.codes), BLOCK):
            part = self.presence[low : low + BLOCK].astype(np.float32)
            now = (at >= low) & (at < low + BLOCK)
            held = np.zeros((grams.texts, len(part)), np.float32)
            held[row[now], at[now] - low] = 1
            shared += held @ part
        return shared / np.sqrt(grams.own[:, None] * np.maximum(self.presence.sum(0, dtype=np.float32), 1))

    def values(self, texts: list[str]) -> np.ndarray:
        return self.products(self.look_up(texts))


def places(codes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where each n-gram is among the sorted codes, or -1."""
    if not len(codes):
        return np.full(len(grams), -1)
    at = np.minimum(np.searchsorted(codes, grams), len(codes) - 1)
    return np.where(codes[at] == grams, at, -1)


def kernel_of(landmarks: list[str]) -> Kernel:
    grams = [np.unique(all_grams(t)) for t in landmarks]
    codes = np.unique(np.concatenate(grams))
    presence = np.zeros((len(codes), len(landmarks)), np.uint8)
    for i, g in enumerate(grams):
        presence[np.searchsorted(codes, g), i] = 1
    return Kernel(codes, presence)


@dataclass
class Model:
    languages: list[str]
    kernel: Kernel | None = None
    weights: np.ndarray | None = None
    known_share: float = 0.0

    def resembles(self, grams: Grams) -> np.ndarray:
        """Whether the landmarks hold enough of each text's n-grams."""
        share, letters = self.kernel.known(grams)
        b = self.known_share
        return share >= b - ERROR * np.sqrt(b * (1 - b) / np.maximum(letters, 1))

    def predict(self, texts: list[str | None], strict: bool = False) -> tuple[list[str], list[float]]:
        """Languages and scores; if strict, a text that resembles no language is `und` too."""
        out = [(UND, 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for k in range(0, len(at), BATCH):
            part = at[k : k + BATCH]
            grams = self.kernel.look_up([texts[i] for i in part])
            scores = self.kernel.products(grams) @ self.weights
            good = self.resembles(grams) if strict else np.ones(len(part), bool)
            for i, b, s, g in zip(part, scores.argmax(1), scores.max(1), good, strict=True):
                if g:
                    out[i] = (self.languages[b], float(min(1.0, max(0.0, (s + 1) / 2))))
        return [x for x, _ in out], [x for _, x in out]


def training_sample(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, lang, text, mark): a bounded sample, the same whatever the order of rows is; mark: whether a landmark."""
    may = docs.where(learn & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    may = may.select(F.col("doc_id").cast("long"), "lang", "text").withColumn("h", F.xxhash64("doc_id"))
    # ranks are given below a hash under which twice the sample is expected, so that no task sorts a whole language
    sizes = may.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()
    cuts = [x for r in sizes for x in (F.lit(r.lang), F.lit(min((2 * ROWS_PER_LANG << 64) // max(1, r.n), (1 << 64) - 1) - (1 << 63)))]
    few = may.where(F.col("h") <= F.element_at(F.create_map(*cuts), F.col("lang"))) if cuts else may.limit(0)
    one = few.groupBy("lang", "doc_id", "h").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
    ranked = one.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("n") <= ROWS_PER_LANG)
    return ranked.select("doc_id", "lang", F.col("t.text").alias("text"), (F.col("n") <= LANDMARKS_PER_LANG).alias("mark"))


def learn_model(docs: DataFrame, learn: Column) -> Model:
    """Learns from rows of docs (doc_id, text, lang) for which learn holds. Only landmark texts reach the driver."""
    sample = stored(training_sample(docs, learn), "language-sample")
    landmarks = sorted((r.doc_id, r.lang, r.text) for r in sample.where("mark").collect())
    if not landmarks:
        return Model([])
    kernel = kernel_of([t for *_, t in landmarks])

    def values(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "k": list(kernel.values(list(batch["text"])).astype(float))})

    rows = sample.select("doc_id", "lang", "text").mapInPandas(values, "doc_id long, lang string, k array<double>").collect()
    rows = sorted((r.doc_id, r.lang, r.k) for r in rows)
    languages = sorted({lang for _, lang, _ in rows})
    k_nm = np.array([k for *_, k in rows])
    target = np.array([[1.0 if own == lang else -1.0 for lang in languages] for _, own, _ in rows])
    own = kernel.presence.astype(float)
    k_mm = own.T @ own / np.sqrt(np.outer(own.sum(0), own.sum(0)))
    weights = np.linalg.lstsq(k_nm.T @ k_nm + RIDGE * len(rows) * k_mm, k_nm.T @ target, rcond=None)[0]
    own_share, mark_lang = kernel.known(kernel.look_up([t for *_, t in landmarks]), 2)[0], np.array([lang for _, lang, _ in landmarks])
    known_share = KNOWN_SHARE * min(float(np.quantile(own_share[mark_lang == lang], 0.1)) for lang in languages)
    return Model(languages, kernel, weights.astype(np.float32), known_share)


def identify(docs: DataFrame, model: Model, strict: bool = False) -> DataFrame:
    """docs (.., text, ..) plus lang_pred and score, which replace columns of these names; strict as Model.predict has it."""
    from pyspark.sql import types as T

    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in parts_of(batch, at, BATCH):
                langs, scores = model.predict(part.column(at).to_pylist(), strict)
                yield pa.record_batch([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_model(docs, ~held_out())
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
