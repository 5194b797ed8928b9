"""Toxicity scores of text that may be disguised.

A noisy channel is assumed to have written letters as look-alikes, repeated them, or spread a word over blanks and
marks. For every suspicious token a lattice of the letters that each character may stand for is decoded by Viterbi
under a character trigram model, which is counted over all documents. The restored words, and their beginnings, are
then scored by logistic regression.

A token whose characters are all letters, with no letter twice running, has one path through its lattice and is its own
restoration, so only the others are decoded; each distinct token is restored once per task as long as a bounded cache
holds it. A letter written twice may be meant, so a token of letters alone with none three times running stays beside
what it is decoded to, and writing twice costs it no more than writing thrice.

The sample's classes are weighted to the shares that they have among all labels, so a score means the same however large
the input is.

Defined cases: null and empty texts have no words and get the score of the intercept; without labelled rows of both
classes every score is 0; a document with several label rows counts as toxic if one of them is 1; null labels are not
learned from; repeated rows are scored one by one, and one row of a doc_id is learned from, that with the least hash of
its text; other columns are passed through, but for those that have the name of an output column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnfield.llm._shared import parts_of, stored, table

#: Bounds of the labelled sample: rows of each class, those with the smallest hash of doc_id.
SAMPLE = {1: 2000, 0: 4000}
#: Beginnings of words that are features besides the words; the least chi-square (p = 0.0001) and number of documents
#: of a feature. All that reach them are taken.
BEGINNINGS = (4, 5, 6)
CHI_SQUARE = 15.1
MIN_DOCS = 4
RIDGE = 0.1
CACHE_TOKENS = 200_000

#: What a character may stand for (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "¢": "c",
}
#: Log probabilities of the channel.
AS_IS, LOOKALIKE, REPEATED, DOUBLED, DELETED, BREAK, BROKEN = -0.05, -1.0, -0.3, -4.0, -5.5, -7.0, -0.5

ALPHABET = "".join(chr(c) for c in [*range(0x61, 0x7B), *range(0xDF, 0x100)] if chr(c).isalpha())
N = len(ALPHABET) + 2  # 0 break, N - 1 any other letter
_INDEX = {c: i + 1 for i, c in enumerate(ALPHABET)}
_SPREAD = re.compile(r"(?<!\S)\S(?:[ ._*\-]\S){2,}(?!\S)")
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")
_WORD = re.compile(r"[^\W\d_]+")
_EDGES = ".,;:!?\"'()[]{}<>*_-|"


def symbol(c: str) -> int:
    return _INDEX.get(c) or (N - 1 if c.isalpha() else 0)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all texts; a run of non-letters is one break."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = np.zeros(1 << 16, np.int32)
        table[[c for c in range(1 << 16) if chr(c).isalpha() or 0xD800 <= c < 0xE000]] = N - 1
        for c, i in _INDEX.items():
            table[ord(c)] = i
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            for part in parts_of(batch, 0, 500):
                text = " ".join(x for x in part.column(0).to_pylist() if x).lower()
                s = table[np.frombuffer(f"  {text}  ".encode("utf-16-le", "surrogatepass"), np.uint16)]
                codes = (s[:-2] * N + s[1:-1]) * N + s[2:]
                total += np.bincount(codes[(s[1:-1] > 0) | (s[2:] > 0)], minlength=N**3)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["code", "n"])

    parts = docs.select("text").mapInArrow(run, "code int, n long")
    out = np.zeros(N**3)
    for r in parts.groupBy("code").agg(F.sum("n").alias("n")).collect():  # N^3 rows at most
        out[r.code] = r.n
    return out


class CharModel:
    """Trigram log probabilities, interpolated with bigrams and unigrams."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(N, N, N) + 0.0
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + N)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)

    def __call__(self, a: int, b: int, c: int) -> float:
        return self.flat[(a * N + b) * N + c]

    @cached_property
    def flat(self) -> list[float]:
        """The table as one list, which single look-ups read faster than an array."""
        return self.log.reshape(-1).tolist()

    def __getstate__(self) -> dict:
        return {"log": self.log}


def decode(observed: str, lm: CharModel, doubled: float = DOUBLED) -> str:
    """The likeliest letters behind a string of characters, words apart by blanks; doubled: a letter written twice."""
    # state: the last two symbols and the letter last written or '' -> (score, text so far)
    flat = lm.flat
    best: dict[tuple[int, int, str], tuple[float, tuple]] = {(0, 0, ""): (0.0, ())}
    for at, c in enumerate(observed):
        plain = c.isalpha()
        again = at > 0 and observed[at - 1] == c
        if plain and not again and len(best) == 1:  # one way on
            (((a, b, _), (score, path)),) = best.items()
            i = symbol(c)
            best = {(b, i, c): (score + AS_IS + flat[(a * N + b) * N + i], (path, c))}
            continue
        again_cost = REPEATED if again and 3 * c in observed[max(0, at - 2) : at + 2] else doubled
        letters = [(c, symbol(c), AS_IS)] if plain else [(x, symbol(x), LOOKALIKE) for x in LOOKALIKES.get(c, "")]
        after: dict[tuple[int, int, str], tuple[float, tuple]] = {}
        for state, (score, path) in best.items():
            a, b, last = state
            row = (a * N + b) * N
            reached = []
            for x, i, cost in letters:
                reached.append(((b, i, x), score + cost + flat[row + i], (path, x)))
                if again and last == x:
                    reached.append((state, score + again_cost, path))
            if not plain:
                reached.append((state, score + DELETED, path))
                if b:
                    reached.append(((b, 0, ""), score + BREAK + flat[row], (path, " ")))
                else:
                    reached.append(((a, b, ""), score + (BROKEN if path else DELETED), path))
            for to, total, way in reached:
                old = after.get(to)
                if old is None or total > old[0]:
                    after[to] = (total, way)
        best = after
    _, path = max((score + (lm(a, b, 0) if b else 0.0), path) for (a, b, _), (score, path) in best.items())
    out = []
    while path:
        path, x = path
        out.append(x)
    return "".join(reversed(out)).strip()


def suspicious(core: str) -> bool:
    return any(map(str.isalpha, core)) and (not core.isalpha() or bool(_TRIPLE.search(core)))


def restore_token(token: str, lm: CharModel) -> str:
    """A lower-case token as the words it stands for; a token without any letter stays."""
    core = token.strip(_EDGES)
    if suspicious(core):
        whole = token.lstrip(".,;:?\"')]}>*_-").rstrip(".,;:?\"'([{*_-")
        tries = [decode(core, lm)] + ([decode(whole, lm)] if whole != core else [])
        return " ".join(dict.fromkeys(w for t in tries for w in t.split()))
    words = [core]
    if core.isalpha() and _DOUBLE.search(core):
        words += decode(core, lm, REPEATED).split()
    if suspicious(token) and core.isalpha() and token[0] in LOOKALIKES:  # marks at an edge may be letters
        words += decode(token, lm).split()
    return " ".join(dict.fromkeys(words))


def restore_text(text: str | None, lm: CharModel) -> str:
    """The text's restored words in order, blanks between them."""
    low = (text or "").lower()
    low = _SPREAD.sub(lambda m: " " + decode(m[0], lm) + " ", low)
    return " ".join(w for w in (restore_token(t, lm) for t in low.split()) if w)


def features_of(words: str) -> set[str]:
    out = set()
    for w in _WORD.findall(words):
        out.add(w)
        out.update(f"{w[:k]}*" for k in BEGINNINGS if len(w) >= k)
    return out


@dataclass
class Model:
    """Weights of features, and the intercept; without it every score is 0."""

    lm: CharModel | None = None
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float | None = None

    def scorer(self):  # noqa: ANN201
        """A function from text to (score); holds a bounded cache of tokens."""
        cache: dict[str, tuple[str, ...]] = {}
        weights, lm, none = self.weights, self.lm, ()

        def known(words: str) -> tuple[str, ...]:
            return tuple(f for f in features_of(words) if f in weights) or none

        def score(text: str | None) -> float:
            if self.intercept is None:
                return 0.0
            low = (text or "").lower()
            found: set[str] = set()
            for m in _SPREAD.finditer(low):
                found.update(known(decode(m[0], lm)))
            tokens = set(low.split())
            if len(cache) > CACHE_TOKENS:
                cache.clear()
            for t in tokens:
                hit = cache.get(t)
                if hit is None:
                    hit = cache[t] = known(restore_token(t, lm))
                if hit:
                    found.update(hit)
            z = self.intercept + sum(weights[f] for f in sorted(found))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def fit(rows: list[set[str]], labels: np.ndarray, names: list[str], importance: np.ndarray) -> tuple[dict[str, float], float]:
    """Ridge logistic regression on presence of the named features, each row counting by its importance.

    Newton steps, each solved by conjugate gradients over the rows' lists of features, so any number of features fits.
    """
    at, n = {f: i for i, f in enumerate(names)}, len(names)
    # a row's features and, as the last one, the intercept
    lists = [sorted(at[f] for f in r if f in at) + [n] for r in rows]
    row, col = np.repeat(np.arange(len(rows)), [len(x) for x in lists]), np.array([c for x in lists for c in x])
    ridge = np.full(n + 1, RIDGE)
    ridge[-1] = 1e-3
    by_row = lambda v: np.bincount(row, v[col], len(rows))
    by_col = lambda v: np.bincount(col, v[row], n + 1)
    w = np.zeros(n + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(by_row(w), -30, 30)))
        curve = importance * p * (1 - p)
        scale = by_col(curve) + ridge  # the diagonal preconditions
        step, rest = np.zeros(n + 1), by_col(importance * (labels - p)) - ridge * w
        z = rest / scale
        way, size = z.copy(), float(rest @ z)
        for _ in range(500):
            if size < 1e-18:
                break
            bent = by_col(curve * by_row(way)) + ridge * way
            far = size / float(way @ bent)
            step += far * way
            rest -= far * bent
            z = rest / scale
            before, size = size, float(rest @ z)
            way = z + size / before * way
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return {f: float(v) for f, v in zip(names, w[:-1], strict=True)}, float(w[-1])


def known_labels(labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, toxic, h): one row for each document to learn from, with the hash of its id."""
    known = labels.where(F.col("toxic").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))


def class_sizes(known: DataFrame) -> dict[int, int]:
    return {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}


def labelled_sample(labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, toxic): the documents of each class with the smallest hashes of doc_id, as many as SAMPLE says."""
    known = known_labels(labels, learn)
    order = Window.partitionBy("toxic").orderBy("h", "doc_id")
    # ranks are given below a hash under which twice the sample is expected, so that no task sorts a whole class
    cut = {t: min((2 * SAMPLE[t] << 64) // n, (1 << 64) - 1) - (1 << 63) for t, n in class_sizes(known).items()}
    of = lambda bounds: F.when(F.col("toxic") == 1, F.lit(bounds.get(1, 0))).otherwise(F.lit(bounds.get(0, 0)))
    ranked = known.where(F.col("h") <= of(cut)).withColumn("n", F.row_number().over(order))
    return ranked.where(F.col("n") <= of(SAMPLE)).select("doc_id", "toxic")


def learn_model(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learns from a bounded sample of the rows of docs (doc_id, text) with a label, where learn holds of doc_id."""
    spark = docs.sparkSession
    chosen = stored(labelled_sample(labels, learn), "toxicity-sample")  # SAMPLE bounds its rows
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of rows that repeat a doc_id, one is learned from, the same whatever their order is
    one = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t"))
    texts = stored(one.select("doc_id", F.col("t.text").alias("text"), "toxic"), "toxicity-texts")
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model()
    lm = CharModel(trigram_counts(docs))

    def featured(keep: set[str] | None):  # noqa: ANN202
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for part in parts_of(batch, 1, 100):
                    found = [features_of(restore_text(t, lm)) for t in part.column(1).to_pylist()]
                    found = [sorted(f if keep is None else f & keep) for f in found]
                    yield pa.record_batch([part.column(0), part.column(2), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "toxic", "f"])

        return texts.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id long, toxic int, f array<string>")

    spread = featured(None).select("toxic", F.explode("f").alias("f"))
    counts = spread.groupBy("f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n1, n0 = F.lit(float(sizes[1])), F.lit(float(sizes[0]))
    # a feature of all documents tells nothing, and the statistic is null
    chi = F.try_divide((n1 + n0) * F.pow(a * (n0 - b) - b * (n1 - a), 2), n1 * n0 * (a + b) * (n1 + n0 - a - b))
    telling = counts.where((F.col("a") + F.col("b") >= MIN_DOCS) & (a * n0 > b * n1) & (chi >= CHI_SQUARE))
    names = sorted(r.f for r in telling.select("f").collect())  # SAMPLE bounds these, as it bounds the texts
    data = sorted({(r.doc_id, r.toxic): set(r.f) for r in featured(set(names)).collect()}.items())
    toxic, known = np.array([t for (_, t), _ in data], float), class_sizes(known_labels(labels, learn))
    share = {t: known[t] / sum(known.values()) * len(data) / n for t, n in sizes.items()}
    weights, intercept = fit([f for _, f in data], toxic, names, np.where(toxic == 1, share[1], share[0]))
    return Model(lm, {f: w for f, w in weights.items() if abs(w) > 1e-3}, intercept)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """docs (.., text, ..) plus score and predicted (1 if score >= 0.5, else 0), which replace columns of these names."""
    from pyspark.sql import types as T

    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = model.scorer()
        for batch in batches:
            for part in parts_of(batch, at, 500):
                scores = [score(t) for t in part.column(at).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_model(docs, table(spark, sf_dir, "labels"), ~held_out())
    out = score_toxicity(docs, model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
