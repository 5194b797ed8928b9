import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.llm import toxicity as T

KIND = "doc_id long, text string, predicted string"
BAD = ["scoundrel", "nitwit", "blockhead"]


def disguised(rng, word):
    kind = rng.randrange(4)
    if kind == 0:
        return word.translate(str.maketrans("oiea", "01€4"))
    if kind == 1:
        return " ".join(word)
    if kind == 2:
        k = rng.randrange(1, len(word))
        return word[:k] + word[k] * 3 + word[k:] if k < len(word) else word
    return ".".join(word)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    syllables = "ban der fil gos mer nat pel rin sun tol wer".split()
    word = lambda: rng.choice(syllables) + rng.choice(syllables)
    out = []
    for i in range(300):
        text, bad = [word() for _ in range(40)], i % 5 == 0
        if bad:
            for at in (4, 18, 30):
                text[at] = rng.choice(BAD) if i % 10 else disguised(rng, rng.choice(BAD))
        out.append((i, " ".join(text), int(bad)))
    return out


@pytest.fixture(scope="module")
def frames(spark, rows):
    odd = [(900, None), (901, ""), (902, " \n\t"), (903, "!!! ... 12 $$$"), (904, "gosmer sunban " * 100_000), (None, "gosmer"), (905, "n1tw1t " * 3), (905, "n1tw1t " * 3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(i, t, None) for i, t in odd], KIND).repartition(3)
    labels = [(i, 1, y) for i, _, y in rows] + [(0, None, 0), (900, 1, 0), (901, 1, None), (None, 1, 1), (5000, 1, 1)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(frames):
    return T.learn_model(*frames, F.col("doc_id") % 3 != 0)


def test_decoding_restores_disguised_words(model):
    for seen in ("sc0undrel", "n1tw1t", "b|ockhead", "niiiitwit", "n.i.t.w.i.t", "scoun-drel"):
        restored = T.restore_text(f"gosmer {seen} pelrin", model.lm).replace(" ", "")
        assert any(w in restored for w in BAD), (seen, restored)
    assert T.restore_text("gosmer s c o u n d r e l pelrin", model.lm).split()[0] == "gosmer"
    assert "scoundrel" in T.restore_text("gosmer s c o u n d r e l pelrin", model.lm).replace(" ", "")
    assert T.restore_text("Gosmer, (pelrin) sunban!", model.lm) == "gosmer pelrin sunban"


def test_a_letter_written_twice_is_undone(frames, model):
    for word in BAD:
        for at in range(len(word)):
            seen = f"{word[:at]}{word[at]}{word[at:]}"
            assert word in T.restore_text(f"gosmer {seen}, pelrin", model.lm).split(), seen
    assert T.restore_text("gosmer pelrin sunban", model.lm) == "gosmer pelrin sunban"
    score = model.scorer()
    for word, seen in (("scoundrel", "scounndrel"), ("scoundrel", "sccoundrel"), ("nitwit", "nitwwit"), ("blockhead", "bloockhead")):
        assert score(f"gosmer {seen} pelrin") >= score(f"gosmer {word} pelrin") > score("gosmer pelrin")


def best_by_hand(observed, lm):
    """The likeliest decoding of a short string of letters and look-alikes without doublings, over all choices."""
    choices = [[(c, T.AS_IS)] if c.isalpha() else [(x, T.LOOKALIKE) for x in T.LOOKALIKES[c]] for c in observed]

    def walk(at, a, b):
        if at == len(choices):
            return lm(a, b, 0), ""
        found = []
        for x, cost in choices[at]:
            i = T.symbol(x)
            score, rest = walk(at + 1, b, i)
            found.append((score + cost + lm(a, b, i), x + rest))
        return max(found)

    return walk(0, 0, 0)


@pytest.mark.parametrize("seen", ["g0smer", "pe1rin", "6osmer", "5un8an"])
def test_viterbi_finds_the_best_of_all_paths(model, seen):
    got, (_, want) = T.decode(seen, model.lm), best_by_hand(seen, model.lm)
    assert got == want


def test_trigram_counts_equal_brute_force(spark):
    texts = ["Abc, abc", "é!é", None, "", "日本 a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    want = np.zeros(T.N**3)
    for t in texts:
        s = [T.symbol(c) for c in f"  {(t or '').lower()}  "] if t else []
        for a, b, c in zip(s, s[1:], s[2:]):
            if b or c:
                want[(a * T.N + b) * T.N + c] += 1
    got = T.trigram_counts(docs)
    # texts of one batch stand next to each other with one blank more or less between them, which breaks alone see
    same = np.array([b > 0 for _ in range(T.N) for b in range(T.N) for _ in range(T.N)])
    assert np.array_equal(got[same], want[same])


def test_held_out_rows_are_scored_well(frames, model, rows):
    got = {r.doc_id: r for r in T.score_toxicity(frames[0], model).collect()}
    held = [(i, y) for i, _, y in rows if i % 3 == 0]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_odd_texts(frames, model):
    out = T.score_toxicity(frames[0], model)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == frames[0].count()  # a clashing column is replaced
    got = {}
    for r in out.where("doc_id >= 900 or doc_id is null").collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert got[900] == got[901] == got[902] == got[None] and got[900][0] < 0.5
    assert got[904][0] < 0.5 and got[905][0] == got[905][1] > 0.5


def test_model_is_the_same_whatever_the_partitions(frames, model):
    again = T.learn_model(frames[0].repartition(7), frames[1], F.col("doc_id") % 3 != 0)
    assert again.weights == pytest.approx(model.weights)


def test_sample_holds_the_smallest_hashes_of_each_class(spark, monkeypatch):
    monkeypatch.setattr(T, "SAMPLE", {1: 20, 0: 45})
    rows = [(i, 1, int(i % 4 == 0)) for i in range(2000)] + [(3, 1, 1), (None, 1, 1), (5, 1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int").repartition(3)
    hashed = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().collect()}
    toxic = {i for i in range(2000) if i % 4 == 0} | {3}
    for learn in ("doc_id % 5 <> 0", "doc_id < 30"):
        held = [i for i in range(2000) if (i % 5 if "%" in learn else i < 30)]
        first = lambda ids, n: set(sorted(ids, key=hashed.get)[:n])
        want = {(i, 1) for i in first([i for i in held if i in toxic], 20)} | {(i, 0) for i in first([i for i in held if i not in toxic], 45)}
        assert {(r.doc_id, r.toxic) for r in T.labelled_sample(labels, F.expr(learn)).collect()} == want


def test_nothing_to_learn_from(spark, frames):
    docs, labels = frames
    for none in (labels.where("toxic = 0"), labels.limit(0)):
        got = T.score_toxicity(docs, T.learn_model(docs, none, F.lit(True))).select("score", "predicted").distinct().collect()
        assert [(r.score, r.predicted) for r in got] == [(0.0, 0)]
    assert T.score_toxicity(docs.limit(0), T.learn_model(docs.limit(0), labels, F.lit(True))).count() == 0


def test_query_on_held_out_rows(spark, sf):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = T.op7_toxicity(spark, sf).collect()
    held = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert len(held) > 15 and sum(p == y for p, y in held) >= 0.9 * len(held)


def test_rows_that_repeat_an_id_are_one_document(spark, rows, frames):
    words = "everywhere "  # a feature of all learned documents
    docs = [(i, words + t, None) for i, t, _ in rows]
    again = [(i, t, None) for i, t, _ in docs[:80]] + [(i, f"{words}pelrin nitwit {i}", None) for i in range(0, 60, 2)] * 3
    labels = frames[1]
    models = []
    for order in (docs + again, (docs + again)[::-1]):
        docs_of = spark.createDataFrame(order, KIND).repartition(3)
        models.append(T.learn_model(docs_of, labels, F.lit(True)))
    assert models[0].weights and models[0].weights == pytest.approx(models[1].weights)
    assert "everywhere" not in models[0].weights
    assert T.score_toxicity(spark.createDataFrame(docs + again, KIND), models[0]).count() == len(docs) + len(again)


def test_fit_reaches_the_least_loss():
    rng = np.random.default_rng(3)
    names = [f"f{k}" for k in range(12)]
    rows = [{f for f in names if rng.random() < 0.3} for _ in range(200)]
    labels = np.array([float(("f0" in r) + ("f1" in r) + rng.random() > 1.2) for r in rows])
    weight = np.where(labels == 1, 0.4, 1.7)
    found, intercept = T.fit(rows, labels, names, weight)
    w = np.array([found[f] for f in names] + [intercept])
    x = np.array([[f in r for f in names] + [True] for r in rows], float)
    ridge = np.array([T.RIDGE] * 12 + [1e-3])
    slope = x.T @ (weight * (labels - 1 / (1 + np.exp(-x @ w)))) - ridge * w
    assert np.abs(slope).max() < 1e-5


def test_weights_undo_the_classes_shares_in_the_sample():
    rng = np.random.default_rng(4)
    rows = [{"f0"} if rng.random() < 0.3 else set() for _ in range(6000)]
    labels = np.array([float(rng.random() < (0.6 if r else 0.05)) for r in rows])
    whole = T.fit(rows, labels, ["f0"], np.ones(len(rows)))
    held = [i for i in range(len(rows)) if labels[i] or i % 5 == 0]
    own = labels[held]
    share = {y: (labels == y).mean() * len(held) / (own == y).sum() for y in (0, 1)}
    part = T.fit([rows[i] for i in held], own, ["f0"], np.where(own == 1, share[1], share[0]))
    assert part[1] == pytest.approx(whole[1], abs=0.25) and part[0]["f0"] == pytest.approx(whole[0]["f0"], abs=0.25)


def test_columns_of_any_name_pass_through(spark, frames, model):
    docs = frames[0].withColumnsRenamed({"predicted": "toxic"}).withColumn("f", F.lit(1)).withColumn("n", F.lit(2))
    out = T.score_toxicity(docs, model)
    assert out.columns == ["doc_id", "text", "toxic", "f", "n", "score", "predicted"] and out.count() == docs.count()
