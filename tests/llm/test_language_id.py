import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.llm import language_id as L

KIND = "doc_id long, text string, lang string, score string"
SYLLABLES = {"aa": "ba be bi bo bu da de di do du".split(), "zz": "xyl xen zor zik vex wug qua kwo pry fyz".split(), "éé": "éa çu éo ça ùi êt àr".split()}


def text_of(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    return [(i, text_of(rng, lang), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 20)]


def grams_by_hand(text):
    s = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}


def test_kernel_values_equal_brute_force(labelled):
    landmarks = [t for _, t, _, _ in labelled[:9]]
    texts = [t for _, t, _, _ in labelled[9:20]] + ["a", "Ba-be!", "日本"]
    got = L.kernel_of(landmarks).values(texts)
    for i, t in enumerate(texts):
        own = grams_by_hand(t)
        for k, m in enumerate(landmarks):
            theirs = grams_by_hand(m)
            # letters that no landmark holds share one symbol, so only texts within the landmarks' letters count alike
            if set("".join(own)) <= set(" " + "".join(landmarks).lower()):
                assert got[i, k] == pytest.approx(len(own & theirs) / np.sqrt(len(own) * len(theirs)), rel=1e-5)


def test_held_out_languages_are_found(spark, labelled):
    docs = frame(spark, labelled)
    learn = F.col("doc_id") % 4 != 2
    got = L.identify(docs, L.learn_model(docs, learn)).collect()
    lang = {i: x for i, _, x, _ in labelled}
    assert all(r.lang_pred == lang[r.doc_id] and 0.5 < r.score <= 1 for r in got if r.doc_id % 4 == 2)


def test_model_is_the_same_whatever_the_partitions(spark, labelled):
    docs = spark.createDataFrame(labelled, KIND)
    one, many = (L.learn_model(docs.repartition(n), F.lit(True)) for n in (1, 7))
    assert one.kernel.letters == many.kernel.letters and np.allclose(one.weights, many.weights)


def test_odd_texts(spark, labelled):
    odd = [(900, None, "aa", "x"), (901, "", "aa", "x"), (902, "12 !?\n", "zz", "x"), (903, text_of(random.Random(2), "zz", 200_000), None, "x"), (None, "babebi dodedo", "aa", None), (904, "babebi dodedo", None, None)]
    docs = frame(spark, [*labelled, *odd, odd[-1]])
    got = L.identify(docs, L.learn_model(docs, F.lit(True)))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]  # a clashing column is replaced
    rows = got.where("doc_id >= 900 or doc_id is null").collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == 7 and by[900] == by[901] == by[902] == (L.UND, 0.0)
    assert by[903][0] == "zz" and by[904] == by[None] and by[904][0] == "aa"


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "babebi", None, "x"), (2, None, "aa", "x")])
    got = L.identify(docs, L.learn_model(docs, F.lit(True))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {(L.UND, 0.0)}
    empty = frame(spark, [])
    assert L.identify(empty, L.learn_model(empty, F.lit(True))).count() == 0


def test_query_on_held_out_rows(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.op2_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out and lang[r.doc_id] and r.lang_pred != L.UND]
    assert len(rows) == len(lang) and len(held) > 20
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_all_letters_keep_their_n_grams_apart():
    marks = ["我能吞下玻璃而不伤身体", "日本語の文章です", "한국어 문장입니다", "🙂 Съешь же ещё", "a🙂b"]
    texts = [*marks, "我能 body 文章", "문장 ещё 🙂", "zzz"]
    got = L.kernel_of(marks).values(texts)
    for i, t in enumerate(texts):
        for k, m in enumerate(marks):
            own, theirs = grams_by_hand(t), grams_by_hand(m)
            assert got[i, k] == pytest.approx(len(own & theirs) / np.sqrt(len(own) * len(theirs)), rel=1e-5)


def test_rows_that_repeat_an_id_give_one_model_in_any_order(spark, labelled):
    rng = random.Random(9)
    again = [(i % 7, text_of(rng, lang), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 8)] + labelled[:9] * 2
    rows = labelled + again
    one, many = (L.learn_model(spark.createDataFrame(r, KIND).repartition(n), F.lit(True)) for r, n in ((rows, 1), (rows[::-1], 5)))
    assert np.array_equal(one.kernel.codes, many.kernel.codes) and np.allclose(one.weights, many.weights)


def test_sample_holds_the_smallest_hashes(spark, labelled, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_LANG", 7)
    monkeypatch.setattr(L, "LANDMARKS_PER_LANG", 3)
    docs = frame(spark, labelled)
    hashed = {r.doc_id: (r.h, r.doc_id) for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    got = L.training_sample(docs, F.lit(True)).collect()
    for lang in SYLLABLES:
        want = sorted((i for i, _, x, _ in labelled if x == lang), key=hashed.get)
        assert {r.doc_id for r in got if r.lang == lang} == set(want[:7])
        assert {r.doc_id for r in got if r.lang == lang and r.mark} == set(want[:3])
