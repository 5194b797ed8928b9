import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

KIND = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"aa": "ba be bi bo bu da de di do du".split(), "zz": "xyl xen zor zik vex wug qua kwo pry fyz".split()}


def words(rng, lang, n):
    return [rng.choice(SYLLABLES[lang]) + rng.choice(SYLLABLES[lang]) + rng.choice(SYLLABLES[lang]) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(240):
        lang = "aa" if i % 3 else "zz"
        text = words(rng, lang, 60)
        bad = i % 6 == 0
        if bad:
            for at in (5, 20, 40):
                text[at] = rng.choice(["scoundrel", "nitwit", "blockhead"])
        rows.append((i, " ".join(text), lang))
        labels.append((i, 1, int(bad)))
    shared = "this very line is found in many of the documents"
    plain = " ".join(words(rng, "aa", 60))
    rows += [(300 + k, f"{' '.join(words(rng, 'aa', 30))}\n{shared}", "aa") for k in range(4)]
    rows += [(310, plain, "aa"), (311, plain, "aa"), (312, plain + " bebebe", None)]
    rows += [(320, "1234 !!", None), (321, "", None), (322, None, None)]
    rows += [(330, " ".join(words(rng, "aa", 30)) + " n1tw1t and s c o u n d r e l and blooockhead", None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], KIND)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {i: t for i, t, _ in rows}


def test_stages_take_effect(spark, corpus):
    path, texts = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, path), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    left = {k: {r.doc_id: r.text for r in v.collect()} for k, v in seen.items() if k != "packing"}
    toxic = {i for i in range(0, 240, 6)} | {330}
    want = set(texts) - {320, 321, 322}
    assert set(left["language_id"]) == want
    want -= toxic
    assert set(left["toxicity"]) == want
    assert set(left["line_dedup"]) == want
    assert [("\n" in left["line_dedup"][i]) for i in range(300, 304)] == [False, False, False, True]
    want -= {311, 312}
    assert set(left["minhash_dedup"]) == want
    pieces = seen["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r.doc_id for r in pieces} == want and all(r.n == r.m for r in pieces)


UNLIKE = {
    900: "Съешь же ещё этих мягких французских булок да выпей чаю", 901: "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία", 902: "我能吞下玻璃而不伤身体", 903: "привет",
    904: "xkqz vbnwrt ghjklp qwrtz sdfgh mnbvc xcvbn plkjh wrtzp", 905: "for (k, v) in zip(hq, jw): print(x[k] == v); import numpy",
    906: "我", 907: "zażółć gęślą jaźń pchnąć w tę łódź jeża lub ośm skrzyń fig",
}


def test_texts_that_resemble_no_language_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clean = [r for r in docs.orderBy("doc_id").limit(40).collect()]
    short = [(10**9 + 10 * i + n, " ".join(r.text.split()[3 : 3 + n]), None, "s", 0) for i, r in enumerate(clean) for n in (2, 4, 8) if r.text and any(map(str.isalpha, " ".join(r.text.split()[3 : 3 + n])))]
    more = [(10**8 + i, t, None, "s", 0) for i, t in UNLIKE.items()]
    whole = docs.unionByName(spark.createDataFrame(short + more, KIND))
    left = {r.doc_id for r in P.language(spark, whole, sf).select("doc_id").collect()}
    assert not left & {i for i, *_ in more}
    lost = {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()} - left
    assert not lost
    assert {i for i, *_ in short} <= left


def test_run_gives_the_rows_of_the_stages(spark, corpus):
    path, _ = corpus
    assert P.run(spark, path).select("doc_id").distinct().count() > 150


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
