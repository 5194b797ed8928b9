import math
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnfield.llm import piece_sampling as P
from cairnfield.llm.piece_sampling import MARK, Pieces, Sampler, decode, encode, model_path, op6_piece_sampling


@pytest.fixture(scope="module")
def sampler():
    return Sampler(model_path())


def all_paths(pieces, text):
    """{ids: weight} of every segmentation of a text without blanks or marks, by brute force."""
    out = {0: {(): 0.0}}
    for end in range(1, len(text) + 1):
        out[end] = {}
        for start, ids, w in pieces.edges(text, end):
            for path, weight in out[start].items():
                out[end][path + ids] = weight + w
    return {p: math.exp(w) for p, w in out[len(text)].items()}


def test_samples_follow_the_weights_of_all_paths(sampler):
    paths = all_paths(sampler.pieces, " there")
    total = sum(paths.values())
    n = 20_000
    seen = Counter(tuple(x.tolist()) for x in sampler(list(range(n)), [" there"] * n))
    assert set(seen) <= set(paths)
    for path, weight in paths.items():
        p = weight / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9
    assert len(seen) > 2


HARD = ["", " ", "   ", "a  b ", "\n", "\n\n a\n", MARK, f"a{MARK}{MARK} b", "日本語 \U0001f600\U0001f600", "tab\tnul\x00", "é́", "<0x41><s></s><unk>", "x" * 5000, "�"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts_come_back(sampler, text):
    assert sampler.pieces.decode(sampler([3], [text])[0]) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=5))
def test_any_texts_come_back(sampler, texts):
    assert [sampler.pieces.decode(i) for i in sampler(list(range(len(texts))), texts)] == texts


def test_rows_depend_on_key_and_text_alone(sampler):
    text = "the same words over and over " * 20
    alone = sampler([7], [text])[0]
    among = Sampler(model_path(), most=5)([1, 7, 8], ["other text", text, text])
    assert np.array_equal(alone, among[1]) and not np.array_equal(alone, among[2])
    assert not np.array_equal(alone, Sampler(model_path(), seed=2)([7], [text])[0])


def test_frame_with_nulls_and_clashing_names(spark):
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (None, "c", "x"), (1, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    got = decode(encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.decoded or "") for r in got) == sorted((d or 0, t or "", t or "") for d, t, _ in rows)
    assert [r.ids for r in got if r.doc_id == 2] == [None] and [bytes(r.ids) for r in got if r.doc_id == 3] == [b""]
    same = [bytes(r.ids) for r in got if r.doc_id == 1]
    assert same[0] == same[1]
    assert encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_is_lossless(spark, sf):
    rows = op6_piece_sampling(spark, sf).collect()
    assert rows and all(r.lossless for r in rows)


def test_long_segments_follow_the_same_weights(sampler, monkeypatch):
    monkeypatch.setattr(P, "LONG", 4)
    keys = list(range(2000))
    one = sampler(keys, [" there are bäume \U0001f600"] * 2000)
    monkeypatch.setattr(P, "LONG", 2000)
    assert all(np.array_equal(a, b) for a, b in zip(one, sampler(keys, [" there are bäume \U0001f600"] * 2000), strict=True))


@pytest.mark.parametrize("text", ["x" * 1_000_000, "thequickbrownfox" * 62_500, "我能\U0001f600" * 333_333, "ab " * 333_333])
def test_a_million_characters_take_seconds(sampler, text):
    began = time.monotonic()
    ids = sampler([3], [text])[0]
    assert time.monotonic() - began < 60
    assert sampler.pieces.decode(ids) == text


def test_sharpness_is_a_parameter(spark):
    docs = spark.createDataFrame([(i, "there are words") for i in range(50)], "doc_id long, text string")
    sizes = {s: sum(len(r.ids) for r in encode(docs, sharpness=s).collect()) for s in (0.2, 3.0)}
    assert sizes[0.2] != sizes[3.0]
