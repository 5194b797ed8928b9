import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnfield.llm import packing
from cairnfield.llm.packing import WINDOW, WordTokenizer, op9_packing, pack, pack_group, powers, step_groups, tokenizer_path


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(tokenizer_path())


HARD = [
    "", " ", "  ", "a  b", "a   b", "a \n b", "a\n \nb", "a\n  b ", " lead", "tail ", "tail  ", "x\t y", "it's  we'll",
    "a<|endoftext|>b  <|endoftext|> c", "é  b", "日本 語　 x", "a\r\n b\r\n\r\n c", "\U0001f600 \U0001f600x", "a   b",
]


@pytest.mark.parametrize("text", HARD)
def test_words_give_the_ids_of_whole_texts(words, text):
    assert words(text) == (words.whole(text) if text else b"")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1.' \n\t\r 　é\x1c<|endoftext|>", max_size=30))
def test_words_give_the_ids_of_whole_texts_of_any_kind(words, text):
    assert words(text) == (words.whole(text) if text else b"")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aBthéÿ\u0240ßªº×.,;:!?\n'1", max_size=8), max_size=12))
def test_words_of_units_give_the_ids_of_whole_texts(words, parts):
    text = " ".join(parts)
    assert words(text) == (words.whole(text) if text else b"")


def test_cache_is_bounded():
    small = WordTokenizer(tokenizer_path(), cache_words=5)
    for i in range(20):
        text = f"x a{i} b{i} c{i}"
        assert small(text) == small.whole(text)
        assert len(small.cache) <= 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60))
def test_groups_are_packed_whole_and_without_padding(lengths):
    seen = {}
    for _, pieces in pack_group(lengths):
        size = sum(n for _, _, n in pieces)
        assert size <= WINDOW and size & (size - 1) == 0
        for d, s, n in pieces:
            assert n > 0
            seen.setdefault(d, []).append((s, n))
    assert set(seen) == set(range(len(lengths)))
    for d, parts in seen.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == lengths[d]


def test_powers():
    assert powers(0) == [] and powers(77) == [64, 8, 4, 1]


def test_step_groups_are_even():
    rng = random.Random(1)
    sequences = pack_group([rng.randint(1, 1500) for _ in range(500)])
    groups = step_groups(sequences, 8192)
    for tier in packing.TIERS:
        sizes = [sum(t for (t, _), g in zip(sequences, groups) if g == k and t == tier) for k in {g for (t, _), g in zip(sequences, groups) if t == tier}]
        assert max(sizes) - min(sizes) <= tier and max(sizes) <= 8192


def test_pieces_hold_the_ids(spark, words):
    rows = [(1, "a b c"), (2, None), (3, ""), (3, ""), (None, "x y"), (4, "word " * 3000)]
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, ids string").repartition(2)
    got = pack(docs).collect()
    whole = {d: [words(t or "") + b"\0\0\0\0" for i, t in rows if i == d] for d, _ in rows}
    for d in whole:
        parts = sorted((r for r in got if r.doc_id == d), key=lambda r: (r.start, r.sequence_id, r.offset))
        assert sum(r.length for r in parts) == sum(len(w) // 4 for w in whole[d])
        if len(whole[d]) == 1:
            assert b"".join(bytes(r.ids) for r in parts) == whole[d][0]
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_covers_every_document_with_the_library_ids(spark, sf, words):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_packing(spark, sf).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(docs)
    for d, parts in found.items():
        ids = words.whole(docs[d] or "") + b"\0\0\0\0"
        assert sum(r.length for r in parts) == len(ids) // 4 == parts[0].doc_tokens
        for r in parts:
            assert zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
