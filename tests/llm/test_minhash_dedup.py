import random
import re

import numpy as np
import pytest

from cairnfield.llm import minhash_dedup as M
from cairnfield.llm.components import components
from tests.compare import duck_rows, spark_rows

KIND = "doc_id long, text string, sig string, payload string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(3)


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def least_reachable(ids, linked):
    part = {}
    for i in sorted(ids):
        todo = [] if i in part else [i]
        while todo:
            x = todo.pop()
            if x not in part:
                part[x] = i
                todo += linked[x]
    return part


def by_hand(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    linked = {i: set() for i, _ in rows if i is not None}
    for i, a in sets:
        for j, b in sets:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                linked[i].add(j)
    part = least_reachable(linked, linked)
    return sorted(((-1 if i is None else i), len(s), -1 if i is None else part[i], i is not None and part[i] == i) for i, s in sets)


def rows_of(df):
    fill = lambda x: -1 if x is None else x
    return sorted((fill(r.doc_id), r.n_shingles, fill(r.component_id), r.kept) for r in df.collect())


def corpus(seed=3, groups=25):
    """Groups whose members differ from each other by some words, on both sides of the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for g in range(groups):
        text = [word() for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(rng.randint(1, 9)):
            own = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:  # a chain: the next member starts from this one
                text = own
            rows.append((n, (" ", "\n", " \t")[n % 3].join(own).title() if n % 2 else " ".join(own)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_components_equal_brute_force(spark, percent):
    rows = corpus(percent)
    odd = [(900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "one  TWO"), (905, "one two three"), (None, rows[0][1]), (906, "É b c d e"), (907, "é b c d e"), (908, "w " * 60_000), (909, "W\t" * 50_000)]
    repeated = [(920, rows[1][1]), (920, rows[2][1]), (920, None), (rows[3][0], rows[3][1])]
    rows += odd + repeated
    assert rows_of(M.near_duplicates(frame(spark, rows), percent)) == by_hand(rows, percent)


def test_hot_groups_of_copies_and_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)  # buckets of many blocks, stars of many groups
    monkeypatch.setattr(M, "STAR", 4)
    rng = random.Random(8)
    text = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(text)) for i in range(40)]
    for i in range(40, 120):
        own = list(text)
        own[rng.randrange(120)] = f"v{i}"
        own[rng.randrange(120)] = f"u{i}"
        rows.append((i, " ".join(own)))
    assert rows_of(M.near_duplicates(frame(spark, rows), 85)) == by_hand(rows, 85)


def test_members_that_are_far_from_their_hub_are_linked(spark, monkeypatch):
    """Near copies of each other that share buckets with a smaller doc_id that they aren't near enough to."""
    monkeypatch.setattr(M, "BLOCK", 4)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    hub = list(base)
    for k in rng.sample(range(300), 9):
        hub[k] = f"h{k}"
    rows = [(0, " ".join(hub))]
    for i in range(1, 30):
        own = list(base)
        own[rng.randrange(300)] = f"v{i}"
        rows.append((i, " ".join(own)))
    assert rows_of(M.near_duplicates(frame(spark, rows), 85)) == by_hand(rows, 85)


def test_slices_of_long_texts_give_the_same_words(monkeypatch):
    text = "Aé bc\tdef  ghij " * 500
    whole = M.word_hashes(text)
    monkeypatch.setattr(M, "SLICE_BYTES", 64)
    assert np.array_equal(M.word_hashes(text), whole) and len(whole) == 2000 and len(np.unique(whole)) == 4


def test_empty_tables(spark):
    assert M.near_duplicates(frame(spark, [])).count() == 0
    assert rows_of(M.near_duplicates(frame(spark, [(1, None)]))) == [(1, 0, 1, True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_star_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(500 + i, 501 + i) for i in range(60)] + [(3, None), (5, 5)]
    linked = {}
    for u, v in edges:
        if v is not None and u != v:
            linked.setdefault(u, set()).add(v)
            linked.setdefault(v, set()).add(u)
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == least_reachable(linked, linked)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_equals_the_sql(spark, sf):
    assert spark_rows(M.op3_minhash_dedup(spark, sf)) == duck_rows(M.ORACLE_SQL, sf)


def test_open_buckets_write_a_small_multiple_of_their_rows(spark):
    n = 50_000
    at = spark.range(1, n + 1).selectExpr("7L as key", "0L as hub", "id as doc_id", "1L as component")
    hub = spark.sql("select 7L as key, 0L as hub, 0L as doc_id, 0L as component")
    assert M.open_buckets(at.union(hub)).count() == 0  # the hub alone opens no bucket
    foreign = spark.sql("select 7L as key, 0L as hub, 99999L as doc_id, 99999L as component")
    whole = at.union(hub).union(foreign)
    rest = M.residual(whole, M.open_buckets(whole))
    assert n < rest.count() <= 1.01 * n and rest.groupBy("key", "ask", "part").count().agg({"count": "max"}).first()[0] < 2 * M.BLOCK


def test_a_star_of_many_leaves_takes_part_in_one_round(spark, monkeypatch):
    from cairnfield.llm import components as C

    seen = []
    monkeypatch.setattr(C, "large_star", lambda e, made=C.large_star: seen.append(e.count()) or made(e))
    edges = spark.range(1, 20_001).selectExpr("id as u", "0L as v").union(spark.sql("select 20000L, 30000L union all select 30001L, 30000L")).repartition(4)
    got = {r.id: r.component_id for r in C.components(edges).collect()}
    assert got == dict.fromkeys([*range(20_001), 30_000, 30_001], 0)
    assert max(seen) < 10
