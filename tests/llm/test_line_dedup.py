import hashlib
import random
import time

import pytest

from cairnfield.llm import line_dedup as L
from tests.compare import duck_rows, spark_rows

KIND = "doc_id long, text string, drops string, n_lines string"
SPACE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(3)


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def by_hand(rows, min_chars=20, min_docs=3):
    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders.setdefault(key(line), set()).add(i)
    hot = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or hot.get(key(x), i) == i]
        out.append((-1 if i is None else i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def rows_of(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


LONG = "The Same Line is in many of the documents é"


def corpus():
    rng = random.Random(4)
    pool = [f"a line of its own kind number {i} here" for i in range(30)] + ["short", "", " ", LONG, LONG.lower() + " \t", "\x0b " + LONG.upper().replace("É", "é"), "x" * 19, "x" * 20, "é" * 20, "É" * 20]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    return [*rows, (200, None), (201, ""), (202, "\n"), (203, LONG + "\n" + LONG), (None, LONG), (50, rows[50][1]), (51, LONG), (300, "\n".join([LONG, "q" * 40] * 20_000)), (7, None)]


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_kept_lines_equal_brute_force(spark, batches):
    rows = corpus()
    got = L.dedup_lines(frame(spark, rows), batches=batches)
    assert got.columns == ["doc_id", "text", "drops", "n_lines", "kept_text", "n_dropped"]  # a clashing column is replaced
    assert rows_of(got) == by_hand(rows)


def test_other_bounds(spark):
    rows = corpus()
    assert rows_of(L.dedup_lines(frame(spark, rows), min_chars=5, min_docs=2)) == by_hand(rows, 5, 2)


def test_runs_are_compacted_by_levels(spark):
    runs = L.LineRuns(spark, fanout=3)
    batches = [[(100 - 10 * b - i, k, k) for i in range(3) for k in range(b, b + 4)] for b in range(7)]
    for rows in batches:
        runs.add(spark.createDataFrame(rows, "doc_id long, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [1, 2]
    got = {r.h1: (r.n_docs, r.keeper) for r in L.LineRuns.totals(runs.rows()).collect()}
    flat = [x for b in batches for x in b]
    assert got == {k: (sum(x[1] == k for x in flat), max(x[0] for x in flat if x[1] == k)) for k in range(10)}


def test_empty_tables(spark):
    assert L.dedup_lines(frame(spark, [])).count() == 0
    assert rows_of(L.dedup_lines(frame(spark, [(None, None)]))) == [(-1, 1, 0, "")]


def test_query_equals_the_sql(spark, sf):
    assert spark_rows(L.op5_line_dedup(spark, sf)) == duck_rows(L.ORACLE_SQL, sf)


def test_digests_are_those_of_the_kept_text(spark, tmp_path):
    rows = [(i, f"{LONG}\n{i}") for i in range(3)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in L.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, _, t in by_hand(rows)}


def test_columns_of_any_name_pass_through(spark):
    names = ["__doc", "__kept", "id", "gone", "text_hash", "h1", "pos", "column3", "kept_text"]
    rows = [(i, f"{LONG}\n{i}", *[f"{n}{i}" for n in names]) for i in range(3)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names]).repartition(2)
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", *names[:-1], "n_lines", "kept_text", "n_dropped"]
    assert sorted((r.doc_id, r["__doc"], r["__kept"], r.gone, r.kept_text) for r in out.collect()) == [(i, f"__doc{i}", f"__kept{i}", f"gone{i}", f"{i}" if i < 2 else f"{LONG}\n2") for i in range(3)]


def test_a_text_of_many_repeated_lines_takes_seconds(spark):
    shared = [f"a line that three documents hold, number {k}" for k in range(50_000)]
    own = [f"a line that only one document holds, number {k}" for k in range(50_000)]
    whole = [x for pair in zip(shared, own) for x in pair]
    rows = [(1, "\n".join(whole)), (2, "\n".join(shared)), (3, "\n".join(shared))]
    began = time.monotonic()
    got = rows_of(L.dedup_lines(frame(spark, rows)).cache())
    assert time.monotonic() - began < 60
    assert got == [(1, 100_000, 50_000, "\n".join(own)), (2, 50_000, 50_000, ""), (3, 50_000, 0, "\n".join(shared))]


@pytest.mark.parametrize("frequent", [1, 20, 10_000])
def test_frequent_lines_are_taken_apart(spark, monkeypatch, frequent):
    """With one frequent line, some, or all of them."""
    monkeypatch.setattr(L, "FREQUENT", frequent)
    rows = corpus()
    assert rows_of(L.dedup_lines(frame(spark, rows))) == by_hand(rows)
    keyed = spark.range(1000).selectExpr("id as doc_id", "id % 2 as h1", "if(id % 2 = 0, 0, id) as h2")
    hot = spark.sql("select 0L as h1, 0L as h2, 500L as n_docs, 998L as keeper union all select 1L, 3L, 3L, 3L")
    assert sorted(r.keeper for r in L.repeats(keyed, hot).collect()) == [3] + [998] * 500
