import re
from fractions import Fraction
from itertools import permutations

import pytest

from cairnfield.llm import filter_audit as A
from tests.compare import duck_rows, spark_rows

KIND = "doc_id long, text string, source string, mask string, digest string"
NAMES = [f.split()[0] for f in A.RESULT.split(", ")]


def fails_of(text, smaller):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": text in smaller,
    }
    return {k for k, v in found.items() if v}


def by_hand(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, source in docs:
        smaller = {t or "" for j, t, _ in docs if i is not None and j is not None and j < i}
        parts.setdefault(source or "", []).append((i, fails_of(text or "", smaller)))
    out = []
    for part, rows in parts.items():
        taken = dict.fromkeys("ABCDE", 0)
        made = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                kept = [r for r in left if f not in r[1]]
                taken[f] += len(gone)
                redundant = sum(f in r[1] for r in rows) - len(gone)
                made.append([part, "".join(order), step, len(kept), len(gone), redundant, sum(r[1] == {f} for r in rows), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)])
                left = kept
        out += [(*m, taken[m[1][m[2] - 1]]) for m in made]
    return sorted(out)


WORDS = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, WORDS, "a"), (2, WORDS, "b"), (3, WORDS, "a"), (4, None, "a"), (5, "", None), (6, "", ""), (7, "the " * 80, "b"), (8, "THE " * 80 + "#", "b"), (9, WORDS + "\x0b$", "a"),
    (10, WORDS.upper(), "a"), (11, "é " * 60, "c"), (12, " \t\r\n", "c"), (1, WORDS, "a"), (1, WORDS, "c"), (None, WORDS, "a"), (None, None, None), (13, WORDS.upper(), "b"),
    (14, "x " * 49 + "A", "c"), (14, "y", "c"), (15, " ".join(str(i % 39) for i in range(60)), "c"), (16, " ".join(str(i % 40) for i in range(61)), "c"), (17, "A" + "b" * 19, "c"), (18, "A" + "b" * 18, "c"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (7, 0, 1), (8, 1, 1), (99, 1, 1), (None, 1, 1), (14, 1, 0)]


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in docs], KIND).repartition(3)
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(2)


def rows_of(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def test_rows_equal_brute_force(spark):
    got = rows_of(A.audit(A.mask_counts(*frames(spark, DOCS, LABELS))))
    assert got == by_hand(DOCS, LABELS)
    assert len(got) == 600 * len({s or "" for _, _, s in DOCS})


def test_a_hot_text_and_a_hot_id(spark):
    docs = [(i, "" if i % 3 else WORDS, f"s{i % 2}") for i in range(120)] + [(5, f"{WORDS} {i}", "s0") for i in range(60)] + [(7, WORDS, "s1")] * 30
    labels = [(i, i % 2, (i + 1) % 2) for i in range(40)]
    assert rows_of(A.audit(A.mask_counts(*frames(spark, docs, labels)))) == by_hand(docs, labels)


def test_empty_tables(spark):
    assert A.audit(A.mask_counts(*frames(spark, [], []))).collect() == []
    assert rows_of(A.audit(A.mask_counts(*frames(spark, DOCS, [])))) == by_hand(DOCS, [])


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_corners_and_shares(seed):
    import random

    rng = random.Random(seed)
    n = 1 + seed
    counts = [rng.randint(0, 9) for _ in range(1 << n)]
    p = A.polynomial(counts)
    gone = [sum(c for m, c in enumerate(counts) if m & s) for s in range(1 << n)]
    assert A.corners(p) == gone
    orders = list(permutations(range(n)))
    for k in range(n):
        taken = sum(gone[sum(1 << i for i in o[: o.index(k) + 1])] - gone[sum(1 << i for i in o[: o.index(k)])] for o in orders)
        assert A.shares(p, n)[k] == Fraction(taken, len(orders))


def test_query_equals_the_sql(spark, sf):
    assert spark_rows(A.op11_filter_audit(spark, sf)) == duck_rows(A.ORACLE_SQL, sf)
