import numpy as np
import pytest

from cairnfield.llm import whitening as W

KIND = "vec_id long, embedding array<float>, label int, x string, n string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", "n") for i, v in rows], KIND).repartition(parts)


def by_hand(rows):
    """(x of the rows that remain, eigenvalues, eigenvectors, exact deviations)."""
    held = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in held])
    n, s = len(x), x.sum(0)
    e, v = np.linalg.eigh(np.cov((x - s / n).T, bias=True).reshape(x.shape[1], -1))
    return [i for i, _ in held], x, e[::-1], v[:, ::-1], [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]


def check(got, rows, components=8):
    ids, x, e, v, far = by_hand(rows)
    n, k = len(x), min(components, int((e > 1e-9 * e[0]).sum()))
    assert len(got) == n * k
    seen = {}
    for r in got:
        seen.setdefault(r.component, []).append(r)
    centred = x - x.sum(0) / n
    for c in range(1, k + 1):
        part = sorted(seen[c], key=lambda r: (str(r.vec_id), r.whitened))
        true = centred @ v[:, c - 1] / np.sqrt(e[c - 1])
        sign = min((1, -1), key=lambda s: np.abs(np.sort([r.whitened for r in part]) - np.sort(s * true)).max())
        order = sorted(range(n), key=lambda j: (str(ids[j]), sign * true[j]))
        np.testing.assert_allclose([r.whitened for r in part], [sign * true[j] for j in order], rtol=0, atol=1e-7)
        assert sorted(int(r.deviation) for r in part) == sorted(far)
        assert all(r.n == n and abs(r.explained / (e[c - 1] / e.sum()) - 1) < 1e-9 and 0 <= r.identity_error < 1e-9 for r in part)


@pytest.mark.parametrize("d", [1, 2, 5, 12])
def test_equals_an_eigendecomposition(spark, d):
    rng = np.random.default_rng(d)
    mix = rng.normal(size=(d, d)) * np.geomspace(1, 0.02, d)[:, None]
    rows = [(i, (rng.normal(size=d) @ mix + 7).tolist()) for i in range(300)]
    check(W.whiten(frame(spark, rows)).collect(), rows)


def test_left_out_rows_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (5, rows[5][1]), (5, rows[5][1]), (70, [0.0] * 4)]
    bad = [(80, None), (81, []), (82, [1.0, None, 2.0, 3.0]), (83, [float("nan"), 1.0, 1.0, 1.0]), (84, [float("inf"), 1.0, 1.0, 1.0]), (85, [1e30, 0.0, 0.0, 0.0]), (86, [1.0, 2.0])]
    check(W.whiten(frame(spark, rows + bad, 7)).collect(), rows)


def test_tables_without_deviation(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = W.whiten(frame(spark, rows))
        assert got.collect() == [] and got.columns == [f.split()[0] for f in W.RESULT.split(", ")]
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]  # one direction alone
    got = W.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_factors_joined_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    monkeypatch.setattr(W, "BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(100)]
    check(W.whiten(frame(spark, rows, 9)).collect(), rows)


def test_jacobi_keeps_small_values():
    rng = np.random.default_rng(3)
    q, p = (np.linalg.qr(rng.normal(size=(30, 30)))[0] for _ in range(2))
    true = np.geomspace(1e6, 1e-6, 30)
    size, v = W.jacobi(np.linalg.qr(q * true @ p.T, mode="r"))
    np.testing.assert_allclose(size, true, rtol=1e-3)
    np.testing.assert_allclose(v.T @ v, np.eye(30), atol=1e-12)
    size, v = W.jacobi(np.zeros((3, 3)))
    assert size.tolist() == [0, 0, 0]


@pytest.mark.parametrize("n", [3, 10**6, 10**10, 10**16])
def test_exact_deviations(n):
    x = np.random.default_rng(4).integers(90_000, 110_000, (20, 5))
    sums = tuple(int(v) * n // 20 for v in x.sum(0))
    assert W.squared_distance(x, n, sums) == [sum((n * int(a) - b) ** 2 for a, b in zip(r, sums)) for r in x]


def test_query(spark, sf):
    got = W.op12_whitening(spark, sf)
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(got.collect(), rows)
