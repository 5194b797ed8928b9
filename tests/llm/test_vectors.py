import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.llm import ann_projection as ann
from cairnfield.llm import embedding_dedup as dedup
from cairnfield.llm.ann_projection import KdTree, chi_square_quantile, nearest
from cairnfield.llm.embedding_dedup import SmallWorld, forest

KIND = "vec_id long, embedding array<float>, label int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], KIND).repartition(3)


def clustered(n, d, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 3, d))
    out = np.concatenate([centres, centres[: n // 6] + 0.05 * rng.standard_normal((n // 6, d)), centres[:1] + 0.05 * rng.standard_normal((n - n // 3 - n // 6, d))])
    return out[rng.permutation(len(out))].astype(np.float32)


ODD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [float("inf")] + [1.0] * 15), (9005, [None] + [1.0] * 15), (9006, []), (None, [1.0] * 16), (9007, [1.0, 2.0])]


def test_quantiles():
    assert chi_square_quantile(0.95) == pytest.approx(15.507, abs=1e-3) and chi_square_quantile(0.5) == pytest.approx(7.344, abs=1e-3)


def test_tree_boxes_bound_distances():
    rng = np.random.default_rng(1)
    points, q = rng.standard_normal((1000, 8)), rng.standard_normal((20, 8))
    tree = KdTree(points)
    assert sorted(np.concatenate(tree.leaves)) == list(range(1000)) and max(map(len, tree.leaves)) <= ann.LEAF
    boxes = tree.box_distances(q)
    for k, rows in enumerate(tree.leaves):
        assert (((points[rows][None] - q[:, None]) ** 2).sum(2).min(1) >= boxes[:, k] - 1e-9).all()


def brute_nearest(ids, v, k):
    out = {}
    for i, q in zip(ids, v):
        if i % 20 == 0:
            rows = sorted((-float((q * x).sum()), j) for j, x in zip(ids, v) if j != i)[:k]
            out[i] = [(j, -s) for s, j in rows]
    return out


def test_nearest_finds_what_brute_force_finds(spark):
    v = clustered(900, 16) * np.random.default_rng(2).uniform(0.5, 2, (900, 1)).astype(np.float32)
    v[500:520] = v[500]  # equal vectors: ties go to smaller ids
    got = nearest(frame(spark, [*enumerate(v.tolist()), *ODD]), F.col("vec_id") % 20 == 0, shard_rows=200).collect()
    want = brute_nearest(range(900), v.astype(float), 20)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) - {9006} == set(want)
    hits = 0
    for i, rows in want.items():
        assert [s for _, s in found[i]] == sorted((s for _, s in found[i]), reverse=True)
        assert all(s == pytest.approx(float((v[i].astype(float) * v[j]).sum()), abs=1e-12) for j, s in found[i])
        hits += len({j for j, _ in rows} & {j for j, _ in found[i]})
    assert hits >= 0.97 * 20 * len(want)
    assert found[500][:19] == want[500][:19]


def test_nearest_of_few_and_none(spark):
    few = frame(spark, [(0, [1, 0]), (1, [0, 1]), (1, [0.5, 0.5]), (2, [2, 0])])
    rows = nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(2, 2.0), (1, 0.5), (1, 0.0)]
    assert nearest(frame(spark, []), F.col("vec_id") == 0).count() == 0


def test_recall_on_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    v = np.array([r.embedding for r in rows], float)
    want = brute_nearest([r.vec_id for r in rows], v, 20)
    found = {}
    for r in ann.op8_ann_projection(spark, sf).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(found[i] & {j for j, _ in w}) for i, w in want.items()) >= 0.97 * sum(map(len, want.values()))


def brute_links(v, cosine):
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = n @ n.T >= cosine
    np.fill_diagonal(near, False)
    part = list(range(len(v)))
    for i in range(len(v)):  # rising starts label every node with its least reachable one
        todo = [i]
        while todo:
            x = todo.pop()
            for y in np.flatnonzero(near[x]):
                if part[y] > i:
                    part[y] = i
                    todo.append(y)
    return near.sum(1), part


def test_small_world_finds_all_links():
    v = clustered(3000, 24, 5)
    x = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    world = SmallWorld.build(x)
    width = world.audited_width(0.95)
    found = np.zeros(len(x), int)
    for r, _ in world.within(x, 0.95, width):
        np.add.at(found, r, 1)
    truth = (x @ x.T >= 0.95).sum(1)
    assert abs(found.sum() - truth.sum()) <= 0.002 * truth.sum()


def cut_off(world, nodes):
    """Takes every link to the nodes away."""
    for layer in world.layers:
        layer.links[np.isin(layer.links, nodes)] = -1


def test_links_that_no_beam_reaches_are_found_exactly():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 24))
    x[4000:4400] = x[4000] + 0.02 * rng.standard_normal((400, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    world = SmallWorld.build(x)
    cut_off(world, np.arange(4000, 4400))
    found = sum(len(r) for r, _ in world.within(x, 0.95, world.audited_width(0.95)))
    assert found == int((x @ x.T >= 0.95).sum())


def test_audits_without_links_among_nodes_still_ask():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((5000, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    world = SmallWorld.build(x)
    cut_off(world, np.arange(1000, 5000))
    q = dedup.at_cosine(x, 0.95)
    found = sum(len(r) for r, _ in world.within(q, 0.95, world.audited_width(0.95)))
    assert found == int((q @ x.T >= 0.95).sum())


def test_forest_joins_what_links_join():
    pairs = forest(np.array([5, 4, 9, 3, 5]), np.array([4, 3, 8, 5, 5]))
    assert sorted(pairs) == [(4, 3), (5, 3), (9, 8)]


def test_near_duplicates_equal_brute_force(spark):
    v = clustered(700, 24, 9)
    v[100:130] = v[100]
    rows = list(enumerate(v.tolist()))
    got = {r.vec_id: r for r in dedup.near_duplicates(frame(spark, [*rows, *ODD]), shards=3, block_rows=300).collect()}
    n, part = brute_links(v.astype(float), 0.95)
    assert len(got) == 700 + len(ODD)
    assert [got[i].component_id for i in range(700)] == part
    assert [got[i].n_links for i in range(700)] == n.tolist()
    for i, _ in ODD:
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept == (i is not None)
    assert all(got[i].kept == (part[i] == i) for i in range(700))


def test_repeated_ids_share_a_component(spark):
    rows = [(1, [1, 0]), (7, [1, 0]), (7, [0, 1]), (9, [0, 1]), (3, [-1, 0])]
    got = sorted((r.vec_id, r.component_id, r.n_links) for r in dedup.near_duplicates(frame(spark, rows)).collect())
    assert got == [(1, 1, 1), (3, 3, 0), (7, 1, 1), (7, 1, 1), (9, 1, 1)]


def test_no_vectors(spark):
    assert dedup.near_duplicates(frame(spark, [])).count() == 0
    assert dedup.near_duplicates(frame(spark, [(1, None), (2, [0, 0])])).count() == 2


def test_walk_gives_leaves_by_distance_and_order_fixes_the_tree():
    rng = np.random.default_rng(8)
    points, q = rng.standard_normal((3000, 8)), rng.standard_normal(8)
    tree = KdTree(points)
    again = KdTree(points[tree.order], ordered=True)
    steps = list(tree.walk(q))
    assert [g for g, _, _ in steps] == sorted(g for g, _, _ in steps) and len(steps) == len(tree.leaves)
    assert list(again.walk(q)) == steps
    # a walk that stops early has opened only part of the tree
    assert next(tree.walk(q))[0] == pytest.approx(tree.box_distances(q[None]).min())


def test_recall_over_many_shards(spark):
    rng = np.random.default_rng(12)
    v = np.concatenate([rng.standard_normal((2500, 32)), np.repeat(rng.standard_normal((50, 32)), 10, 0) + 0.1 * rng.standard_normal((500, 32))]).astype(np.float32)
    want = brute_nearest(range(len(v)), v.astype(float), 20)
    found = {}
    for r in nearest(frame(spark, list(enumerate(v.tolist()))), F.col("vec_id") % 20 == 0, shard_rows=300).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(found[i] & {j for j, _ in w}) for i, w in want.items()) >= 0.95 * sum(map(len, want.values()))


def test_nearest_of_extreme_magnitudes_and_repeated_queries(spark):
    rows = [(0, [1e200, 0]), (1, [1e200, 1e199]), (2, [1e-200, 1e-200]), (3, [0.0, 1e150]), (20, [1, 1]), (20, [1, -1]), (20, [1, 1])]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    one, two = (sorted(map(tuple, nearest(docs.repartition(n), F.col("vec_id") % 20 == 0).collect())) for n in (1, 3))
    assert one == two and [(r[1], r[2]) for r in one if r[0] == 0] == [(1, 1), (2, 20), (3, 20), (4, 20), (5, 2), (6, 3)]
    assert len([r for r in one if r[0] == 20]) == 4


@pytest.mark.parametrize("copies", [9, 30])
@pytest.mark.parametrize("equal", [False, True])
def test_nearest_of_a_query_whose_id_repeats(spark, copies, equal):
    rng = np.random.default_rng(copies)
    v = rng.standard_normal((190, 12))
    own = np.repeat(v[20:21], copies, 0) + (0 if equal else 1e-3 * rng.standard_normal((copies, 12)))
    rows = [(i, x) for i, x in enumerate(v) if i != 20] + [(20, x) for x in own] + [(i, own[0]) for i in (321, 322, 323, 323)]
    docs = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>")
    for shard_rows in (None, 60):
        got = nearest(docs.repartition(3), F.col("vec_id") == 20, shard_rows=shard_rows).orderBy("rank").collect()
        assert [r.rank for r in got] == list(range(1, 21))
        wants = [sorted((-float((x * q).sum()), i) for i, x in rows if i != 20)[:20] for q in own]  # one of the rows is asked
        assert any([r.vec_id for r in got] == [i for _, i in w] and np.allclose([r.score for r in got], [-s for s, _ in w]) for w in wants)


def test_extreme_magnitudes_link_as_double_precision_says(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-300, 1e-300]), (4, [1e200, -1e200]), (5, [3.0, 3.0]), (6, [5e-324, 5e-324]), (6, None)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in dedup.near_duplicates(docs).collect())
    assert got == [(1, 4, 1), (2, 4, 1), (3, 4, 1), (4, 0, 4), (5, 4, 1), (6, 0, 6), (6, 4, 1)]


def test_stored_graphs_come_back_and_other_shards_are_asked(spark):
    v = clustered(6000, 24, 3)
    rows = frame(spark, list(enumerate(v.tolist())))
    classes = rows.select("vec_id", F.lit(1).cast("long").alias("copies"), F.col("embedding").cast("array<double>").alias("v"))
    graph = dedup.graphs(classes, 2, 0.95).where("shard = 0").orderBy("node").collect()
    held = dedup.Held(*(np.array([r[c] for r in graph]) for c in ("vec_id", "copies", "v")), [bytes(r.layers) for r in graph], graph[0].width)
    world = SmallWorld.build(held.world.x)
    assert len(world.layers) == len(held.world.layers) and all(np.array_equal(a.links, b.links) for a, b in zip(world.layers, held.world.layers, strict=True))
    truth = brute_links(v.astype(float), 0.95)
    got = {r.vec_id: r for r in dedup.near_duplicates(rows, shards=8).collect()}
    assert sum(got[i].n_links for i in got) >= 0.998 * sum(truth[0]) > 0
    assert sum(got[i].component_id == truth[1][i] for i in got) >= 0.99 * len(v)


def test_small_tables_are_searched_by_graphs_too(spark, sf, monkeypatch):
    table = sf.replace("sf0.001", "sf0.01") + "/embeddings.parquet"
    rows = spark.read.parquet(table).select("vec_id", F.col("embedding").cast("array<double>").alias("v")).collect()
    classes = spark.createDataFrame([(r.vec_id, 1, r.v) for r in rows], "vec_id long, copies long, v array<double>")
    shards = dedup.graphs(classes, dedup.SHARDS, dedup.COSINE).select("shard", "width", "recall").distinct().collect()
    assert len(shards) == dedup.SHARDS and all(s.width >= dedup.FIRST_BEAM and s.recall >= dedup.RECALL for s in shards)
    n, part = brute_links(np.array([r.v for r in rows]), dedup.COSINE)
    got = {r.vec_id: r for r in dedup.op4_embedding_dedup(spark, sf.replace("sf0.001", "sf0.01")).collect()}
    assert sum(got[r.vec_id].n_links for r in rows) >= 0.998 * sum(n)


def test_shards_hold_bytes_not_rows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHARD_BYTES", 1 << 14)
    seen = []
    monkeypatch.setattr(dedup, "graphs", lambda c, shards, cosine, made=dedup.graphs: seen.append(shards) or made(c, shards, cosine))
    v = clustered(200, 64, 5)
    assert dedup.near_duplicates(frame(spark, list(enumerate(v.tolist())))).count() == 200
    assert seen == [200 // (1 << 14 >> 9) + 1]
