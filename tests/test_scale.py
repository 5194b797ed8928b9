"""Costs that must not outgrow the input: rows that are shuffled, what passes the driver, groups in one task."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import cells as raster
from cairnfield.operators import scoring, series, spatial
from cairnfield.plans import pipelines

#: That of spatial.resampled.
TILE = 128


def exchanges(df):
    """(name, rows written) of each exchange of df's plan after it has run; what else has rows in the driver is a broadcast."""
    df.collect()

    def walk(plan):
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(plan.executedPlan())
        elif "QueryStage" in name:
            yield from walk(plan.plan())
        else:
            if name in ("Exchange", "BroadcastExchange"):
                metric = "shuffleRecordsWritten" if name == "Exchange" else "numOutputRows"
                yield name, plan.metrics().apply(metric).value()
            children = plan.children()
            for k in range(children.size()):
                yield from walk(children.apply(k))

    return list(walk(df._jdf.queryExecution().executedPlan()))


@pytest.fixture
def no_broadcast(spark):
    """Joins of a test's small tables go the way that large ones take."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def field(spark, rows, cols):
    return spark.range(rows * cols).select(F.expr(f"id div {cols}").alias("row"), (F.col("id") % cols).alias("col"), F.sin("id").alias("value"))


def test_resampling_moves_a_cell_about_once(spark, no_broadcast):
    cells = field(spark, 300, 100)
    targets = cells.select(F.col("row").alias("r"), F.col("col").alias("c"), (F.col("row") * 0.9 + 0.3).alias("v"), (F.col("col") * 0.9 + 0.2).alias("u"))
    moved = sum(n for _, n in exchanges(spatial.resampled(targets, cells, ["r", "c"], "v", "u", "cubic")))
    assert moved < 4 * 30000


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic"])
def test_resampling_over_borders_of_tiles_gaps_and_repeats(spark, method):
    """Cells on both sides of tiles' borders and of 0, one of them twice, one without a value; a target without a place."""
    rng = np.random.default_rng(3)
    cells = [(r, c, float(rng.normal())) for r in range(-4, 5) for c in range(TILE - 4, TILE + 5)]
    cells += [(0, TILE, 2.5), (1, TILE, None)]
    cells = [x for x in cells if x[:2] != (2, TILE + 1)]
    targets = [(k, float(rng.uniform(-7, 7)), float(rng.uniform(TILE - 7, TILE + 7))) for k in range(400)]
    one = {
        "nearest": lambda d: float(-0.5 < d <= 0.5),
        "bilinear": lambda d: max(1 - abs(d), 0.0),
        "cubic": lambda d: (1.5 * abs(d) - 2.5) * d * d + 1 if abs(d) < 1 else ((-0.5 * abs(d) + 2.5) * abs(d) - 4) * abs(d) + 2 if abs(d) < 2 else 0.0,
    }[method]
    want = {}
    for k, v, u in targets:
        held = [(one(v - r) * one(u - c), x) for r, c, x in cells if x is not None]
        weight = sum(w for w, _ in held)
        want[k] = sum(w * x for w, x in held) / weight if any(w for w, _ in held) else None
    want[400] = None
    found = spatial.resampled(spark.createDataFrame([*targets, (400, None, 3.0)], "k long, v double, u double"), spark.createDataFrame(cells, "row long, col long, value double"), ["k"], "v", "u", method)
    got = {r["k"]: r["value"] for r in found.collect()}
    assert got.keys() == want.keys()
    for k, x in want.items():
        assert (got[k] is None) == (x is None), k
        assert x is None or math.isclose(got[k], x, rel_tol=1e-6, abs_tol=1e-6), k


def test_objects_and_their_attributes_pass_no_broadcast(spark):
    mask = field(spark, 60, 20).where("value > 0.1")
    labels = raster.components(mask, 20)
    sizes = labels.groupBy("label").agg(F.count("*").alias("n"))
    for df in (labels, raster.perimeter(labels), raster.shape(labels), raster.scattered(sizes, labels, F.col("n").cast("double"))):
        assert [name for name, _ in exchanges(df) if name == "BroadcastExchange"] == []


def test_hulls_of_objects_over_batches_and_far_from_the_origin(spark):
    """Objects of many rows run over batches; a square's centroid is exact at row 10 ** 8."""
    far = 10**8
    cells = [(r, c, 1) for r in range(40) for c in range(r + 1)] + [(far + r, c, 2) for r in range(3) for c in range(3)] + [(7, c, 3) for c in range(50, 54)]
    labels = spark.createDataFrame(cells, "row long, col long, label long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = scoring.solidity(labels)
        got = {r["label"]: tuple(r)[1:] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[2] == (9, 9.0, 1.0, far + 1.0, 1.0) and got[3] == (4, 4.0, 1.0, 7.0, 51.5)
    n, area = 40 * 41 // 2, 40 * 41 / 2 + 19.5  # the stairs' hull adds half a cell a step
    assert got[1][:3] == (n, area, n / area)


def test_parts_of_a_pixel_table_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(series, "ROWS", 100, raising=False)
    obs = spark.range(2000).select((F.col("id") % 50).alias("pixel"), "id")
    assert series.dealt(obs, ["pixel"]).rdd.getNumPartitions() == 20


def test_feature_stack_moves_a_row_a_layer_in_parts_that_follow_the_rows(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(pipelines, "FEATURE_ROWS", 500, raising=False)
    dem = field(spark, 100, 50)
    image = dem.select("row", "col", F.array(*[F.col("value") + k for k in range(4)]).alias("b"))
    out = pipelines.feature_stack({"a": image, "b": image}, dem, 0.0, 0.0, 30.0)
    moved = sum(n for _, n in exchanges(out))
    assert moved < 12 * 5000
    assert out.rdd.getNumPartitions() >= 20000 * 0.9 // 500
