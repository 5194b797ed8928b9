import json
import random

import pytest
from pyspark.sql import functions as F

from cairnfield.operators import cells, outlines
from cairnfield.sources import sinks

PICTURES = {
    "one": ["#"],
    "ring": ["####", "#..#", "#..#", "####"],
    "corner": ["#.", ".#"],
    "gaps that meet": ["#####", "#.###", "##.##", "#####"],
    "gap beside the rim": [".####", "#.###", "#####"],
    "in a ring": ["#######", "#.....#", "#.###.#", "#.#.#.#", "#.###.#", "#.....#", "#######"],
    "stairs": ["#....", "##...", ".##..", "..##.", "...##"],
}


def frame(spark, rows, value="1"):
    held = [(r, c, ord(x)) for r, line in enumerate(rows) for c, x in enumerate(line) if x != "."]
    return spark.createDataFrame(held, "row long, col long, label long").repartition(3), max(map(len, rows))


def parts_of(rows):
    """4-connected parts by flooding: {label: [cells of a part]}."""
    left = {(r, c): x for r, line in enumerate(rows) for c, x in enumerate(line) if x != "."}
    out = {}
    while left:
        place, x = left.popitem()
        part, todo = {place}, [place]
        while todo:
            r, c = todo.pop()
            for n in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                if left.get(n) == x:
                    del left[n]
                    part.add(n)
                    todo.append(n)
        out.setdefault(ord(x), []).append(part)
    return out


def filled(polygon):
    """Cells whose centre lies in a polygon, by crossings of its rings."""
    found = set()
    ends = [p for ring in polygon for p in ring]
    for r in range(int(-max(y for _, y in ends)), int(-min(y for _, y in ends))):
        for c in range(int(min(x for x, _ in ends)), int(max(x for x, _ in ends))):
            y, x = -r - 0.5, c + 0.5
            crossings = sum(1 for ring in polygon for (x0, y0), (x1, y1) in zip(ring, ring[1:]) if (y0 > y) != (y1 > y) and x0 > x)
            if crossings % 2:
                found.add((r, c))
    return found


def area(ring):
    return sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:])) / 2


def check(spark, rows):
    df, cols = frame(spark, rows)
    got = {r.label: json.loads(r.g) for r in outlines.outlines(df, cols).select("label", F.to_json("geometry").alias("g")).collect()}
    want = parts_of(rows)
    assert set(got) == set(want)
    for label, g in got.items():
        assert g["type"] == "MultiPolygon"
        assert sorted(sorted(filled(p)) for p in g["coordinates"]) == sorted(sorted(p) for p in want[label])
        for polygon in g["coordinates"]:
            assert sum(map(area, polygon)) == len(filled(polygon))
            for k, ring in enumerate(polygon):
                assert ring[0] == ring[-1] and len(set(map(tuple, ring))) == len(ring) - 1  # closed, and touches itself nowhere
                assert (area(ring) > 0) == (k == 0)
                assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(ring, ring[1:]))
                assert all((a[0] == b[0]) != (b[0] == c[0]) for a, b, c in zip(ring, ring[1:], ring[2:]))  # corners alone


@pytest.mark.parametrize("name", PICTURES)
def test_pictures(spark, name):
    check(spark, PICTURES[name])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_labels_that_touch(spark, seed):
    rng = random.Random(seed)
    check(spark, ["".join(rng.choice("..aaab") for _ in range(23)) for _ in range(17)])


def test_one_long_ring(spark):
    rows = ["#" * 41 if r % 4 == 0 else ("#" + "." * 40 if r % 4 == 1 else "#" * 41 if r % 4 == 2 else "." * 40 + "#") for r in range(41)]
    check(spark, rows)


def test_no_cells_nulls_and_places(spark):
    df = spark.createDataFrame([(None, 1, 1), (1, None, 1), (1, 1, None), (2, 3, 5), (2, 3, 5)], "row long, col long, label long")
    got = outlines.outlines(df, 9, x=100.0, y=50.0, size=10.0).collect()
    assert [(r.label, r.geometry.coordinates) for r in got] == [(5, [[[[130.0, 30.0], [130.0, 20.0], [140.0, 20.0], [140.0, 30.0], [130.0, 30.0]]]])]
    assert outlines.outlines(df.where("row > 9"), 9).collect() == []
    assert [r.a for r in outlines.outlines(df, 9).select(outlines.signed_area(F.col("geometry")).alias("a")).collect()] == [1.0]


def test_outlines_as_features(spark):
    df, cols = frame(spark, PICTURES["ring"])
    line = json.loads(sinks.as_features(outlines.outlines(df, cols)).first().value)
    assert line["geometry"]["type"] == "MultiPolygon" and len(line["geometry"]["coordinates"][0]) == 2 and line["properties"] == {"label": 35}


def test_components_by_value(spark):
    df, cols = frame(spark, ["aabb", "abba", "aaaa"])
    got = {(r["row"], r["col"]): (r.by, r.label) for r in cells.components(df, cols, by="label").collect()}
    assert {v for v in got.values()} == {(97, 0), (98, 2)} and len(got) == 12
