import json
import struct

import numpy as np
from pyspark.sql import functions as F

from cairnfield.operators import spatial
from cairnfield.sources import features, shapes

SQUARE = [[0, 0], [0, 10], [10, 10], [10, 0], [0, 0]]
HOLE = [[2, 2], [4, 2], [4, 4], [2, 4], [2, 2]]
FAR = [[20, 0], [20, 5], [25, 5], [25, 0], [20, 0]]


def multi(kind, parts):
    flat = np.array([p for part in parts for p in part], "<f8").reshape(-1, 2)
    box = [*flat.min(0), *flat.max(0)] if len(flat) else [0.0] * 4
    starts = np.cumsum([0, *[len(p) for p in parts]])[:-1].astype("<i4")
    return struct.pack("<i4d2i", kind, *box, len(parts), len(flat)) + starts.tobytes() + flat.tobytes()


RECORDS = [
    (multi(5, [SQUARE, HOLE]), "a", "1", False),
    (multi(15, [SQUARE, FAR, HOLE]), "ÄÖ", "22", False),
    (struct.pack("<i", 0), "none", "", False),
    (struct.pack("<i2d", 1, 3.5, -4.0), "p", "3", False),
    (multi(3, [[[0, 1], [2, 3]]]), "gone", "4", True),
    (multi(3, [[[0, 1], [2, 3]], [[5, 5], [6, 7], [8, 8]]]), "l", "5", False),
    (struct.pack("<i4di", 8, 1, 2, 5, 6, 2) + struct.pack("<4d", 1, 2, 5, 6), "m", "-6", False),
    (multi(5, [HOLE]), "only a hole", "7", False),
]


def write(folder, name, records):
    shp, shx, at = b"", b"", 100
    for k, (raw, *_) in enumerate(records):
        shp += struct.pack(">2i", k + 1, len(raw) // 2) + raw
        shx += struct.pack(">2i", at // 2, len(raw) // 2)
        at += 8 + len(raw)
    fields = [(b"NAME", b"C", 14), (b"ROW", b"N", 6)]
    described = b"".join(n.ljust(11, b"\0") + t + bytes(4) + bytes([size]) + bytes(15) for n, t, size in fields)
    dbf = b"\x03\x7c\x01\x01" + struct.pack("<IHH", len(records), 32 + len(described) + 1, 21) + bytes(20) + described + b"\r"
    dbf += b"".join((b"*" if gone else b" ") + n.encode().ljust(14) + v.encode().rjust(6) for _, n, v, gone in records) + b"\x1a"
    for end, body in (("shp", bytes(100) + shp), ("shx", bytes(100) + shx), ("dbf", dbf)):
        (folder / f"{name}.{end}").write_bytes(body)


def test_shapes_are_as_their_features(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shapes, "RECORDS", 3)
    write(tmp_path, "a", RECORDS)
    write(tmp_path, "none", [])
    (tmp_path / "alone.shp").write_bytes(bytes(300))
    write(tmp_path, "cut", RECORDS[:2])
    (tmp_path / "cut.shp").write_bytes((tmp_path / "cut.shp").read_bytes()[:150])
    got = {r.record: r for r in shapes.read_shapes(spark, str(tmp_path)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 5, 6, 7] and all(r.path.endswith("a.shp") for r in got.values())
    same = [("Polygon", [SQUARE, HOLE]), ("MultiPolygon", [[SQUARE, HOLE], [FAR]]), None, ("Point", [3.5, -4]), None]
    same += [("MultiLineString", [[[0, 1], [2, 3]], [[5, 5], [6, 7], [8, 8]]]), ("MultiPoint", [[1, 2], [5, 6]]), ("Polygon", [HOLE])]
    listed = [{"type": "Feature", "properties": {"record": str(k)}, "geometry": {"type": s[0], "coordinates": s[1]}} for k, s in enumerate(same) if s]
    texts = spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": listed}),)], "value string")
    want = {int(r.properties["record"]): r for r in features.features(texts).collect()}
    for k, w in want.items():
        g = got[k]
        assert (g.kind, json.loads(g.coordinates)) == (w.kind, json.loads(w.coordinates))
        assert (g.xmin, g.xmax, g.ymin, g.ymax) == (w.xmin, w.xmax, w.ymin, w.ymax)
    assert got[2].kind is None and got[2].xmin is None and got[2].properties == {"NAME": "none", "ROW": None}
    assert got[1].properties == {"NAME": "ÄÖ", "ROW": "22"} and got[6].properties["ROW"] == "-6"


def test_boxes_of_shapes_hold_points(spark, tmp_path):
    cells = [(multi(5, [[[x, 0], [x, 5], [x + 5, 5], [x + 5, 0], [x, 0]]]), f"c{x}", str(x), False) for x in range(0, 50, 5)]
    write(tmp_path, "grid", cells)
    boxes = shapes.read_shapes(spark, str(tmp_path)).select(F.col("properties")["NAME"].alias("name"), "xmin", "xmax", "ymin", "ymax")
    points = spark.createDataFrame([(1, 7.0, 2.0), (2, 49.9, 0.0), (3, 50.0, 1.0), (4, 5.0, 1.0)], "id long, x double, y double")
    assert {(r.id, r.name) for r in spatial.in_boxes(points, boxes, "x", "y", 4.0).select("id", "name").collect()} == {(1, "c5"), (2, "c45"), (4, "c5")}
