import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import series
from cairnfield.sources import netcdf

TIMES, ROWS, COLS = 4, 3, 5
HOURS = np.array([876600, 876606, 876612, 876618], ">i4")


def name(s):
    b = s.encode()
    return struct.pack(">I", len(b)) + b + bytes(-len(b) % 4)


def attribute(key, v, kind):
    raw = v.encode() if kind == 2 else np.array([v], netcdf.KINDS[kind]).tobytes()
    return name(key) + struct.pack(">II", kind, len(raw) if kind == 2 else 1) + raw + bytes(-len(raw) % 4)


def written(t2m, tp, version=1, records=True, coordinates=True):
    """A file as the classic format lays it out: t2m packed as short, tp as float."""
    dims = [("time", 0 if records else TIMES), ("latitude", ROWS), ("longitude", COLS)]
    fixed = {"latitude": (1,), "longitude": (2,)} if coordinates else {}
    packed = [attribute("scale_factor", 0.5, 6), attribute("add_offset", 250.0, 6), attribute("_FillValue", -9, 3)]
    kinds = {"latitude": 5, "longitude": 5, "time": 4, "t2m": 3, "tp": 5}
    attrs = {"time": [attribute("units", "hours since 1900-01-01 00:00:0.0", 2)], "t2m": packed, "tp": [attribute("missing_value", -1.0, 5)]}
    data = {"latitude": np.array([70, 69.5, 69], ">f4"), "longitude": np.arange(150, 150 + COLS, dtype=">f4"), "time": HOURS, "t2m": t2m.astype(">i2"), "tp": tp.astype(">f4")}
    shapes = {**fixed, "time": (0,), "t2m": (0, 1, 2), "tp": (0, 1, 2)}
    padded = lambda n: -(-n // 4) * 4
    size = {n: data[n][0].nbytes if s[0] == 0 and records else data[n].nbytes for n, s in shapes.items()}

    def head(begins):
        out = b"CDF" + bytes([version]) + struct.pack(">I", TIMES if records else 0)
        out += struct.pack(">II", 10, 3) + b"".join(name(d) + struct.pack(">I", n) for d, n in dims)
        out += struct.pack(">II", 12, 1) + attribute("title", "abc", 2) + struct.pack(">II", 11, len(shapes))
        for n, s in shapes.items():
            a = attrs.get(n, [])
            out += name(n) + struct.pack(">I", len(s)) + struct.pack(f">{len(s)}I", *s) + struct.pack(">II", 12 if a else 0, len(a)) + b"".join(a)
            out += struct.pack(">II", kinds[n], padded(size[n])) + struct.pack(">I" if version == 1 else ">Q", begins[n])
        return out

    place, begins = len(head(dict.fromkeys(shapes, 0))), {}
    for n in sorted(shapes, key=lambda n: shapes[n][0] == 0):
        begins[n], place = place, place + padded(size[n])
    body = b"".join(data[n].tobytes() + bytes(-size[n] % 4) for n in fixed)
    if records:
        body += b"".join(data[n][k : k + 1].tobytes() + bytes(-size[n] % 4) for k in range(TIMES) for n in ("time", "t2m", "tp"))
    else:
        body += b"".join(data[n].tobytes() + bytes(-size[n] % 4) for n in ("time", "t2m", "tp"))
    return head(begins) + body


@pytest.mark.parametrize(("version", "records"), [(1, True), (2, True), (1, False)])
def test_cubes(spark, tmp_path, monkeypatch, version, records):
    rng = np.random.default_rng(1)
    t2m, tp = rng.integers(0, 100, (TIMES, ROWS, COLS)), np.round(rng.random((TIMES, ROWS, COLS)), 3)
    t2m[1, 2, 3], tp[1, 2, 3], t2m[0, 0, 0] = -9, -1, -9
    (tmp_path / "a.nc").write_bytes(written(t2m, tp, version, records))
    (tmp_path / "broken.nc").write_bytes(written(t2m, tp)[:60])
    (tmp_path / "other.nc").write_bytes(b"no cube at all")
    (tmp_path / "bare.nc").write_bytes(written(t2m, tp, coordinates=False))
    monkeypatch.setattr(netcdf, "HEAD", 64)
    monkeypatch.setattr(netcdf, "SLAB_CELLS", 2 * ROWS * COLS)
    got = {(r.i, r.row, r.col): r for r in netcdf.cube(spark, str(tmp_path), ["t2m", "tp"]).collect()}
    assert len(got) == TIMES * ROWS * COLS - 1 and (1, 2, 3) not in got
    for (i, r, c), cell in got.items():
        assert cell.t2m == (None if t2m[i, r, c] == -9 else t2m[i, r, c] * 0.5 + 250) and cell.tp == pytest.approx(tp[i, r, c])
        assert (cell.lat, cell.lon) == (70 - r / 2, 150 + c)
    assert [str(got[i, 1, 1].time) for i in range(4)] == ["2000-01-02 00:00:00", "2000-01-02 06:00:00", "2000-01-02 12:00:00", "2000-01-02 18:00:00"]


def test_pairs_of_a_cube(spark, tmp_path):
    t2m, tp = np.full((TIMES, ROWS, COLS), 60), np.full((TIMES, ROWS, COLS), 0.25)
    t2m[1] = 64
    (tmp_path / "a.nc").write_bytes(written(t2m, tp))
    cells = netcdf.cube(spark, str(tmp_path), ["t2m", "tp"]).where("row = 1 and col = 2")
    got = {r.pair: (round(r.t2m, 6), r.tp) for r in series.pairs_aggregated(cells, "i", "t2m", "tp").collect()}
    assert got == {0: (round(281 - 273.15, 6), 150000.0), 1: (round(280 - 273.15, 6), 150000.0)}
    assert netcdf.cube(spark, str(tmp_path), ["sp"]).agg(F.count("*")).first()[0] == 0
