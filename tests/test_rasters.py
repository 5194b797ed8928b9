import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnfield.operators import cells
from cairnfield.sources import features, rasters, sinks, tiff


def packed_lzw(raw):
    """LZW as the format's description has it: codes of 9 bits and more, the highest bit first, one code early."""
    table, width, word, bits = {bytes([k]): k for k in range(256)}, 9, b"", [format(256, "09b")]
    for byte in raw:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        bits.append(format(table[word], f"0{width}b"))
        table[longer] = len(table) + 2
        word = bytes([byte])
        if len(table) + 2 == 4094:
            bits.append(format(256, f"0{width}b"))
            table, width = {bytes([k]): k for k in range(256)}, 9
        elif len(table) + 2 > (1 << width) - 1:
            width += 1
    if word:
        bits.append(format(table[word], f"0{width}b"))
        if len(table) + 3 > (1 << width) - 1 and width < 12:
            width += 1
    bits.append(format(257, f"0{width}b"))
    text = "".join(bits)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


def write_tiff(path, grid, order="<", tile=None, planar=False, deflate=False, predictor=False, nodata=None, geo=True, lzw=False):
    """A baseline file of grid (band, row, col), written plainly."""
    bands, rows, cols = grid.shape
    kind = grid.dtype.newbyteorder(order)
    high, wide = tile or (3, cols)
    blocks = []
    for part in grid[:, None] if planar else [grid]:
        for r in range(0, rows, high):
            for c in range(0, cols, wide):
                block = part[:, r : r + high, c : c + wide].transpose(1, 2, 0)
                if tile:
                    block = np.pad(block, ((0, high - block.shape[0]), (0, wide - block.shape[1]), (0, 0)))
                if predictor == 3:
                    planes = np.ascontiguousarray(block).astype(block.dtype.newbyteorder(">"))[..., None].view(np.uint8)
                    planes = planes.transpose(0, 3, 1, 2).reshape(len(block), -1, block.shape[2])
                    block = np.diff(planes, axis=1, prepend=np.zeros_like(planes[:, :1]))
                    raw = np.ascontiguousarray(block).tobytes()
                    blocks.append(zlib.compress(raw) if deflate else packed_lzw(raw) if lzw else raw)
                    continue
                if predictor:
                    block = np.diff(block, axis=1, prepend=np.zeros_like(block[:, :1]))
                raw = np.ascontiguousarray(block).astype(kind).tobytes()
                blocks.append(zlib.compress(raw) if deflate else packed_lzw(raw) if lzw else raw)
    at, starts = 8, []
    for b in blocks:
        starts.append(at)
        at += len(b)
    code = {"u": 1, "i": 2, "f": 3}[grid.dtype.kind]
    entries = [(256, "H", [cols]), (257, "H", [rows]), (258, "H", [8 * grid.dtype.itemsize] * bands), (259, "H", [8 if deflate else 5 if lzw else 1]), (277, "H", [bands]), (284, "H", [2 if planar else 1]), (317, "H", [int(predictor) + 1 if predictor in (False, True) else predictor])]
    sizes = [len(b) for b in blocks]
    entries += [(322, "H", [wide]), (323, "H", [high]), (324, "I", starts), (325, "I", sizes)] if tile else [(273, "I", starts), (278, "H", [high]), (279, "I", sizes)]
    entries += [(339, "H", [code] * bands)]
    if geo:
        entries += [(33550, "d", [30.0, 30.0, 0.0]), (33922, "d", [0.0, 0.0, 0.0, 500000.0, 7000000.0, 0.0]), (34735, "H", [1, 1, 0, 1, 3072, 0, 1, 32608])]
    if nodata is not None:
        entries.append((42113, "s", f"{nodata}\0".encode()))
    heads, extra, base = [], b"", at + 2 + 12 * len(entries) + 4
    for tag, code, values in sorted(entries, key=lambda e: e[0]):
        raw = values if code == "s" else struct.pack(f"{order}{len(values)}{code}", *values)
        number = {"H": 3, "I": 4, "d": 12, "s": 2}[code]
        if len(raw) <= 4:
            field = raw.ljust(4, b"\0")
        else:
            field = struct.pack(f"{order}I", base + len(extra))
            extra += raw
        heads.append(struct.pack(f"{order}HHI", tag, number, len(values)) + field)
    with open(path, "wb") as f:
        f.write((b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, at) + b"".join(blocks))
        f.write(struct.pack(f"{order}H", len(heads)) + b"".join(heads) + b"\0\0\0\0" + extra)


CASES = [
    {}, {"order": ">"}, {"tile": (4, 4)}, {"planar": True}, {"tile": (4, 4), "planar": True, "deflate": True}, {"deflate": True, "predictor": True}, {"deflate": True, "predictor": True, "order": ">"},
    {"lzw": True}, {"lzw": True, "predictor": True, "tile": (4, 4)}, {"lzw": True, "planar": True, "order": ">"},
]


@pytest.mark.parametrize("kind", ["uint8", "int16", "uint16", "float32"])
@pytest.mark.parametrize("case", CASES)
def test_decoded_values_equal_the_written(tmp_path, kind, case):
    grid = np.random.default_rng(1).integers(0, 200, (3, 7, 10)).astype(kind)
    write_tiff(tmp_path / "a.tif", grid, **case)
    r = tiff.decoded((tmp_path / "a.tif").read_bytes())
    assert np.array_equal(r.values, grid) and (r.x, r.y, r.cell_width, r.epsg) == (500000.0, 7000000.0, 30.0, 32608)


def test_cells_and_headers_of_a_folder(spark, tmp_path):
    grid = np.arange(2 * 5 * 6).reshape(2, 5, 6).astype("int16")
    write_tiff(tmp_path / "a.tif", grid, nodata=0)
    write_tiff(tmp_path / "b.tif", grid[:1].astype("float32") + np.where(grid[:1] == 7, np.nan, 0).astype("float32"), geo=False)
    (tmp_path / "c.tif").write_bytes(b"no raster")
    (tmp_path / "d.tif").write_bytes(b"II*\0")
    heads = {r.path[-5]: tuple(r)[1:] for r in tiff.headers(spark, str(tmp_path)).collect()}
    assert heads["a"] == (2, 5, 6, 500000.0, 7000000.0, 30.0, 30.0, 32608, 0.0) and heads["b"][:3] == (1, 5, 6)
    assert heads["c"] == heads["d"] == (None,) * 9
    got = {(r.path[-5], r["row"], r["col"]): (r.x, r.y, r.b) for r in tiff.cells(spark, str(tmp_path), 10.0).collect()}
    assert got["a", 0, 0] == (500015.0, 6999985.0, [None, 3.0]) and got["a", 4, 5] == (500165.0, 6999865.0, [2.9, 5.9])
    assert len([k for k in got if k[0] == "a"]) == 30 and ("b", 1, 1) not in got and len([k for k in got if k[0] == "b"]) == 29


def test_features_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, None), (2, -3.0, "x")], "id int, x double, name string")
    shaped = df.withColumn("geometry", F.when(F.col("id") > 0, features.box(F.col("x"), F.lit(1.0), F.col("x") + 2, F.lit(4.0))))
    lines = [json.loads(r.value) for r in sinks.as_features(shaped).collect()]
    assert lines[0] == {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[2.5, 1.0], [4.5, 1.0], [4.5, 4.0], [2.5, 4.0], [2.5, 1.0]]]}, "properties": {"id": 1, "x": 2.5, "name": None}}
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [*lines, {"type": "Feature", "geometry": None, "properties": {"id": 3}}, {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1e1, -2, 7]}, "properties": {}}]}))
    got = features.read_features(spark, str(tmp_path / "f.geojson")).collect()
    assert [(r.kind, r.xmin, r.xmax, r.ymin, r.ymax) for r in got] == [("Polygon", 2.5, 4.5, 1.0, 4.0), ("Polygon", -3.0, -1.0, 1.0, 4.0), (None,) * 5, ("Point", 10.0, 10.0, -2.0, -2.0)]
    assert got[1].properties == {"id": "2", "x": "-3.0", "name": "x"} and got[2].properties == {"id": "3"}


def test_objects_are_features_with_a_geometry(spark):
    labels = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 1, 0)], "label long, row long, col long")
    shaped = sinks.cell_rings(labels).select("label", features.polygons(F.col("rings")).alias("geometry"))
    got = json.loads(sinks.as_features(shaped).first().value)
    assert got["geometry"] == {"type": "MultiPolygon", "coordinates": [[[[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]], [[[0, 1], [1, 1], [1, 2], [0, 2], [0, 1]]]]}
    text = json.loads(sinks.as_features(sinks.cell_polygons(labels)).first().value)
    assert text["geometry"] is None and text["properties"]["wkt"].startswith("MULTIPOLYGON")


def test_layers_have_types_and_nodata(spark, tmp_path):
    df = spark.createDataFrame([(0, 0, 1.0, 0.5), (0, 1, None, None), (300, 2, 21.0, 0.75)], "row long, col long, class double, confidence double")
    sinks.write_layers(df, str(tmp_path / "l"), {"class": ("tinyint", 0), "confidence": ("float", -1.0)}, mode_of="full")
    back = spark.read.parquet(str(tmp_path / "l"))
    assert dict(back.dtypes)["class"] == "tinyint" and dict(back.dtypes)["confidence"] == "float"
    assert sorted((r["row"], r["class"], r.confidence, r.tile_row) for r in back.collect()) == [(0, 0, -1.0, 0), (0, 1, 0.5, 0), (300, 21, 0.75, 1)]
    assert back.first().provenance["nodata_class"] == "0"


def test_components_of_a_long_chain_and_a_hub(spark):
    from cairnfield.operators.components import least_labels

    edges = [(i, i + 1) for i in range(3000)] + [(5000, 5000 + k) for k in range(1, 4000)] + [(7, 7), (9500, None)]
    got = {r.id: r.label for r in least_labels(spark.createDataFrame(edges, "u long, v long").repartition(6)).collect()}
    assert got == {**dict.fromkeys(range(3001), 0), **dict.fromkeys(range(5000, 9000), 5000)}
    assert least_labels(spark.createDataFrame([], "u long, v long")).count() == 0


def test_gaussian_weights_reach_the_edges(spark):
    grid = np.random.default_rng(3).random((6, 5))
    df = spark.createDataFrame([(r, c, float(grid[r, c])) for r in range(6) for c in range(5)], "row long, col long, value double")
    w = np.array(cells.gaussian_weights(0.8))
    half = len(w) // 2

    def blur(a):
        return np.array([sum(w[k] * a[i + k - half] for k in range(len(w)) if 0 <= i + k - half < len(a)) / sum(w[k] for k in range(len(w)) if 0 <= i + k - half < len(a)) for i in range(len(a))])

    want = np.apply_along_axis(blur, 1, np.apply_along_axis(blur, 0, grid))
    got = {(r["row"], r["col"]): r.value for r in cells.gaussian(df, 0.8).collect()}
    assert all(got[r, c] == pytest.approx(want[r, c]) for r in range(6) for c in range(5))


def test_files_in_order_of_what_is_done(spark):
    from cairnfield.sources import manifest

    files = spark.createDataFrame([("b", True), ("a", False), ("c", None), ("d", True)], "filepath string, done boolean")
    got = {o: [r.filepath for r in manifest.in_order(files, o).collect()] for o in ("auto", "archive", "process", "other")}
    assert got == {"auto": list("abcd"), "archive": list("bdac"), "process": list("acbd"), "other": list("abcd")}


def test_feature_stack_has_the_places_of_its_cells(spark):
    from cairnfield.functions import projection
    from cairnfield.plans import pipelines

    image = spark.createDataFrame([(0, 0, [1.0, 2.0, 3.0, 4.0])], "row long, col long, b array<double>")
    dem = spark.createDataFrame([(r, c, 10.0 * c) for r in range(3) for c in range(3)], "row long, col long, value double")
    got = {(r["row"], r["col"]): r for r in pipelines.feature_stack({"tcb": image}, dem, 500000.0, 7000000.0, 30.0, 8).collect()}
    assert len(got) == 9 and (got[0, 0].tcb_ciu, got[0, 0].dem, got[0, 0].slope, got[1, 1].tcb_slp) == (4.0, 0.0, None, None)
    assert got[1, 1].slope == pytest.approx(np.degrees(np.arctan(1 / 3)))
    x, y = projection.to_utm(F.lit(got[2, 1].lon), F.lit(got[2, 1].lat), 8)
    assert tuple(spark.range(1).select(x, y).first()) == pytest.approx((500045.0, 6999925.0), abs=1e-3)


@pytest.mark.parametrize("case", [{}, {"deflate": True}, {"lzw": True, "tile": (4, 4)}, {"order": ">", "planar": True}])
@pytest.mark.parametrize("kind", ["float32", "float64"])
def test_differences_of_float_bytes(tmp_path, kind, case):
    grid = np.random.default_rng(2).normal(size=(3, 7, 10)).astype(kind)
    write_tiff(tmp_path / "a.tif", grid, predictor=3, **case)
    assert np.array_equal(tiff.decoded((tmp_path / "a.tif").read_bytes()).values, grid)


@pytest.mark.parametrize("n", [0, 1, 5, 300, 20_000, 200_000])
def test_codes_of_all_widths_and_new_starts(n):
    rng = np.random.default_rng(n)
    for high in (2, 256):
        raw = rng.integers(0, high, n).astype(np.uint8).tobytes()
        assert tiff.unpacked_lzw(packed_lzw(raw)) == raw


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("kind", ["uint8", "int16", "float32", "float64"])
@pytest.mark.parametrize("shape", [(1, 1, 1), (4, 70, 65), (2, 64, 128)])
def test_encoded_files_come_back(big, kind, shape):
    grid = np.random.default_rng(3).integers(0, 200, shape).astype(kind)
    r = tiff.decoded(rasters.encoded(grid, rasters.Georeference(500000.0, 7000000.0, 30.0, 32608), -1.0, big=big))
    assert np.array_equal(r.values, grid) and r.values.dtype == np.dtype(kind)
    assert (r.x, r.y, r.cell_width, r.cell_height, r.epsg, r.nodata) == (500000.0, 7000000.0, 30.0, 30.0, 32608, -1.0)
    assert tiff.decoded(rasters.encoded(grid, rasters.Georeference(epsg=4326), big=big), values=False).epsg == 4326


def raster_rows(spark, n=600):
    rng = np.random.default_rng(5)
    places = rng.choice(50 * 40, n, replace=False)
    return [(int(p // 40), int(p % 40), float(rng.integers(1, 100)), None if p % 7 == 0 else float(p) / 4) for p in places]


def test_layers_come_back_from_files_of_tiles(spark, tmp_path):
    rows = raster_rows(spark)
    df = spark.createDataFrame(rows, "row int, col int, a double, b double").repartition(5)
    place = rasters.Georeference(300.0, 900.0, 10.0, 32608)
    rasters.write_rasters(df, str(tmp_path / "out"), ["a", "b"], place, nodata=-1.0, step=16)
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == sorted({f"tile_{r // 16}_{c // 16}.tif" for r, c, *_ in rows})  # and no staging folder
    want = sorted((305.0 + 10 * c, 895.0 - 10 * r, [a, None if b is None else np.float32(b)]) for r, c, a, b in rows)
    for found in (tiff.cells(spark, str(tmp_path / "out")), tiff.windowed(spark, str(tmp_path / "out"))):
        assert sorted((r.x, r.y, r.b) for r in found.collect()) == want
    rasters.write_rasters(df.where("row < 16"), "file://" + str(tmp_path / "out"), ["a"], place, kind="int16", step=16, mode="overwrite")
    assert all(p.name.startswith("tile_0_") for p in (tmp_path / "out").iterdir())
    assert {(r.bands, r.epsg, r.nodata) for r in tiff.headers(spark, str(tmp_path / "out")).collect()} == {(1, 32608, None)}


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    df = spark.createDataFrame(raster_rows(spark), "row int, col int, a double, b double").repartition(5)
    bad = df.withColumn("a", F.when(F.col("row") == 49, F.raise_error(F.lit("no value")).cast("double")).otherwise(F.col("a")))
    with pytest.raises(Exception, match="no value"):
        rasters.write_rasters(bad, str(tmp_path / "out"), ["a"], rasters.Georeference(), step=16)
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())
    rasters.write_rasters(df.where("row = 3"), str(tmp_path / "out"), ["a"], rasters.Georeference(), step=16)
    before = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    spark.dataSource.register(rasters.RasterSink)
    loose = df.selectExpr("0L as tile_row", "0L as tile_col", "cast(row % 16 as long) as row", "cast(col % 16 as long) as col", "a as value").repartition(5)
    with pytest.raises(Exception, match="more than one task"):
        loose.write.format("raster").mode("append").option("path", str(tmp_path / "out")).save()
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == before


def test_a_window_reads_its_tiles_alone_and_one_file_is_many_tasks(spark, tmp_path, monkeypatch):
    grid = np.random.default_rng(6).integers(1, 1000, (2, 300, 400)).astype("uint16")
    for name, big in (("a", False), ("b", True)):
        (tmp_path / f"{name}.tif").write_bytes(rasters.encoded(grid, rasters.Georeference(0.0, 0.0, 1.0), side=50, big=big))
    (tmp_path / "c.tif").write_bytes(b"II*\0 no raster at all")
    window = (70, 120, 355, 380)
    found = tiff.windowed(spark, str(tmp_path), window)
    got = {(r.path[-5], r["row"], r["col"]): (r.x, r.y, r.b) for r in found.collect()}
    assert got == {(n, r, c): (c + 0.5, -r - 0.5, grid[:, r, c].astype(float).tolist()) for n in "ab" for r in range(70, 120) for c in range(355, 380)}
    meeting = tiff.places(spark, str(tmp_path), window).collect()
    assert sorted((r.path[-5], r["row"], r["col"]) for r in meeting) == [(n, r, 350) for n in "ab" for r in (50, 100)]
    # bytes that a window takes: the directory's and those of its tiles
    seen = []
    content = (tmp_path / "a.tif").read_bytes()
    read = lambda at, size: seen.append(size) or content[at : at + size]
    form = tiff.layout(*tiff.tags(read))
    for r in meeting:
        if r.path.endswith("a.tif"):
            tiff.block(form, read, r["row"], r["col"], r.starts, r.sizes)
    tiles = sum(sum(r.sizes) for r in meeting if r.path.endswith("a.tif"))
    assert tiles <= sum(seen) < tiles + 2000 < len(content) / 4
    monkeypatch.setattr(tiff, "TASK_CELLS", 20_000)
    parts = tiff.windowed(spark, str(tmp_path / "a.tif")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 3 and sum(r["count"] for r in parts) == 300 * 400


def test_blocks_that_are_broken_or_absent(spark, tmp_path):
    grid = np.ones((1, 8, 8), "uint8")
    whole = rasters.encoded(grid, rasters.Georeference(), nodata=0.0, side=4)
    form = tiff.layout(*tiff.tags(lambda at, size: whole[at : at + size]))
    assert not tiff.block(form, lambda at, size: b"", 0, 0, [0], [0]).any()  # a tile that was never written is nodata
    (tmp_path / "a.tif").write_bytes(whole[:-4] + b"junk")
    assert tiff.cells(spark, str(tmp_path)).count() == 0  # a file is whole or left out
    assert tiff.windowed(spark, str(tmp_path)).count() == 48  # a block is
