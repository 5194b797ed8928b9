import os

import numpy as np
from pyspark.sql import functions as F

from cairnfield.functions import scene_names as N
from cairnfield.sources import grids, manifest, sinks, text
from cairnfield.streaming.ingest import run_once, tile_events


def test_manifest(spark, tmp_path):
    for n in ("LT50820071985213_masked_S_32_8.tif", "LC08082007201507040101_masked_S_32_8.tif", "bad.tif", "x.txt"):
        (tmp_path / n).write_bytes(b"1")
    got = {r.basename: r for r in manifest.manifest(manifest.listed(spark, str(tmp_path))).collect()}
    a, b, c = got["LT50820071985213_masked_S_32_8.tif"], got["LC08082007201507040101_masked_S_32_8.tif"], got["bad.tif"]
    assert (str(a.date), a.sensor, a.process) == ("1985-08-01", "TM", True)
    assert b.naming_version is None or b.sensor == "OLI"
    assert not c.process and c.date is None and len(got) == 3
    assert manifest.report(manifest.manifest(manifest.listed(spark, str(tmp_path))), "read", "process").first().failed >= 1
    assert manifest.listed_paths(spark, [str(tmp_path / "bad.tif")]).count() == 1


def test_texts(spark, tmp_path):
    (tmp_path / "MTL.txt").write_text('  GROUP = A\n  SUN_ELEVATION = 41.5\n  SUN_ELEVATION_2 = 9\n  NAME = "x"\n')
    r = text.metadata(spark, str(tmp_path / "MTL.txt"), "SUN_ELEVATION").first()
    assert (r.text, r.number) == ("41.5", 41.5)
    assert text.metadata(spark, str(tmp_path / "MTL.txt"), "NAME").first().number is None
    xml = spark.createDataFrame([("<a><b><instrument>ETM</instrument></b><instrument>TM</instrument></a>",)], "x string")
    assert xml.select(text.instrument(F.col("x"))).first()[0] == "ETM"
    (tmp_path / "sites.csv").write_text(",name,data_dir,epsg\n0,Z1,N:\\a\\b,32656\n")
    r = text.sites(spark, str(tmp_path / "sites.csv"), "/base/").first()
    assert (r["name"], r.data_dir, r.epsg) == ("Z1", "/base/b", "32656")
    (tmp_path / "sun.csv").write_text("title\nDOY,d,DOY,d,DOY,d,DOY,d,DOY,d,DOY,d\n1,0.98,61,0.99,121,1.0,181,1.01,241,1.02,301,0.97\n")
    assert {r.doy: r.d for r in text.sun_distance(spark, str(tmp_path / "sun.csv")).collect()} == {1: 0.98, 61: 0.99, 121: 1.0, 181: 1.01, 241: 1.02, 301: 0.97}


def test_name_parts(spark):
    df = spark.createDataFrame([("trend_2000-2020_Z056-_-70_160.tif", 993264, '{"coordinates": [[[1.0, 9.0], [5.0, 9.0], [5.0, 2.0], [1.0, 2.0]]]}')], "n string, h int, g string")
    parts = df.select(*[v.alias(k) for k, v in N.tile_parts(F.col("n")).items()]).first()
    assert tuple(parts) == ("2000-2020", "Z056", "70", "160")
    assert tuple(df.select(*N.class_period(F.lit("2000-2020"))).first()) == (2000, 2020, 20)
    assert str(df.select(N.hours_since_1900(F.col("h"))).first()[0])[:10] == "2013-04-24"
    assert tuple(df.select(*N.ring_corners(F.col("g"))).first()) == (1.0, 9.0, 5.0, 2.0)
    assert tuple(df.select(*N.tile_key_parts(N.tile_key(F.lit(3), F.lit(7)))).first()) == (3, 7)
    assert df.select(N.box_wkt(*[F.lit(x) for x in (0, 1, 2, 3)])).first()[0] == "POLYGON ((0 1, 2 1, 2 3, 0 3, 0 1))"


def test_grid_source(spark, tmp_path):
    a = np.arange(2 * 5 * 7).reshape(2, 5, 7).astype("int16")
    np.save(tmp_path / "t.npy", a)
    spark.dataSource.register(grids.GridSource)
    df = spark.read.format("grid").option("path", str(tmp_path / "*.npy")).option("step", "3").option("factor", "1").load()
    assert df.rdd.getNumPartitions() == 6
    got = {(r["row"], r["col"]): r.b for r in df.collect()}
    assert len(got) == 35 and got[0, 0] == [None, 35.0] and got[4, 6] == [34.0, 69.0]


def test_sinks(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (1, 1, 0)], "label long, row long, col long")
    p = sinks.cell_polygons(labels).first()
    assert p.geometry == "MULTIPOLYGON (((0 0, 2 0, 2 1, 0 1, 0 0)), ((0 1, 1 1, 1 2, 0 2, 0 1)))"
    assert '"type":"Feature"' in sinks.as_features(sinks.cell_polygons(labels)).first().value
    path = str(tmp_path / "out")
    sinks.if_absent(labels, path)
    sinks.if_absent(labels.limit(0), path)
    assert spark.read.parquet(path).count() == 3
    assert sinks.with_provenance(labels, mode="full").first().provenance == {"mode": "full"}


def test_ingest_sees_each_file_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "done")
    folder.mkdir()

    def work(batch, number):
        batch.select("site", "lat").write.mode("overwrite").parquet(f"{out}/batch={number}")

    def put(*names):
        for n in names:
            (folder / n).write_bytes(b"x")
        run_once(tile_events(spark, str(folder)), work, str(tmp_path / "checkpoint")).awaitTermination()

    put("trend_2000-2020_Z1-_-70_160.tif", "trend_2000-2020_Z1_grid_1.tif")
    put("trend_2000-2020_Z2_71_160.tif")
    put()
    assert sorted((r.site, r.lat) for r in spark.read.parquet(out).collect()) == [("Z1", "70"), ("Z2", "71")]
    assert sum(f.startswith("batch=") for f in os.listdir(out)) == 2


def test_folders_and_readiness(spark, tmp_path):
    for folder, names in {"a": ["m.xml", "m.tif.aux.xml", "x_cfmask.tif", *[f"x_sr_band{k}.tif" for k in (1, 2, 3, 4, 5, 7)]], "b": ["m.xml", "n.xml", "x_pixel_qa.tif"], "c": ["x_band1.tif"]}.items():
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / n).write_bytes(b"1")
    files = manifest.listed(spark, str(tmp_path), "*", recursive=True)
    assert {r.folder: r.n_files for r in manifest.folders(files).collect()} == {"a": 9, "b": 3, "c": 1}
    got = {r.folder[-1]: (r.meta_ok, r.mask_kind, r.bands_ok, r.ready) for r in manifest.readiness(files).collect()}
    assert got == {"a": (True, "cfmask", True, True), "b": (False, "pixel_qa", False, False), "c": (False, None, False, False)}


def test_headers(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.zeros((3, 4, 5)))
    np.save(tmp_path / "b.npy", np.zeros((4, 5)))
    (tmp_path / "c.npy").write_bytes(b"no")
    got = {r.path[-5]: (r.bands, r.rows, r.cols) for r in grids.headers(spark, [str(tmp_path / f"{n}.npy") for n in "abcd"]).collect()}
    assert got == {"a": (3, 4, 5), "b": (1, 4, 5), "c": (None, None, None), "d": (None, None, None)}


def test_tiles_are_folders(spark, tmp_path):
    cells = spark.range(100).selectExpr("id div 10 as row", "id % 10 as col", "id as value")
    sinks.by_tile(cells, str(tmp_path / "t"), 4)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100 and back.where("tile_row = 2 and tile_col = 0").count() == 8
