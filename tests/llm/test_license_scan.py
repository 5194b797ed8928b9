from cairnfield.llm import license_scan as S
from cairnfield.llm._licenses import KNOWN
from tests.compare import duck_rows, spark_rows

KIND = "doc_id long, text string, license_id string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(3)


def scan(spark, rows):
    out = {}
    for r in S.scan_licenses(frame(spark, rows), S.known_licenses(spark)).collect():
        out.setdefault(r.doc_id, []).append((r.license_id, r.notices))
    return out


def test_changed_forms_of_known_texts_are_found(spark):
    mit = KNOWN["MIT"]
    rows = [
        (1, mit), (2, mit.upper()), (3, mit.replace("\n", " ").replace(",", " , ")), (4, "Copyright (c) 2024 Jo Doe\nAll rights reserved.\n\n" + mit),
        (5, "MIT Licence\n\n© 2019 Somebody\n" + mit.replace('"', "“").replace("-", " ")), (6, mit + " more"), (7, mit[:-30]), (8, "the " + mit),
    ]
    got = scan(spark, rows)
    assert [got[i][0][0] for i in range(1, 9)] == ["MIT", "MIT", "MIT", "MIT", "MIT+title", None, None, None]


def test_notices_are_found_in_single_lines(spark):
    text = "some prose\n  Released under the MIT Licence!\nmore\nlicensed under CC BY-NC 4.0\nlicensed under CC BY-NC 4.0"
    assert scan(spark, [(1, text), (2, "It was released under the MIT License.")]) == {1: [(None, "notice:CC-BY-NC-4.0,notice:MIT")], 2: [(None, "")]}


def test_odd_texts(spark):
    mit = KNOWN["MIT"]
    got = scan(spark, [(1, None), (2, ""), (3, " \n.,"), (4, "© 2020 Jo"), (5, "word " * 200_000 + "\n" + "Licensed under CC BY-NC 4.0."), (6, mit), (6, mit), (None, mit)])
    assert got == {1: [(None, "")], 2: [(None, "")], 3: [(None, "")], 4: [(None, "")], 5: [(None, "notice:CC-BY-NC-4.0")], 6: [("MIT", "")] * 2, None: [("MIT", "")]}
    assert scan(spark, []) == {}


def test_equal_texts_are_reported_by_the_smallest_id(spark):
    known = spark.createDataFrame([("b", "Some Text."), ("a", "some text"), ("c", None), ("d", " .")], "license_id string, text string")
    got = S.scan_licenses(frame(spark, [(1, "SOME TEXT"), (2, ".")]), known).orderBy("doc_id").collect()
    assert [(r.license_id, r.notices) for r in got] == [("a", "a"), (None, "")]


def test_query_equals_the_sql(spark, sf):
    assert spark_rows(S.op10_license_scan(spark, sf)) == duck_rows(S.oracle_sql(), sf)


def test_rows_without_an_id_keep_their_notices(spark):
    notice = "prose\nLicensed under CC BY-NC 4.0."
    got = scan(spark, [(None, notice), (None, "prose"), (1, notice), (2, notice), (2, "Released under the MIT License."), (2, "prose")])
    assert sorted(got[None]) == [(None, ""), (None, "notice:CC-BY-NC-4.0")] and got[1] == [(None, "notice:CC-BY-NC-4.0")]
    assert sorted(got[2], key=str) == [("notice:MIT", "notice:MIT"), (None, ""), (None, "notice:CC-BY-NC-4.0")]


def test_rows_without_an_id_equal_the_sql(spark, tmp_path):
    rows = [(None, "a\nLicensed under CC BY-NC 4.0."), (1, "Licensed under CC BY-NC 4.0.\nb"), (1, "c"), (None, None), (3, KNOWN["Zlib"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert spark_rows(S.op10_license_scan(spark, str(tmp_path))) == duck_rows(S.oracle_sql(), str(tmp_path))


def test_every_known_text_is_found_as_itself(spark):
    rows = list(enumerate(KNOWN.items()))
    got = scan(spark, [(i, "(C) 2020 Jo\n" + text.title().replace(". ", " .\n")) for i, (_, text) in rows])
    assert {i: got[i][0][0] for i, _ in rows} == {i: name for i, (name, _) in rows}


def test_columns_that_clash_and_known_texts_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Do as you like.\nBut be kind.")
    names = ["lines", "row", "notices", "canonical_sha256"]
    docs = spark.createDataFrame([(1, "DO AS YOU LIKE, but be kind!", *"abcd")], ["doc_id", "text", *names])
    got = S.scan_licenses(docs, S.licenses_in(spark, str(tmp_path))).collect()
    assert [(r.doc_id, r.license_id, r.notices) for r in got] == [(1, "Own-1.0", "Own-1.0")]
