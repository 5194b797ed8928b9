import hashlib
import re
import time

from cairnfield.llm import personal_data as P
from tests.compare import duck_rows, spark_rows


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_by_hand(text):
    """The contract's base spans, by Python's own patterns."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


CARD = "4111 1111 1111 1111"
TEXTS = [
    None, "", " ", "no data at all", "é𝒳 a.b@c.de", "a@b.c._x@d.e.f, x@y", "a@b.c@d.e", "@", "a@", "%@-.-", "a+b@c-d.e-f.-",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255 0001.2.3.00255 1.2.3 1.2.3.4444", "9" * 60 + ".1.1.1", "0" * 90 + "1.1.1.1",
    CARD, CARD + " " + CARD, "4111-1111-1111-1111", "4111111111111112", "4111111111111111", "41 11 11 11 11 11 11 11", "12 " + CARD, "order 4465758382889437 4465758382889437",
    "card 4465758382889437 4465758382889437 x", "4111  1111 1111 1111", "0000000000000", "٤111111111111111",
    "+1 (743) 555-3824", "+1", "+1 2", "+12345678", "+123456789", "+1234567890123456", "call +1 555.555.5555 or (555) 555-5555", "fax: 555-555-5555", "555-555-5555", "phone 555 555 5555-6", "++1 (((((((9 12 13 14 15",
    "IBAN DE89370400440532013000", "IBAN DE89 3704 0044 0532 0130 00 IS", "DE89370400440532013001", "account GB82 WEST 1234 5698 7654 32 THAT", "xDE89370400440532013000", "ES91 2100 0418 4502 0005 1332 THEN", "ZZ89370400440532013000", "BE68539007547034 BE68 5390 0754 7034",
    "ssn 123-45-6789", "123-45-6789", "ssn 666-45-6789", "social 123-00-6789", "ssn 123-45-67890", "a@b.co " * 50, "é" * 39 + "tel 555-555-5555", "tel" + "é" * 40 + "555-555-5555",
]


def rows_of(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, kind string, start string").repartition(3)
    out = P.personal_data(df)
    assert out.columns == ["doc_id", "text", "kind", "start", "spans"]
    return [[tuple(s) for s in r.spans] for r in out.orderBy("doc_id").collect()]


def test_base_spans_equal_plain_patterns(spark):
    got = rows_of(spark, TEXTS)
    order = [k.name for k in P.KINDS]
    for text, spans in zip(TEXTS, got, strict=True):
        assert [s[:3] for s in spans if s[4]] == base_by_hand(text), text
        assert spans == sorted(spans, key=lambda s: (order.index(s[0]), s[1])), text


def test_added_spans_and_scores(spark):
    def added(text):
        return [(s[0], (text or "")[s[1] : s[2]], s[3]) for s in found[TEXTS.index(text)] if not s[4]]

    found = rows_of(spark, TEXTS)
    assert added(CARD + " " + CARD) == [("card", CARD, 60)] * 2
    assert added("12 " + CARD) == [("card", CARD, 60)]
    assert added("order 4465758382889437 4465758382889437") == []  # a word against it
    assert added("card 4465758382889437 4465758382889437 x") == [("card", "4465758382889437", 80)] * 2
    assert added("fax: 555-555-5555") == [("phone", "555-555-5555", 60)] and added("555-555-5555") == []
    assert added("phone 555 555 5555-6") == []
    assert added("IBAN DE89370400440532013000") == [("iban", "DE89370400440532013000", 100)]
    assert added("IBAN DE89 3704 0044 0532 0130 00 IS") == [("iban", "DE89 3704 0044 0532 0130 00", 100)]
    assert added("account GB82 WEST 1234 5698 7654 32 THAT") == [("iban", "GB82 WEST 1234 5698 7654 32", 100)]
    assert added("ES91 2100 0418 4502 0005 1332 THEN") == [("iban", "ES91 2100 0418 4502 0005 1332", 80)]
    assert [x[1] for x in added("BE68539007547034 BE68 5390 0754 7034")] == ["BE68539007547034", "BE68 5390 0754 7034"]
    for none in ("DE89370400440532013001", "xDE89370400440532013000", "ZZ89370400440532013000", "123-45-6789", "ssn 666-45-6789", "social 123-00-6789", "ssn 123-45-67890"):
        assert added(none) == []
    assert added("ssn 123-45-6789") == [("ssn", "123-45-6789", 60)]
    assert added("tel" + "é" * 40 + "555-555-5555") == [] and len(added("é" * 39 + "tel 555-555-5555")) == 1


def test_long_runs_take_linear_time_and_no_stack(spark):
    n = 300_000
    texts = ["a" * n, "1" * n, "1 " * n, "1." * n, "a." * n + "@", "a@b" + ".c" * n, "+1" + " " * n, "+1 " * n, "AB12" * n, "x@y.z " * 60_000, "1.1.1.1 " * 60_000, "(" * n]
    began = time.perf_counter()
    got = rows_of(spark, texts)
    assert time.perf_counter() - began < 90
    assert [len(s) for s in got[:9]] == [0, 0, 0, n // 4, 0, 1, 0, 0, 0]
    assert [s[:3] for s in got[9]] == [("email", 6 * k, 6 * k + 5) for k in range(60_000)]
    assert [s[:3] for s in got[10]] == [("ip", 8 * k, 8 * k + 7) for k in range(60_000)]


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert P.personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (1, None)], "doc_id long, text string, spans string".rsplit(",", 1)[0])
    assert sorted(len(r.spans) for r in P.personal_data(df.withColumn("spans", df.text)).collect()) == [0, 1, 1, 1]


def test_query_equals_the_sql_and_the_digest_of_its_base(spark, sf):
    got = spark_rows(P.op13_pii(spark, sf))
    assert got == duck_rows(P.oracle_sql(), sf)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in P.op13_pii(spark, sf).collect():
        base = base_by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in ("email", "ip", "card", "phone")]


def test_no_python_in_the_plan(spark, sf):
    plan = P.op13_pii(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
