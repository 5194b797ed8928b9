"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score.

DataFrame functions only. For each kind a pattern cuts the text into its matches and the gaps between them; places are the
running sums of their lengths in code points, made in blocks, so that a text with many matches stays cheap. Validators then confirm a match (part sizes of addresses, Luhn for cards, digits of phones, length by country and
mod-97 for bank accounts, blocks that are never given out for social security numbers). The score in hundredths is the kind's prior, raised by words of
the kind within CONTEXT code points between the match and its neighbours, lowered by words that speak against it.

Base spans are the confirmed matches of email, ip, card and phone; they stay whatever their score. The method adds those of
THRESHOLD or more: cards inside digit runs that are too long for one card or fail its checksum, phone numbers without a
country code, bank accounts and social security numbers. Spans of different kinds may overlap.

Patterns of the main path are possessive and start where a run of their characters starts, so they take linear time and no
stack on long runs; they match what the plain patterns of the SQL match.

Defined cases: a null text is an empty one; an empty text has no spans; a null doc_id and repeated rows are answered as any
other, row by row; other columns pass through, but for those that have the name of an output column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import LOWER, UPPER, ascii_lower, table

#: Code points before and after a match that count as its context, at most.
BEFORE, AFTER = 40, 20
#: Hundredths: what a word of the kind adds, what a word against it takes off, and the least score of an added span.
RAISE, TAKE_OFF, THRESHOLD = 20, 30, 50
AGAINST = "order|invoice|version|isbn|serial|part|model|build|sku|tracking|reference"


@dataclass(frozen=True)
class Kind:
    """A kind's pattern in Java, the plain pattern of the same matches, its prior and the words that speak for it."""

    name: str
    java: str
    plain: str
    prior: int
    words: str


CARD_PART = "[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]+"
LOCAL_PHONE = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
ACCOUNT = "[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
EMAIL = Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 90, "email|mail|contact|write|address")
IP = Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 60, "ip|host|server|address|login|client")
CARD = Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9]([ -]?[0-9])+", 60, "card|credit|debit|visa|mastercard|amex|payment|cvv")
PHONE = Kind("phone", rf"\+[0-9][ ().0-9-]+[0-9]|{LOCAL_PHONE}", rf"\+[0-9][ ().0-9-]+[0-9]|{LOCAL_PHONE}", 40, "phone|tel|telephone|call|mobile|cell|fax|whatsapp")
IBAN = Kind("iban", ACCOUNT, ACCOUNT, 80, "iban|account|bank|transfer|konto")
SSN = Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 40, "ssn|social|security|taxpayer")
KINDS = (EMAIL, IP, CARD, PHONE, IBAN, SSN)

#: Lengths of bank account numbers by country.
ACCOUNT_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
SPAN = "array<struct<kind: string, start: bigint, end: bigint, score: int, base: boolean>>"
MATCH = "array<struct<start: bigint, end: bigint, value: string, before: string, after: string>>"
IP_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value made once: a lambda's variable is not evaluated again where it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def prefix_sums(numbers: Column) -> Column:
    """The sum of each number and all before it, by a fold that copies its array: for short arrays."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("sums"))
    step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["sums"], F.array(acc["sum"] + x)).alias("sums"))
    return F.aggregate(numbers, start, step, lambda acc: acc["sums"])


def running_sums(numbers: Column) -> Column:
    """The sum of each number and all before it: sums within blocks as long as their number, plus those of the blocks before."""

    def in_blocks(a: Column, size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(a), size)
        inner = F.transform(starts, lambda at: prefix_sums(F.slice(a, at, size)))
        moved = lambda p, before: F.transform(p, lambda x: x + before)
        joined = lambda p, ends: F.flatten(F.transform(p, lambda x, i: moved(x, F.when(i > 0, F.get(ends, i - 1)).otherwise(0))))
        return let(inner, lambda p: let(prefix_sums(F.transform(p, lambda x: F.element_at(x, -1))), lambda ends: joined(p, ends)))

    return let(numbers, lambda a: let(F.ceil(F.sqrt(F.size(a))).cast("int"), lambda size: in_blocks(a, size)))


def located(text: Column, pattern: str, least: int = 1) -> Column:
    """Structs (start, end, value, before, after) of the pattern's matches, leftmost first; before and after are whole gaps.

    Empty where no match is `least` characters long: then only they are looked for, and no gaps are made.
    """

    def place(found: Column, gaps: Column) -> Column:
        widths = F.transform(found, lambda m, i: (F.length(m) + F.length(F.get(gaps, i))).cast("long"))
        at = lambda m, i, ends: [(F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value")]
        each = lambda ends: F.transform(found, lambda m, i: F.struct(*at(m, i, ends), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after")))
        return let(running_sums(widths), each)

    def where(found: Column) -> Column:
        held = F.exists(found, lambda m: F.length(m) >= least)
        return F.when(held, let(F.split(text, F.lit(pattern), -1), lambda gaps: place(found, gaps)))

    return F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), 0), where), F.array().cast(MATCH))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits' Luhn sum ends in 0: from the right, every second digit counts double, less 9 beyond 9."""
    def total(back: Column) -> Column:
        double = F.translate(back, "0123456789", "0246813579")
        digit = lambda i: F.substr(F.when(i % 2 == 0, double).otherwise(back), i, F.lit(1)).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda acc, i: acc + digit(i))

    return let(F.reverse(number), total) % 10 == 0


def is_card(number: Column) -> Column:
    return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)


def mod97(compact: Column) -> Column:
    """The remainder by 97 of an account number with its first four characters last and letters as 10, 11, .."""
    turned = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))
    step = lambda acc, c: F.when(c >= "A", acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))


def score(kind: Kind, m: Column) -> Column:
    """The prior of a match, raised and lowered by the words around it."""
    around = ascii_lower(F.concat(F.right(m["before"], F.lit(BEFORE)), F.lit(" "), F.left(m["after"], F.lit(AFTER))))
    word = lambda words: F.concat(F.lit("(?:^|[^a-z])(?:"), F.lit(words), F.lit(")(?:$|[^a-z])"))
    raised = lambda a: kind.prior + F.when(F.rlike(a, word(kind.words)), RAISE).otherwise(0) - F.when(F.rlike(a, word(AGAINST)), TAKE_OFF).otherwise(0)
    return let(around, raised).cast("int")


def alone(m: Column, char: str) -> Column:
    """Whether neither neighbour of a match is one of the characters."""
    return ~F.rlike(m["before"], F.lit(f"{char}$")) & ~F.rlike(m["after"], F.lit(f"^{char}"))


def span(kind: Kind, start: Column, end: Column, points: Column, base: Column) -> Column:
    return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), points.alias("score"), base.alias("base"))


def spans_where(kind: Kind, found: Column, confirmed: Callable[[Column], Column], base: Callable[[Column], Column]) -> Column:
    made = F.transform(F.filter(found, confirmed), lambda m: span(kind, m["start"], m["end"], score(kind, m), base(m)))
    return F.filter(made, lambda s: s["base"] | (s["score"] >= THRESHOLD))


def card_spans(found: Column) -> Column:
    """Cards: whole runs that pass, and the cards inside those that fail, which stand between blanks or hyphens."""

    def inside(m: Column) -> Column:
        free = lambda t, last: (F.when(t["start"] == 0, True).otherwise(t["before"] != "")) & (F.when(t["end"] == last, True).otherwise(t["after"] != ""))
        tokens = F.filter(located(m["value"], CARD_PART), lambda t: free(t, F.length(m["value"])) & is_card(digits(t["value"])))
        made = let(score(CARD, m), lambda s: F.transform(tokens, lambda t: span(CARD, m["start"] + t["start"], m["start"] + t["end"], s, F.lit(False))))
        return F.filter(made, lambda s: s["score"] >= THRESHOLD)

    whole = lambda m: F.array(span(CARD, m["start"], m["end"], score(CARD, m), F.lit(True)))
    return F.flatten(F.transform(F.filter(found, lambda m: F.length(m["value"]) >= 13), lambda m: F.when(is_card(digits(m["value"])), whole(m)).otherwise(inside(m))))


def account_spans(found: Column) -> Column:
    """Bank accounts: the first characters of a match, as many as the country's numbers have, if mod-97 leaves 1."""
    lengths = F.create_map(*[F.lit(x) for kv in ACCOUNT_LENGTHS.items() for x in kv])

    def cut(m: Column) -> Column:
        compact, n = F.replace(m["value"], F.lit(" "), F.lit("")), F.try_element_at(lengths, F.left(m["value"], F.lit(2)))
        grouped = F.length(compact) < F.length(m["value"])
        number = F.when(F.when(grouped, F.length(compact) >= n).otherwise(F.length(compact) == n), F.left(compact, n))
        end = m["start"] + F.when(grouped, n + F.floor((n - 1) / 4)).otherwise(n)
        return F.struct(m["start"].alias("start"), end.cast("long").alias("end"), number.alias("number"), m["before"].alias("before"), m["after"].alias("after"))

    cuts = F.filter(F.transform(F.filter(found, lambda m: alone(m, "[A-Za-z0-9]")), cut), lambda m: F.coalesce(mod97(m["number"]) == 1, F.lit(False)))
    return spans_where(IBAN, cuts, lambda m: F.lit(True), lambda m: F.lit(False))


def find_spans(text: Column) -> Column:
    """The spans of a text as SPAN, in the order of KINDS and then of their start; end is exclusive, both in code points."""
    t = F.coalesce(text, F.lit(""))
    base = lambda m: F.lit(True)
    number = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
    plus = lambda m: F.startswith(m["value"], F.lit("+"))
    phone = lambda m: F.when(plus(m), F.length(digits(m["value"])).between(9, 15)).otherwise(alone(m, "[A-Za-z0-9.-]"))
    given = lambda m: alone(m, "[0-9-]") & ~F.rlike(m["value"], F.lit("^(?:000|666|9)|-00-|0000$"))
    parts = [
        F.when(F.contains(t, F.lit("@")), spans_where(EMAIL, located(t, EMAIL.java), base, base)).otherwise(F.array().cast(SPAN)),
        spans_where(IP, located(t, IP.java), lambda m: F.rlike(m["value"], F.lit(number)), base),
        card_spans(located(t, CARD.java, 13)),
        spans_where(PHONE, located(t, PHONE.java), phone, plus),
        account_spans(located(t, IBAN.java)),
        spans_where(SSN, located(t, SSN.java), given, lambda m: F.lit(False)),
    ]
    return F.concat(*[p.cast(SPAN) for p in parts])


def personal_data(docs: DataFrame) -> DataFrame:
    """docs plus spans, as SPAN."""
    return docs.withColumn("spans", find_spans(F.col("text")))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in ("email", "ip", "card", "phone")], F.sha2(F.encode(written(base), "UTF-8"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def oracle_sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    cut = lambda name, rows, text, keys, pattern: f"""{name} AS (
  SELECT {keys}, i, g[i] AS before, f[i] AS val, g[i + 1] AS after, len(f) AS n,
         sum(length(g[i]) + length(f[i])) OVER (PARTITION BY {keys} ORDER BY i) AS stop
  FROM (SELECT {keys}, f, g, unnest(range(1, len(f) + 1)) AS i
        FROM (SELECT {keys}, regexp_extract_all({text}, {quoted(pattern)}) AS f, string_split_regex({text}, {quoted(pattern)}) AS g FROM {rows}))
)"""  # noqa: E731
    cuts = ",\n".join(cut(f"m_{k.name}", "docs", "text", "rn", k.plain) for k in KINDS)
    low = f"translate(right(before, {BEFORE}) || ' ' || left(after, {AFTER}), '{UPPER}', '{LOWER}')"
    hit = lambda words: f"regexp_matches({low}, '(?:^|[^a-z])(?:{words})(?:$|[^a-z])')"
    points = lambda k: f"{k.prior} + CASE WHEN {hit(k.words)} THEN {RAISE} ELSE 0 END - CASE WHEN {hit(AGAINST)} THEN {TAKE_OFF} ELSE 0 END"
    alone_sql = lambda char: f"NOT regexp_matches(before, '{char}$') AND NOT regexp_matches(after, '^{char}')"
    number = "regexp_replace(val, '[^0-9]', '', 'g')"
    doubled = "translate(reverse(d), '0123456789', '0246813579')"
    card = f"CASE WHEN length(d) BETWEEN 13 AND 19 THEN list_sum(list_transform(range(1, length(d) + 1), lambda i: CAST(CASE WHEN i % 2 = 0 THEN {doubled}[i] ELSE reverse(d)[i] END AS INT))) % 10 = 0 ELSE false END"
    lengths = "CASE left(val, 2) " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in ACCOUNT_LENGTHS.items()) + " END"
    folded = "list_reduce(list_prepend(0, list_transform(string_split(number[5:] || number[1:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97)"
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
{cuts},
runs AS (SELECT *, {points(CARD)} AS score, {card} AS ok FROM (SELECT *, {number} AS d FROM m_card)),
failed AS (SELECT row_number() OVER () AS run, rn, stop - length(val) AS first, val, score FROM runs WHERE NOT ok AND length(val) >= 13),
{cut("tokens", "failed", "val", "run", CARD_PART)},
accounts AS (
  SELECT *, CASE WHEN CASE WHEN grouped THEN length(compact) >= size ELSE length(compact) = size END THEN left(compact, size) END AS number
  FROM (SELECT *, {lengths} AS size, replace(val, ' ', '') AS compact, contains(val, ' ') AS grouped FROM m_iban WHERE {alone_sql("[A-Za-z0-9]")})
),
spans AS (
  SELECT rn, 1 AS kind, 'email' AS name, stop - length(val) AS start, stop, true AS base FROM m_email
  UNION ALL SELECT rn, 2, 'ip', stop - length(val), stop, true FROM m_ip WHERE regexp_matches(val, '^{IP_PART}(?:\\.{IP_PART}){{3}}$')
  UNION ALL SELECT rn, 3, 'card', stop - length(val), stop, true FROM runs WHERE ok
  UNION ALL SELECT rn, 3, 'card', first + start, first + stop, false
    FROM (SELECT rn, first, score, t.stop - length(t.val) AS start, t.stop, {card} AS ok
          FROM failed JOIN (SELECT *, {number} AS d FROM tokens WHERE (i = 1 AND before = '' OR before <> '') AND (i = n AND after = '' OR after <> '')) t USING (run))
    WHERE ok AND score >= {THRESHOLD}
  UNION ALL SELECT rn, 4, 'phone', stop - length(val), stop, starts_with(val, '+') FROM m_phone
    WHERE CASE WHEN starts_with(val, '+') THEN length({number}) BETWEEN 9 AND 15 ELSE {alone_sql("[A-Za-z0-9.-]")} AND {points(PHONE)} >= {THRESHOLD} END
  UNION ALL SELECT rn, 5, 'iban', stop - length(val), stop - length(val) + CASE WHEN grouped THEN size + (size - 1) // 4 ELSE size END, false
    FROM accounts WHERE number IS NOT NULL AND {folded} = 1 AND {points(IBAN)} >= {THRESHOLD}
  UNION ALL SELECT rn, 6, 'ssn', stop - length(val), stop, false FROM m_ssn
    WHERE {alone_sql("[0-9-]")} AND NOT regexp_matches(val, '^(?:000|666|9)|-00-|0000$') AND {points(SSN)} >= {THRESHOLD}
),
found AS (
  SELECT rn, count(*) FILTER (WHERE base AND kind = 1) AS e, count(*) FILTER (WHERE base AND kind = 2) AS i,
         count(*) FILTER (WHERE base AND kind = 3) AS c, count(*) FILTER (WHERE base AND kind = 4) AS p,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY kind, start) FILTER (WHERE base) AS b,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY kind, start) AS s
  FROM spans GROUP BY rn
)
SELECT doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans
FROM docs LEFT JOIN found USING (rn)
"""
