"""PII spans in text (native: DataFrame expressions only).

Regular expressions propose spans, checksum validators (Luhn, mod 97) confirm
them, and words near a span raise or lower its score.

Kinds of the base: ``email``, ``ip``, ``card``, ``phone``; a base span is always
reported.  Kinds that the method adds: ``iban`` (mod 97 confirms), ``card_short``
(13 to 15 digits, Luhn and a card word nearby), ``ssn`` (three-two-four digits
with an identity word nearby).  Added spans are reported from ``min_score`` on.
An IBAN may end at any word end: at the length of its country where mod 97 holds
there, else at the last one, or for an unlisted country the last at which it holds.

Row-local: no shuffle, one output row per input row, repeated rows included.
A null text counts as empty and has no spans; a null doc_id stays null; other
columns are not read.  Every pattern is linear in the text (possessive groups,
runs are entered at their start only), so a very long text or run costs in
proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import let, read_table, running_totals, text_of

# Span patterns by kind, in the order in which kinds are listed.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]{4}){2})",  # the start of one
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")

# The ends that an IBAN may have, the longest first, and its signs by country.
IBAN_CHARS = 44
IBAN_ENDS = [r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){%d}%s(?![A-Za-z0-9])" % (groups, rest)
             for groups in range(7, 1, -1) for rest in (r"\x20?[A-Z0-9]{1,3}", "")]
IBAN_LENGTHS = {country: length for length, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

# Context words by kind, and the words that speak against any kind.
NEAR = {
    "email": "mail|e-mail|contact|kontakt|correo|courriel",
    "ip": "ip|address|host|server|client",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "card_short": "card|visa|amex|credit|karte|carte|tarjeta",
    "ssn": "ssn|social security|identity|id number",
}
AGAINST = "example|sample|test|dummy|version|isbn|order|invoice"
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "card_short": 0.4, "ssn": 0.4}
CONTEXT_CHARS = 40
MIN_SCORE = 0.6

SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _guard(kind: str, text: Column) -> Column:
    """A cheap test that every match of the kind passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return F.rlike(text, F.lit("[0-9]{2}" if kind in ("iban", "ssn") else "[0-9]"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digit sum with every second digit from the right doubled, divisible by ten."""
    turned = F.split(F.reverse(digits), "")
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    values = F.transform(turned, lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod97(value: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), "")
    rest = F.aggregate(turned, F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.when(c.rlike("[0-9]"), c).otherwise("0").cast("int")) % 97,
    ).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(
            F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "card_short":
        n = F.length(_digits(value))
        return F.when(n.between(13, 15), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return F.lit(True)  # confirmed in _ibans
    return ~value.rlike("^(000|666|9..)|-00-|-0000$")


def _proposed(kind: str, text: Column) -> Column:
    """All leftmost non-overlapping matches with code point positions.

    ``split`` and ``regexp_extract_all`` run the same pattern over the same
    text, so the pieces and the matches alternate and their lengths add up to
    the positions.
    """
    pieces = F.split(text, PATTERNS[kind], -1)
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = let(pieces, lambda p: F.zip_with(
        F.slice(p, 1, F.size(p) - 1), found,
        lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m).alias("len"), m.alias("value"))))
    starts = lambda g: running_totals(F.transform(g, lambda x: x["gap"] + x["len"]))
    spans = let(gaps, lambda g: F.zip_with(g, starts(g), lambda x, s: F.struct(
        F.lit(kind).alias("kind"),
        (s + x["gap"]).cast("bigint").alias("start"),
        (s + x["gap"] + x["len"]).cast("bigint").alias("end"),
        x["value"].alias("value"))))
    return F.when(_guard(kind, text), spans).otherwise(F.expr(f"cast(array() as {SPANS})"))


def _ibans(text: Column, starts: Column) -> Column:
    """The confirmed spans that begin at the proposed starts; one that begins inside another is left out."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    signs = lambda v: F.length(F.replace(v, F.lit(" "), F.lit("")))

    def longest(tail: Column) -> Column:
        due = F.try_element_at(lengths, F.substring(tail, 1, 2))
        ends = F.filter(F.array(*[F.regexp_extract(tail, end, 0) for end in IBAN_ENDS]), lambda v: v != "")
        allowed = F.filter(ends, lambda v, i: due.isNull() | (signs(v) == due) | (i == 0))
        return let(F.filter(allowed, _mod97), lambda ok: F.coalesce(
            F.get(F.filter(ok, lambda v: signs(v) == due), F.lit(0)), F.get(ok, F.lit(0))))

    def span(x: Column) -> Column:
        tail = F.substr(text, (x["start"] + 1).cast("int"), F.lit(IBAN_CHARS))
        return let(let(tail, longest), lambda v: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), (x["start"] + F.length(v)).alias("end"), v.alias("value")))

    confirmed = F.filter(F.transform(starts, span), lambda x: x["value"].isNotNull())
    return let(confirmed, lambda all_: F.filter(all_, lambda x: ~F.exists(
        all_, lambda y: (y["start"] < x["start"]) & (x["start"] < y["end"]))))


def _scored(text: Column, spans: Column, kind: str) -> Column:
    """The kind's prior, plus 0.3 if one of its words is near, less 0.2 if one speaks against it."""
    def near(x: Column) -> Column:
        first = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)).cast("int")
        before = F.substr(text, first + 1, (x["start"] - first).cast("int"))
        after = F.substr(text, (x["end"] + 1).cast("int"), F.lit(CONTEXT_CHARS))
        return F.lower(F.concat(before, F.lit(" "), after))

    def weight(words: Column) -> Column:
        return (F.lit(PRIOR[kind])
                + F.when(F.rlike(words, F.lit(rf"\b(?:{NEAR[kind]})\b")), 0.3).otherwise(0.0)
                - F.when(F.rlike(words, F.lit(rf"\b(?:{AGAINST})\b")), 0.2).otherwise(0.0))

    def score(x: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                        x["value"].alias("value"),
                        F.round(F.least(let(near(x), weight), F.lit(1.0)), 2).alias("score"))
    return F.transform(spans, score)


def find_pii(docs: DataFrame, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii_added``, arrays of (kind, start, end, value, score).

    Starts and ends are code points, ends exclusive.  Base spans stay whatever
    their score; an added span stays from ``min_score`` on and only where it
    lies in no base span.
    """
    text = text_of(text_col)
    out = docs.withColumn("_pii_text", text)
    text = F.col("_pii_text")
    raw = {k: f"_pii_{k}" for k in PATTERNS}
    out = out.withColumns({c: _proposed(k, text) for k, c in raw.items()})
    out = out.withColumn(raw["iban"], _ibans(text, F.col(raw["iban"])))
    confirmed = lambda k: F.filter(F.col(raw["card" if k == "card_short" else k]), lambda x: _valid(k, x["value"]))
    kept = {k: confirmed(k) for k in (*PATTERNS, "card_short")}
    out = out.withColumns({f"_ok_{k}": v for k, v in kept.items()})
    base = F.concat(*[_scored(text, F.col(f"_ok_{k}"), k) for k in BASE])
    out = out.withColumn("pii_base", base)
    added = F.concat(*[_scored(text, F.col(f"_ok_{k}"), k) for k in ("iban", "card_short", "ssn")])
    inside = lambda x, base: F.exists(base, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))
    out = out.withColumn("pii_added", let(F.col("pii_base"), lambda base: F.filter(
        added, lambda x: (x["score"] >= min_score) & ~inside(x, base))))
    return out.drop("_pii_text", *raw.values(), *[f"_ok_{k}" for k in kept])


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every text of ``documents`` as digest columns."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs)
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("pii_base", lambda x: x["kind"] == k))
    counts = [count(k).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts,
        F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"),
        listed(F.concat("pii_base", "pii_added")).alias("spans"))
