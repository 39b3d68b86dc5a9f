r"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Base kinds, each searched leftmost and without overlaps over the whole text:

=====  =============================================================================
email  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
ip     ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, each part at most 255
card   ``[0-9]([\x20-]?[0-9])+``, 12 to 19 digits that pass Luhn
phone  ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits
=====  =============================================================================

The method adds spans (base ones always stay): ``iban`` (mod-97), ``ssn`` (area, group and serial not all zero) and
``secret`` (token-like strings), which are kept when their score reaches ``threshold``.  The score of a span is that of
its kind, raised where one of the kind's context words stands in the ``window`` code points before it.

Everything is Column expressions.  The patterns below give the spans of the patterns above in one linear pass: they are
possessive (no backtracking, no recursion over long runs) and start only where a maximal run starts.  That matters on very
long texts of one character class, where the plain patterns take quadratic time or overflow the stack.

Defined cases: a null text is the empty text and has no span; a null ``doc_id`` and repeated rows pass through row by row;
an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwatch.llm.common import rekeyed

#: Listed order of the kinds: ties of ``start`` are put in this order.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]

#: Characters of an IBAN after country code and check digits, by country.
IBAN_REST = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV",
    18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "LY PT ST",
    22: "IS TR", 23: "BI DJ FR GR IT MC MR SM", 24: "AL AZ BY CY DO GT HN HU LB NI PL SV", 25: "BR EG PS QA UA", 26: "JO KW MU YE",
    27: "MT SC", 28: "LC", 29: "RU",
}
_IBANS = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}+(?![A-Za-z0-9])" for n, c in IBAN_REST.items())

_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a maximal run of 12 to 19 digits with single separators, and no other run
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # of the country's length, so that what follows a space is not taken in; then without spaces; then any (other codes)
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS}|[A-Z0-9]{{15,34}}+(?![A-Za-z0-9])|[A-Z0-9]{{4}}(?:\x20?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9]))",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{40})(?![A-Za-z0-9])",
}
#: A text without this has no span of the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}

SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "secret": 0.4}
#: Context words raise the score by this.
LIFT = 0.2
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|master|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto",
    "ssn": "ssn|social|security|insurance",
    "secret": "key|token|secret|password|aws",
}
WINDOW = 40
THRESHOLD = 0.5


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def term(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN (letters and digits) leaves 1 modulo 97 once its first four characters stand last."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n <= 57, (acc * 10 + n - 48) % 97).otherwise((acc * 100 + n - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _small_part(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), _small_part)
    if kind == "card":
        return luhn(_digits(s))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(s, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~s.rlike("^000|^666|^9|-00-|0000$")
    return F.lit(True)


def _proposed(text: Column, kind: str) -> Column:
    """Array of (start, end, value) of the pattern's matches, in code points."""
    pattern = F.lit(PATTERNS[kind])
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)  # what stands before, between and after the matches
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")
    first = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["v"])
        one = F.array(F.struct(start.cast("int").alias("s"), end.cast("int").alias("e"), x["v"].alias("v")))
        return F.struct(end.alias("at"), F.when(_valid(kind, x["v"]), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    pairs = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.struct(g.alias("gap"), v.alias("v")))
    found = F.when(F.size(values) > 0, F.aggregate(pairs, first, step, lambda acc: acc["out"])).otherwise(empty)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(empty) if kind in NEEDS else found


def _scored(text: Column, kind: str, spans: Column, window: int) -> Column:
    """The spans as (s, e, k, kind, score); k orders the kinds."""

    def one(x: Column) -> Column:
        a = F.greatest(x["s"] - window, F.lit(0))
        before = F.lower(F.substring(text, a + 1, x["s"] - a))
        score = F.lit(SCORES[kind]) + F.when(before.rlike(rf"\b(?:{CONTEXT[kind]})"), F.lit(LIFT)).otherwise(F.lit(0.0))
        return F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"), score.alias("score"))

    return F.transform(spans, one)


def find_pii(df: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``found``: the spans of each row, an array of (s, k, e, kind, score) in order of (s, k).

    ``s`` and ``e`` count code points, ``e`` exclusive.  Spans of the added kinds need ``threshold``.
    """
    text = F.col("text")
    rows = rekeyed(df, ("doc_id", "text")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *[_proposed(text, k).alias(k) for k in KINDS])
    rows = rows.select("doc_id", *[_scored(text, k, F.col(k), window).alias(k) for k in KINDS])
    strong = [F.col(k) if k in BASE else F.filter(F.col(k), lambda x: x["score"] >= threshold) for k in KINDS]
    return rows.select("doc_id", F.sort_array(F.concat(*strong)).alias("found"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def pii_digest(df: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, all spans as text, and the highest score."""
    found = F.col("found")
    count = lambda kind: F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
    return find_pii(df).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(F.filter(found, lambda x: x["k"] < len(BASE))), 256).alias("base_sha256"),
        _listed(found).alias("spans"),
        F.array_max(F.transform(found, lambda x: x["score"])).alias("top_score"),
    )
