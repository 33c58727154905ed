"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

DataFrame functions only. A pattern cuts the text into matches and the gaps between them; their lengths give the
positions, so everything about a text is computed in its own row and nothing is shuffled. Patterns use possessive
repeats where no shorter match could succeed: a run of any length is scanned without recursion and only once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


THRESHOLD = 0.5
NEAR_BEFORE, NEAR_AFTER = 48, 24
SPAN = "struct<start:bigint,order:int,kind:string,end:bigint,score:double>"
_STEP = "struct<at:bigint,found:array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>>"

# fixed values: length of an account number by country; the oracle reads the first table
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
                "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
IBAN_REGISTRY = IBAN_LENGTHS | {
    "AD": 24, "AE": 23, "AL": 28, "AZ": 28, "BA": 20, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CR": 22, "CY": 28,
    "DJ": 27, "DO": 28, "EE": 20, "EG": 29, "FK": 18, "FO": 18, "GE": 22, "GI": 23, "GL": 18, "GT": 28, "HN": 28, "HR": 21,
    "IL": 23, "IQ": 23, "IS": 26, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LV": 21, "LY": 25,
    "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "OM": 23, "PK": 24, "PS": 29,
    "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}


def _iban_pattern() -> str:
    """Two letters where a number begins; group 1 is all of it, unspaced or in groups of four, as long as its country says.

    Only the letters are consumed: a number may begin inside what looks like another one.
    """
    def of_length(n: int) -> str:
        codes = "|".join(sorted(c for c, size in IBAN_REGISTRY.items() if size == n))
        fours, rest = divmod(n - 4, 4)
        last = f" [A-Z0-9]{{{rest}}}" if rest else ""
        return f"(?:{codes})[0-9]{{2}}(?:[A-Z0-9]{{{n - 4}}}|(?: [A-Z0-9]{{4}}){{{fours}}}{last})"

    numbers = "|".join(of_length(n) for n in sorted(set(IBAN_REGISTRY.values())))
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{numbers})(?![A-Za-z0-9])))[A-Z]{{2}}"


class Kind(NamedTuple):
    name: str
    pattern: str
    maybe: Callable[[Column], Column]  # a cheap condition every text with a match meets
    valid: Callable[[Column], Column]  # checksum or range of a match
    score: float
    context: str  # words nearby that make a match more likely
    bonus: float
    bounded: bool = False  # no letter or digit may touch the match
    ahead: int = 0  # if not 0: the pattern consumes so many characters and group 1 is the match


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_valid(value: Column) -> Column:
    return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?:\.|$)){4}")


def _card_valid(value: Column) -> Column:
    return F.length(_digits(value)).between(14, 19) & F.call_function("luhn_check", _digits(value))


def _mod_97(value: Column) -> Column:
    """Account numbers: the first four characters go last, letters count from 10; the remainder must be 1."""
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    letters = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substr(turned, i, F.lit(1))))
    return F.aggregate(letters, F.lit(0), lambda r, c: F.when(c < 58, (r * 10 + c - 48) % 97).otherwise(
        (r * 100 + c - 55) % 97)) == 1


def _iban_valid(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    return _mod_97(plain)


def _always(value: Column) -> Column:
    return F.lit(True)


BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: t.contains("@"), _always, 0.9, r"(?i)mail|contact|write|schreib|courriel|correo", 0.1),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_valid, 0.6,
         r"(?i)\bip\b|address|host|server|login", 0.2),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), _card_valid, 0.8,
         r"(?i)card|visa|credit|karte|carte|tarjeta", 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.rlike(r"\+[0-9]"),
         lambda v: F.length(_digits(v)).between(10, 15), 0.7, r"(?i)phone|call|tel|mobil|fax", 0.2),
]
MORE = [
    Kind("iban", _iban_pattern(),
         lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}[ A-Z0-9]"), _iban_valid, 0.7, r"(?i)iban|account|konto|compte|cuenta|bank",
         0.3, ahead=2),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
         lambda v: ~v.rlike(r"^(?:000|666|9)|-00-|-0000$"), 0.3, r"(?i)\bssn\b|social security", 0.5, True),
]


def _matches(text: Column, kind: Kind) -> Column:
    """Leftmost matches that do not overlap, with positions in code points and the text around each.

    With ``ahead`` every place where the pattern matches counts.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.ahead else 0))
    gaps = F.split(text, kind.pattern)

    def rest(value: Column, after: Column) -> Column:
        return F.substr(after, F.length(value) - kind.ahead + 1) if kind.ahead else after

    rows = F.zip_with(
        F.arrays_zip(found.alias("value"), F.slice(gaps, 1, F.size(found)).alias("before")),
        F.slice(gaps, 2, F.size(found)),
        lambda m, after: F.struct(m["value"].alias("value"), F.length(m["before"]).cast("bigint").alias("gap"),
                                  F.right(m["before"], F.lit(NEAR_BEFORE)).alias("before"),
                                  F.left(rest(m["value"], after), F.lit(NEAR_AFTER)).alias("after")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().alias("found")).cast(_STEP)

    def step(done: Column, row: Column) -> Column:
        begin = done["at"] + row["gap"]
        end = begin + F.length(row["value"])
        one = F.struct(begin.alias("start"), end.alias("end"), row["value"].alias("value"),
                       row["before"].alias("before"), row["after"].alias("after"))
        at = begin + kind.ahead if kind.ahead else end
        return F.struct(at.alias("at"), F.concat(done["found"], F.array(one)).alias("found")).cast(_STEP)

    return F.aggregate(rows, start, step, lambda done: done["found"])


def _spans(text: Column, kind: Kind, order: int, always: bool) -> Column:
    """Confirmed spans of a kind; ``always``: the score is told but does not decide."""
    near = lambda m: m["before"].rlike(kind.context) | m["after"].rlike(kind.context)
    score = lambda m: F.round(F.lit(kind.score) + F.when(near(m), kind.bonus).otherwise(0.0), 2)

    def keep(m: Column) -> Column:
        fine = kind.valid(m["value"])
        if kind.bounded:
            fine = fine & ~m["before"].rlike("[A-Za-z0-9]$") & ~m["after"].rlike("^[A-Za-z0-9]")
        return fine if always else fine & (score(m) >= THRESHOLD)

    spans = F.transform(F.filter(_matches(text, kind), keep), lambda m: F.struct(
        m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), m["end"].alias("end"),
        score(m).alias("score")).cast(SPAN))
    return F.when(kind.maybe(text), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_spans(docs: DataFrame, *, text_col: str = "text", spans_col: str = "spans", base: list[Kind] = BASE,
               more: list[Kind] = MORE) -> DataFrame:
    """Add an array of spans ``start, order, kind, end, score`` by start, then kind as listed; end is exclusive.

    Positions are code points of the whole text. ``base`` kinds keep every confirmed match, ``more`` kinds only those
    whose score with the words nearby reaches the threshold. A null or empty text has an empty array; equal rows
    each get their own; all other columns pass; a column called ``spans_col`` is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [*[(k, True) for k in base], *[(k, False) for k in more]]
    parts = [_spans(text, kind, order, always) for order, (kind, always) in enumerate(kinds)]
    return docs.withColumn(spans_col, F.array_sort(F.concat(*parts)))


def number_of(spans: Column | str, kind: Kind) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind.name))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; where spans overlap, the first one's name stands."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        before = F.substr(text, done["at"].cast("int") + 1, (span["start"] - done["at"]).cast("int"))
        fresh = span["start"] >= done["at"]
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.when(fresh, F.concat(
            done["out"], before, F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(done["out"]).alias("out"))

    replaced = F.aggregate(spans, start, step, lambda done: F.concat(
        done["out"], F.substr(text, done["at"].cast("int") + 1)))
    return F.when(F.size(spans) > 0, replaced).otherwise(text)
