"""Format-preserving pseudonyms by Feistel permutations, with DataFrame functions only.

A candidate in a text is a number or date in a known format; only if it passes
the format's own test (a check digit, a calendar, allowed ranges) is it replaced.
Its digits name a place in the set of all values the format allows; a keyed
Feistel network over that set gives another place, and that place's value is
written in the shape of the original, signs and spaces included. So equal values
get equal pseudonyms in every document, different values different ones, and
with the key the step can be taken back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.llm.common import col, free

ROUNDS = 8

# How the formats are written.
_EDGE, _END = r"(?<![\w.+-])", r"(?![\w-])(?!\.\d)"
_CARD = r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19}"
_PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
_IP = r"(?:\d{1,3}\.){3}\d{1,3}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}"


@dataclass(frozen=True)
class Format:
    """A way to write values: its pattern, its test, and its values as places (l, r) of an a x b grid.

    ``places`` takes the candidate's digits and text; ``value`` gives digits for a place.
    """

    name: str
    pattern: str
    valid: Callable[[Column, Column], Column]
    grid: Callable[[Column], tuple[Column, Column]]
    places: Callable[[Column, Column], tuple[Column, Column]]
    value: Callable[[Column, Column, Column], Column]


def _part(digits: Column, start: int, length: int) -> Column:
    return F.substring(digits, start, length).try_cast("long")


def _padded(x: Column, length: Column | int) -> Column:
    return F.lpad(x.cast("string"), length, "0")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, the last of them counted once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    terms = F.transform(each, lambda d, i: F.when(i % 2 == 1, (d * 2) % 10 + F.floor(d / 5).cast("int")).otherwise(d))
    return F.aggregate(terms, F.lit(0), lambda n, d: n + d)


def _card_value(l: Column, r: Column, digits: Column) -> Column:
    half = F.floor((F.length(digits) - 1) / 2).cast("int")
    payload = F.concat(_padded(l, half), _padded(r, F.length(digits) - 1 - half))
    check = F.pmod(-luhn_sum(F.concat(payload, F.lit("0"))), F.lit(10))
    return F.concat(payload, check.cast("string"))


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _card_grid(digits: Column) -> tuple[Column, Column]:
    half = F.floor((F.length(digits) - 1) / 2).cast("int")
    return _power(half), _power(F.length(digits) - 1 - half)


def _card_places(digits: Column, text: Column) -> tuple[Column, Column]:
    half = F.floor((F.length(digits) - 1) / 2).cast("int")
    left = F.substring(digits, F.lit(1), half)
    return left.try_cast("long"), F.substring(digits, half + 1, F.length(digits) - 1 - half).try_cast("long")


#: days that dates are dealt among: a grid of 365 x 200 from the first
_FIRST_DAY, _DAYS = "1900-01-01", (365, 200)


def _day(digits: Column) -> Column:
    iso = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.lit(_FIRST_DAY).cast("date"))


def _octet(text: Column, k: int) -> Column:
    return F.split_part(text, F.lit("."), F.lit(k)).try_cast("long")


def _octets(l: Column, r: Column) -> Column:
    return F.concat_ws(".", *[x.cast("string") for v in (l, r) for x in (F.shiftright(v, 8), v.bitwiseAND(F.lit(255)))])


# the last ten digits of a phone number: area and exchange, any three digits each, and the line
def _phone(digits: Column, back: int, length: int) -> Column:
    return F.substring(digits, F.length(digits) - back + 1, F.lit(length)).try_cast("long")


def _ssn_area(x: Column) -> Column:
    """001-665, 667-899 as 0..897."""
    return F.when(x > 666, x - 2).otherwise(x - 1)


FORMATS = (
    Format(
        "date",
        _DATE,
        lambda d, t: F.coalesce(_day(d).between(0, _DAYS[0] * _DAYS[1] - 1), F.lit(False)),
        lambda d: (F.lit(_DAYS[0]).cast("long"), F.lit(_DAYS[1]).cast("long")),
        lambda d, t: (F.floor(_day(d) / _DAYS[1]), F.pmod(_day(d), F.lit(_DAYS[1])).cast("long")),
        lambda l, r, d: F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), (l * _DAYS[1] + r).cast("int")), "yyyyMMdd"),
    ),
    Format(
        "ssn",
        _SSN,
        lambda d, t: (_part(d, 1, 3).between(1, 899)) & (_part(d, 1, 3) != 666) & (_part(d, 4, 2) > 0) & (_part(d, 6, 4) > 0),
        lambda d: (F.lit(898 * 99).cast("long"), F.lit(9999).cast("long")),
        lambda d, t: (_ssn_area(_part(d, 1, 3)) * 99 + _part(d, 4, 2) - 1, _part(d, 6, 4) - 1),
        lambda l, r, d: F.concat(
            _padded(F.floor(l / 99) + F.when(F.floor(l / 99) >= 665, 2).otherwise(1), 3),
            _padded(l % 99 + 1, 2),
            _padded(r + 1, 4),
        ),
    ),
    Format(
        "phone",
        _PHONE,
        lambda d, t: F.length(d).isin(10, 11),
        lambda d: (F.lit(1000 * 1000).cast("long"), F.lit(10_000).cast("long")),
        lambda d, t: (_phone(d, 10, 6), _phone(d, 4, 4)),
        lambda l, r, d: F.concat(
            F.substring(d, F.lit(1), F.length(d) - 10),
            _padded(l, 6),
            _padded(r, 4),
        ),
    ),
    Format(
        "ip",
        _IP,
        lambda d, t: F.forall(F.split(t, r"\."), lambda x: (x.try_cast("int") <= 255) & ~x.rlike(r"^0\d")),
        lambda d: (F.lit(65_536).cast("long"), F.lit(65_536).cast("long")),
        lambda d, t: (_octet(t, 1) * 256 + _octet(t, 2), _octet(t, 3) * 256 + _octet(t, 4)),
        lambda l, r, d: _octets(l, r),
    ),
    Format(
        "card",
        _CARD,
        lambda d, t: F.length(d).between(13, 19) & (luhn_sum(d) % 10 == 0),
        _card_grid,
        _card_places,
        _card_value,
    ),
)
#: a candidate in a text: any format's way to write, not part of a longer word or number
CANDIDATE = f"{_EDGE}(?:{'|'.join(f.pattern for f in (FORMATS[0], FORMATS[1], FORMATS[2], FORMATS[3], FORMATS[4]))}){_END}"


def feistel(l: Column, r: Column, a: Column, b: Column, key: str, tweak: str, rounds: int = ROUNDS, back: bool = False) -> Column:
    """A keyed permutation of the a x b grid: struct (l, r).

    Each round adds to one half a keyed hash of the other, modulo its side of the
    grid, so every place of the grid is met once and none outside it.
    """

    def digest(i: Column, other: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), F.lit(tweak), a.cast("string"), b.cast("string"), i.cast("string"), other.cast("string"))
        return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")

    sign = -1 if back else 1

    def step(state: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(state["l"] + sign * F.pmod(digest(i, state["r"]), a), a)).otherwise(state["l"])
        right = F.when(i % 2 == 1, F.pmod(state["r"] + sign * F.pmod(digest(i, state["l"]), b), b)).otherwise(state["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    order = F.sequence(F.lit(rounds - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(rounds - 1))
    return F.aggregate(order, F.struct(l.cast("long").alias("l"), r.cast("long").alias("r")), step)


def in_shape(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced, one by one, by ``digits``."""
    chars = F.split(text, "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def write(state: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, digits.substr(state["at"], F.lit(1))).otherwise(c)).alias("out"),
            (state["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(chars, start, write)["out"]


def _once(place: Column, digits: Column, value: Callable[[Column, Column, Column], Column]) -> Column:
    """``value`` of a place that is worked out once, however often ``value`` names it."""
    return F.element_at(F.transform(F.array(place), lambda p: value(p["l"], p["r"], digits)), 1)


def pseudonym(text: Column, key: str, back: bool = False) -> Column:
    """struct (kind, value) of a candidate; NULL kind and the text itself if no format holds it valid."""
    digits = F.regexp_replace(text, r"\D", "")
    out = F.struct(F.lit(None).cast("string").alias("kind"), text.alias("value"))
    for f in reversed(FORMATS):
        l, r = f.places(digits, text)
        a, b = f.grid(digits)
        moved = feistel(l, r, a, b, key, f.name, back=back)
        new = _once(moved, digits, f.value)
        written = new if f.name == "ip" else in_shape(text, new)
        whole = F.regexp_like(text, F.lit(rf"^(?:{f.pattern})$")) & F.coalesce(f.valid(digits, text), F.lit(False))
        out = F.when(whole, F.struct(F.lit(f.name).alias("kind"), written.alias("value"))).otherwise(out)
    return out


def pseudonymise(
    df: DataFrame, text: str = "text", key: str = "key-1", back: bool = False, name: str = "replaced"
) -> DataFrame:
    """Every row of ``df`` with valid numbers and dates in its text replaced, and ``replaced``: what was replaced.

    ``replaced`` lists kind and offset of each, in code points of the original
    text. Formats: payment card numbers with a valid Luhn digit, telephone numbers
    in the North American shape (any area code and exchange), IPv4 addresses, social security numbers in the
    ranges that are given out, and calendar dates from 1900 for 73,000 days. ``back``
    takes the pseudonyms back. NULL and empty texts stay as they are, texts
    without a candidate are not rebuilt, rows may repeat, an empty table gives no
    rows, the added column takes an underscore where the input has its name.
    """
    columns, name = df.columns, free(df.columns, name)
    t = col(text)
    found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
    work = free([*columns, name], "work")
    between = F.split(t, CANDIDATE, -1)
    # the parts of a text around its candidates, and what each candidate becomes
    parts = F.when(t.rlike(CANDIDATE), F.struct(between.alias("between"), F.transform(found, lambda c: F.struct(c.alias("old"), pseudonym(c, key, back).alias("new"))).alias("new")))
    rows = df.withColumn(work, parts)
    p = col(work)
    pieces = F.zip_with(p["between"], p["new"], lambda x, n: F.concat(x, F.coalesce(n["new"]["value"], F.lit(""))))
    spots = F.aggregate(
        F.arrays_zip(p["between"].alias("x"), p["new"].alias("n")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind: string, start: int>>").alias("found")),
        lambda s, z: F.struct(
            (s["at"] + F.length(z["x"]) + F.coalesce(F.length(z["n"]["old"]), F.lit(0))).alias("at"),
            F.when(
                z["n"]["new"]["kind"].isNotNull(),
                F.concat(s["found"], F.array(F.struct(z["n"]["new"]["kind"].alias("kind"), (s["at"] + F.length(z["x"])).alias("start")))),
            )
            .otherwise(s["found"])
            .alias("found"),
        ),
    )["found"]
    empty = F.array().cast("array<struct<kind: string, start: int>>")
    new_text = F.when(p.isNull(), t).otherwise(F.array_join(pieces, ""))
    return rows.select(
        *[new_text.alias(c) if c == text else col(c) for c in columns],
        F.when(p.isNull(), empty).otherwise(spots).alias(name),
    )
