"""Exclusion constraints over any number of ranges: rows that conflict with an earlier one, never pairs of rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.functions.text import spark_expression
from fleetschema.operators.rows import named
from fleetschema.staging import stage

# Bounds as ranges are written; the first is that of a range made without them.
BOUNDS = ("[)", "[]", "()", "(]")
#: a constraint's ranges are spread over at most so many sizes of cells, each twice the one before
_LEVELS = 40


@dataclass(frozen=True)
class Exclusion:
    """Two rows conflict if they agree in ``equal``, differ in every one of ``differ`` and overlap in every range.

    ranges: (start column, end column, bounds). A NULL start or end is an open bound.
    """

    equal: Sequence[str] = ()
    ranges: Sequence[tuple[str, str, str]] = ()
    differ: Sequence[str] = ()
    where: str | None = None
    columns: list[str] = field(init=False)

    def __post_init__(self):
        if any(b not in BOUNDS for *_, b in self.ranges):
            raise ValueError(f"bounds are one of {BOUNDS}")
        if not self.ranges and not self.differ:
            raise ValueError("equal columns alone are a unique key; use validate_unique")
        object.__setattr__(self, "columns", [*self.equal, *[c for a, b, _ in self.ranges for c in (a, b)], *self.differ])


_NAME = r'(?:"(?:[^"]|"")+"|\w+)'
_ELEMENT = re.compile(
    rf"\s*(?:(?P<range>(?:int4|int8|num|ts|tstz|date)range)\(\s*(?P<start>{_NAME})\s*,\s*(?P<end>{_NAME})\s*(?:,\s*'(?P<bounds>[^']*)'(?:::text)?\s*)?\)"
    rf"|(?P<name>{_NAME}))\s+WITH\s+(?P<operator>=|&&|<>)\s*(?:,|$)"
)


def parse_exclusion(text: str, ranges: Mapping[str, tuple[str, str, str]] | None = None) -> Exclusion | None:
    """An EXCLUDE clause as a catalog writes it; None if it uses anything but columns, range functions, ``=``, ``&&`` and ``<>``.

    ``ranges`` says by which columns the rows hold a column of a range type.
    """
    clause = re.fullmatch(
        r"\s*EXCLUDE\s+(?:USING\s+\w+\s*)?\((?P<elements>.*?)\)(?:\s*WHERE\s*(?P<where>\(.*\)))?(?:\s*(?:NOT\s+)?DEFERRABLE.*)?\s*", text, re.DOTALL
    )
    if not clause:
        return None
    plain = lambda n: n[1:-1].replace('""', '"') if n.startswith('"') else n
    equal, spans, differ, at = [], [], [], 0
    elements = clause["elements"]
    while at < len(elements):
        m = _ELEMENT.match(elements, at)
        if not m:
            return None
        at = m.end()
        if m["range"] and m["operator"] == "&&":
            spans.append((plain(m["start"]), plain(m["end"]), m["bounds"] or BOUNDS[0]))
        elif m["range"]:
            return None
        elif m["operator"] == "&&":
            if plain(m["name"]) not in (ranges or {}):
                return None
            spans.append(tuple(ranges[plain(m["name"])]))
        else:
            (equal if m["operator"] == "=" else differ).append(plain(m["name"]))
    return Exclusion(equal, spans, differ, clause["where"]) if spans or differ else None


def excluded_rows(df: DataFrame, rule: Exclusion, order: Sequence[str], either: bool = False) -> DataFrame:
    """Rows of ``df`` that conflict with a row before them in ``order``, whose columns identify a row and hold no NULL.

    With ``either`` those that conflict with any other row, before or behind.

    Every row lies in cells of the size that its ranges need, at most two a
    range, and also looks at the cells of all larger sizes in use; two rows that
    overlap meet in a cell of the larger one's size. Of the rows there, a semi join
    asks whether an earlier one conflicts, so a row comes out once however many it
    conflicts with, and adaptive execution may split a cell that very many rows
    share. A row with NULL in ``equal`` or ``differ`` conflicts with none, nor does an empty range.
    Ranges are those of numbers, dates or timestamps.
    """
    needed = [*rule.equal, *rule.differ]
    rows = df.where(F.expr(spark_expression(rule.where))) if rule.where else df
    narrow = rows.select(*[named(c) for c in dict.fromkeys([*rule.columns, *order])])
    for c in needed:
        narrow = narrow.where(named(c).isNotNull())
    for a, b, bounds in rule.ranges:
        filled = named(a) <= named(b) if bounds == "[]" else named(a) < named(b)
        narrow = narrow.where(F.coalesce(filled, F.lit(True)))
    names = [f"o{k}" for k in range(len(order))]
    slim = narrow.select(
        *[named(c).alias(f"e{k}") for k, c in enumerate(rule.equal)],
        *[x for k, (a, b, _) in enumerate(rule.ranges) for x in (named(a).alias(f"s{k}"), named(b).alias(f"t{k}"))],
        *[named(c).alias(f"d{k}") for k, c in enumerate(rule.differ)],
        *[named(c).alias(n) for n, c in zip(names, order)],
    )
    method = _by_first_values if not rule.ranges and len(rule.differ) == 1 else _by_cells
    found = method(slim, rule, names, either)
    same = reduce(Column.__and__, [named(c) == F.col(f"found_{n}") for n, c in zip(names, order)])
    found = stage(found.select(*[F.col(n).alias(f"found_{n}") for n in names]), "excluded")
    return rows.join(found, same, "left_semi")


def count_excluded(df: DataFrame, rule: Exclusion, by: str) -> DataFrame:
    """(``by``, n): rows that conflict with any other row of the same ``by``, repeated rows included."""
    mine = Exclusion([by, *rule.equal], rule.ranges, rule.differ)
    rows = df.where(F.expr(spark_expression(rule.where))) if rule.where else df
    slim = rows.select(*[named(c) for c in dict.fromkeys(mine.columns)]).withColumn("__row", F.monotonically_increasing_id())
    found = excluded_rows(stage(slim, "numbered-rows"), mine, ["__row"], either=True)
    return found.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def _by_first_values(slim: DataFrame, rule: Exclusion, names: list[str], either: bool) -> DataFrame:
    """Of keys with several values: rows of another value than the first row's, and rows behind the first of these."""
    keys = [f"e{k}" for k in range(len(rule.equal))] or ["all_rows"]
    slim = slim if rule.equal else slim.withColumn("all_rows", F.lit(0))
    first = slim.groupBy(*keys, "d0").agg(F.min(F.struct(*names)).alias("first"))
    ranked = _two_first(first, keys)
    joined = slim.join(ranked, keys)
    return joined.where(F.lit(either) | (F.col("d0") != F.col("v")) | (F.struct(*names) > F.col("other")))


def _two_first(first: DataFrame, keys: list[str]) -> DataFrame:
    """The value of a key's first row, and the first row of any other value; keys of one value are left out."""
    low = first.groupBy(*keys).agg(F.min(F.struct("first", F.col("d0").alias("v"))).alias("low")).select(*keys, "low.v")
    others = first.join(low, keys).where(F.col("d0") != F.col("v"))
    return others.groupBy(*keys, "v").agg(F.min("first").alias("other"))


def _position(value: Column, kind: str) -> Column:
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp_ntz":
        return value.cast("timestamp").cast("double")
    return value.cast("double")


def _by_cells(slim: DataFrame, rule: Exclusion, names: list[str], either: bool) -> DataFrame:
    kinds = dict(slim.dtypes)
    dims = range(len(rule.ranges))
    for k in dims:
        slim = slim.withColumns({f"a{k}": _position(F.col(f"s{k}"), kinds[f"s{k}"]), f"b{k}": _position(F.col(f"t{k}"), kinds[f"t{k}"])})
    slim = stage(slim, "boxes")
    stats = slim.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(F.least(f"a{k}", f"b{k}")).alias(f"low{k}") for k in dims],
        *[F.max(F.greatest(f"a{k}", f"b{k}")).alias(f"high{k}") for k in dims],
        *[F.percentile_approx(F.col(f"b{k}") - F.col(f"a{k}"), 0.5).alias(f"width{k}") for k in dims],
    ).first()
    if not stats["n"]:
        return slim
    width, low = {}, {}
    level = F.lit(0)
    for k in dims:
        low[k] = stats[f"low{k}"] or 0.0
        spread = (stats[f"high{k}"] or 0.0) - low[k]
        width[k] = max(stats[f"width{k}"] or 0.0, spread / 2.0 ** (_LEVELS - 2)) or 1.0
        extent = F.col(f"b{k}") - F.col(f"a{k}")
        size = F.ceil(F.log2(F.greatest(extent / width[k], F.lit(1.0)))).cast("int")
        level = F.greatest(level, F.when(extent.isNull(), F.lit(_LEVELS)).otherwise(size))  # an open range needs the cell of everything
    boxes = stage(slim.withColumn("own", level), "boxes")
    used = sorted(r[0] for r in boxes.select("own").distinct().collect())

    def in_cells(at: DataFrame) -> DataFrame:
        for k in dims:
            cell = lambda side: F.floor((F.col(f"{side}{k}") - F.lit(low[k])) / (F.lit(width[k]) * F.pow(F.lit(2.0), F.col("level"))))  # noqa: B023, E731
            cells = F.when(F.col("level") == _LEVELS, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(cell("a"), cell("b")))
            at = at.withColumn(f"c{k}", F.explode(cells))
        return at.drop(*[f"{x}{k}" for k in dims for x in "ab"])

    residents = in_cells(boxes.withColumn("level", F.col("own")))
    levels = F.filter(F.array(*[F.lit(u) for u in used]), lambda u: u >= F.col("own"))
    probes = in_cells(boxes.withColumn("level", F.explode(levels)))
    keys = [*[f"e{k}" for k in range(len(rule.equal))], "level", *[f"c{k}" for k in dims]]

    def met(left: DataFrame, right: DataFrame, more: Column) -> DataFrame:
        """Rows of ``left`` with an earlier one in ``right``, or any other, that conflicts."""
        other = right.select(*[F.col(c).alias(f"_{c}") for c in right.columns])
        on = [F.col(c) == F.col(f"_{c}") for c in keys]
        before, mine = F.struct(*[F.col(f"_{n}").alias(n) for n in names]), F.struct(*names)
        on.append(before != mine if either else before < mine)
        for k, (*_, bounds) in enumerate(rule.ranges):
            for a, b in ((f"s{k}", f"_t{k}"), (f"_s{k}", f"t{k}")):
                touch = F.col(a) <= F.col(b) if bounds == "[]" else F.col(a) < F.col(b)
                on.append(F.coalesce(touch, F.lit(True)))
        on += [F.col(f"d{k}") != F.col(f"_d{k}") for k in range(len(rule.differ))]
        return left.join(other, reduce(Column.__and__, [*on, more]), "left_semi").select(names)

    smaller = met(probes, residents, F.lit(True))
    larger = met(residents, probes, F.col("_own") < F.col("level"))
    return smaller.unionByName(larger).distinct()
