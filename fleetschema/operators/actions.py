"""Which rows deletes and key updates reach over foreign keys, by what the keys say to do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.operators.rows import named
from fleetschema.staging import stage

# What a catalog writes for an action.
NO_ACTION, RESTRICT, CASCADE, SET_NULL, SET_DEFAULT = "arcnd"
_EFFECTS = {SET_NULL: "SET_NULL", SET_DEFAULT: "SET_DEFAULT", CASCADE: "UPDATE"}
EFFECTS = "table_name string, key string, effect string, columns string, depth int"


@dataclass(frozen=True)
class ForeignKey:
    child: str
    cols: tuple[str, ...]
    parent: str
    ref_cols: tuple[str, ...]
    on_delete: str = NO_ACTION
    on_update: str = NO_ACTION


@dataclass(frozen=True)
class _Event:
    """Rows of a table that are deleted, or whose ``columns`` change."""

    table: str
    effect: str
    columns: tuple[str, ...]


def foreign_key_effects(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[ForeignKey],
    deleted: Mapping[str, DataFrame] | None = None,
    updated: Mapping[str, tuple[Sequence[str], DataFrame]] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """What happens to which row: (table_name, key, effect, columns, depth).

    ``keys`` name the columns that identify a row of each table; ``deleted`` has the keys of rows
    that go, ``updated`` columns of a table and the keys of rows in which they
    change. ``by`` (``db_id``, say) are columns that parent and child have in
    common besides a foreign key's.

    Rounds of semi joins take the rows met last to the rows that refer to them.
    DELETE goes on by ``c`` of on_delete; SET_NULL, SET_DEFAULT and UPDATE (``n``,
    ``d``, and ``c`` of on_update) change a foreign key's columns, which goes on
    to keys that refer to these. A row is met once for each effect on the same
    columns, so cycles and self references end. ``depth`` is the shortest way; rows of
    ``deleted`` and ``updated`` have 0. Rows that are deleted have no other effect.

    RESTRICTED rows stand against it: under ``a`` a row that refers to a changed
    one and is not deleted by any way, under ``r`` one that is not in ``deleted``
    itself. A foreign key with a NULL part refers to nothing. ``key`` is the JSON of
    the key's values. The driver holds the foreign keys; each round writes its rows.
    """
    spark = next(iter(tables.values())).sparkSession
    needed = {t: _needed(t, keys[t], foreign_keys, by) for t in tables}
    met: dict[_Event, list[DataFrame]] = {}
    frontier: dict[_Event, DataFrame] = {}
    for t, rows in (deleted or {}).items():
        frontier[_Event(t, "DELETE", ())] = _chosen(tables[t], rows, [*by, *keys[t]], needed[t])
    for t, (columns, rows) in (updated or {}).items():
        frontier[_Event(t, "UPDATE", tuple(columns))] = _chosen(tables[t], rows, [*by, *keys[t]], needed[t])
    first = {e.table: f for e, f in frontier.items() if e.effect == "DELETE"}
    blocked: list[tuple[ForeignKey, str, DataFrame]] = []
    depth = 0
    while frontier:
        for event, rows in frontier.items():
            met.setdefault(event, []).append(rows.withColumn("__depth", F.lit(depth)))
        found: dict[_Event, list[DataFrame]] = {}
        for event, rows in frontier.items():
            for fk in (k for k in foreign_keys if k.parent == event.table):
                if event.effect != "DELETE" and not set(fk.ref_cols) & set(event.columns):
                    continue
                action = fk.on_delete if event.effect == "DELETE" else fk.on_update
                children = _referring(tables[fk.child].select(*map(named, needed[fk.child])), rows, fk, by)
                if action in (NO_ACTION, RESTRICT):
                    blocked.append((fk, action, stage(children.withColumn("__depth", F.lit(depth + 1)), "restricting")))
                elif action == CASCADE and event.effect == "DELETE":
                    found.setdefault(_Event(fk.child, "DELETE", ()), []).append(children)
                else:
                    found.setdefault(_Event(fk.child, _EFFECTS[action], fk.cols), []).append(children)
        depth += 1
        frontier = {}
        for event, parts in found.items():
            fresh = reduce(DataFrame.unionByName, parts).distinct()
            before = met.get(event, [])
            row = [*by, *keys[event.table]]
            for seen in before:
                fresh = _without(fresh, seen, row)
            fresh = stage(fresh, "reached-rows")
            if not fresh.isEmpty():
                frontier[event] = fresh

    gone = {e.table: reduce(DataFrame.unionByName, parts) for e, parts in met.items() if e.effect == "DELETE"}
    out = []
    for event, parts in met.items():
        rows = reduce(DataFrame.unionByName, parts)
        if event.effect != "DELETE" and event.table in gone:
            rows = _without(rows, gone[event.table], [*by, *keys[event.table]])
        out.append(_listed(rows, event.table, [*by, *keys[event.table]], event.effect, event.columns))
    for fk, action, rows in blocked:
        excused = gone if action == NO_ACTION else first
        if fk.child in excused:
            rows = _without(rows, excused[fk.child], [*by, *keys[fk.child]])
        out.append(_listed(rows, fk.child, [*by, *keys[fk.child]], "RESTRICTED", fk.cols))
    if not out:
        return spark.createDataFrame([], EFFECTS)
    listed = reduce(DataFrame.unionByName, out)
    return listed.groupBy("table_name", "key", "effect", "columns").agg(F.min("depth").alias("depth"))


def _needed(table: str, key: Sequence[str], foreign_keys: Sequence[ForeignKey], by: Sequence[str]) -> list[str]:
    """Of a table only its key and what foreign keys of either end name."""
    own = [c for k in foreign_keys if k.child == table for c in k.cols]
    named_ = [c for k in foreign_keys if k.parent == table for c in k.ref_cols]
    return list(dict.fromkeys([*by, *key, *own, *named_]))


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    pairs = [(named(a), F.col(b)) for a, b in zip(left, right)]
    return reduce(Column.__and__, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _chosen(table: DataFrame, wanted: DataFrame, row: Sequence[str], needed: Sequence[str]) -> DataFrame:
    marks = wanted.select(*[named(c).alias(f"__k{i}") for i, c in enumerate(row)])
    return stage(table.select(*map(named, needed)).join(marks, _same(row, marks.columns, False), "left_semi"), "first-rows")


def _referring(child: DataFrame, parents: DataFrame, fk: ForeignKey, by: Sequence[str]) -> DataFrame:
    """Read directly from the child's shuffle, so a parent with very many children is split."""
    ref = parents.select(*[named(c).alias(f"__k{i}") for i, c in enumerate([*by, *fk.ref_cols])])
    return child.join(ref, _same([*by, *fk.cols], ref.columns, False), "left_semi")


def _without(rows: DataFrame, others: DataFrame, row: Sequence[str]) -> DataFrame:
    gone = others.select(*[named(c).alias(f"__k{i}") for i, c in enumerate(row)])
    return rows.join(gone, _same(row, gone.columns, True), "left_anti")


def _listed(rows: DataFrame, table: str, row: Sequence[str], effect: str, columns: Sequence[str]) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"),
        F.to_json(F.struct(*map(named, row))).alias("key"),
        F.lit(effect).alias("effect"),
        F.lit(",".join(columns)).alias("columns"),
        F.col("__depth").alias("depth"),
    )
