"""Row work on one table of all databases of a fleet at once; the rows are keyed by ``db_id``."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.functions.text import declared_chars, spark_type
from fleetschema.operators.rows import converted, default_value, named, not_castable, truncated
from fleetschema.staging import stage

_CLASS = "__class"
_CHANGE = ["name", "operation_type", "type", "length", "nullable", "default_expr"]


def signature_classes(
    columns_diff: DataFrame, schema: str, table: str, max_classes: int = 256
) -> tuple[DataFrame, list[list[dict]]]:
    """Databases that need the same changes in a table: (db_id, class), and the changes of each class.

    The ordered differences of a database are hashed (SHA-256), and databases with
    one hash are a class, numbered from 0. A database without a difference is in
    none. A database has at most 1,600 columns, PostgreSQL's limit; the driver
    holds one list of changes for each class, and more than ``max_classes`` of
    them are an error.
    """
    mine = columns_diff.where((F.col("schema_name") == schema) & (F.col("table_name") == table))
    listed = mine.groupBy("db_id").agg(F.array_sort(F.collect_set(F.struct(*_CHANGE))).alias("changes"))
    listed = stage(listed.withColumn("signature", F.sha2(F.to_json("changes"), 256)), "signatures")
    distinct = listed.groupBy("signature").agg(F.first("changes").alias("changes")).limit(max_classes + 1).collect()
    if len(distinct) > max_classes:
        raise ValueError(f"databases differ from the target in over {max_classes} ways in {schema}.{table}")
    distinct.sort(key=lambda r: r["signature"])
    numbers = mine.sparkSession.createDataFrame(
        [(r["signature"], k) for k, r in enumerate(distinct)], f"signature string, {_CLASS} int"
    )
    return listed.join(numbers, "signature").select("db_id", _CLASS), [[c.asDict() for c in r["changes"]] for r in distinct]


def _any_of(classes: Sequence[int]) -> Column:
    return F.coalesce(F.col(_CLASS).isin(*classes), F.lit(False))


class _Change:
    """What the classes do to one column."""

    def __init__(self, name: str):
        self.name = name
        self.retyped: dict[tuple, list[int]] = defaultdict(list)  # by (type, length)
        self.added: dict[tuple, list[int]] = defaultdict(list)  # by (type, length, default)
        self.required: list[int] = []

    def type_(self) -> tuple[str, int | None] | None:
        """The type that all rows have in the end, if a class says one."""
        said = [*self.retyped, *(k[:2] for k in self.added)]
        if len({spark_type(*k).simpleString() for k in said}) > 1:
            raise ValueError(f"databases differ in the target type of {self.name}: {sorted({k[0] for k in said})}")
        # without a length, which only cuts the rows of its own classes
        return (said[0][0], said[0][1] if declared_chars(*said[0]) is None else None) if said else None

    def value(self, there: bool, on_error: str) -> Column:
        whole = self.type_()
        if whole is None:
            return named(self.name)
        kept = converted(self.name, *whole, on_error) if there else F.lit(None).cast(spark_type(*whole))
        steps = [(ks, default_value(default, type_, length)) for (type_, length, default), ks in self.added.items()]
        if there:
            steps += [(ks, converted(self.name, *k, on_error)) for k, ks in self.retyped.items()]
        return reduce(lambda rest, step: F.when(_any_of(step[0]), step[1]).otherwise(rest), steps, kept)

    def flags(self, there: bool) -> dict[tuple[str, str], Column]:
        out, whole = {}, self.type_()
        new = [k for ks in self.added.values() for k in ks]
        if there and whole is not None:
            out[self.name, "NOT_CASTABLE"] = ~_any_of(new) & not_castable(self.name, *whole)
            cut = [_any_of(ks) & truncated(self.name, *k) for k, ks in self.retyped.items() if declared_chars(*k) is not None]
            if cut:
                out[self.name, "TRUNCATED"] = reduce(Column.__or__, cut)
        if self.required:
            out[self.name, "IS_NULL"] = _any_of(self.required) & self.value(there, "null").isNull()
        return out


def _changes(classes: list[list[dict]]) -> dict[str, _Change]:
    out: dict[str, _Change] = {}
    for k, changes in enumerate(classes):
        for c in changes:
            change = out.setdefault(c["name"], _Change(c["name"]))
            if c["operation_type"] == "ADD_COLUMN":
                change.added[c["type"], c["length"], c["default_expr"]].append(k)
            elif c["operation_type"] == "ALTER_TYPE":
                change.retyped[c["type"], c["length"]].append(k)
            elif c["operation_type"] != "SET_NOT_NULL":
                continue
            if (c["operation_type"] == "SET_NOT_NULL" or not c["nullable"]) and k not in change.required:
                change.required.append(k)
    return out


def conform_fleet(
    df: DataFrame, columns_diff: DataFrame, schema: str, table: str, on_error: str = "fail", max_classes: int = 256
) -> tuple[DataFrame, DataFrame]:
    """Applies every database's column differences of one table to the rows of all databases.

    ``df`` has ``db_id`` and every column that any database has; where a database
    lacks one its rows hold NULL, and where a column's type differs between
    databases ``df`` has one that holds all. Returns the conformed frame (the
    columns of ``df``, then those that only the target has, by name) and the
    violations (db_id, column_name, violation, n) of ``conform_table``. A column
    that any class retypes or adds has one type in the end, so rows of databases
    that have it already are read as that type too, and counted where they do not
    convert. Lengths, NOT NULL and defaults hold for the databases whose difference
    says so. Targets that differ in a column's type are an error.

    Databases are taken by ``signature_classes``, so a projection has one branch
    for each distinct change of a column however many databases there are, all
    rows are read once for it, and once for the violations. A value that does not convert is
    an error unless ``on_error`` is ``"null"``. Rows without a ``db_id``, or of a
    database without a difference, have no class. An empty frame gives no rows.
    """
    members, classes = signature_classes(columns_diff, schema, table, max_classes)
    changes = _changes(classes)
    # a database has one row here, so a hot one is split by adaptive execution
    rows = df.join(members, "db_id", "left")
    kept = [changes[c].value(True, on_error).alias(c) if c in changes else named(c) for c in df.columns]
    new = sorted(c for c, x in changes.items() if x.added and c not in df.columns)
    missing = sorted(c for c, x in changes.items() if c not in df.columns and not x.added)
    if missing:
        raise ValueError(f"the rows lack {missing}, which the differences change")
    conformed = rows.select(*kept, *[changes[c].value(False, on_error).alias(c) for c in new])

    flags = {k: v for c, x in sorted(changes.items()) for k, v in x.flags(c in df.columns).items()}
    if not flags:
        key = df.schema["db_id"].dataType.simpleString()
        return conformed, df.sparkSession.createDataFrame([], f"db_id {key}, column_name string, violation string, n long")
    counted = rows.groupBy("db_id").agg(*[F.count_if(v).alias(f"_{i}") for i, v in enumerate(flags.values())])
    listed = [
        F.struct(F.lit(c).alias("column_name"), F.lit(v).alias("violation"), F.col(f"_{i}").alias("n"))
        for i, (c, v) in enumerate(flags)
    ]
    return conformed, counted.select("db_id", F.inline(F.array(*listed))).where("n > 0")
