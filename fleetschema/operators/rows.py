"""Work on table rows: conform them to the target, and check the rules they have to meet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetschema.functions.ordering import block_starts, sorted_blocks
from fleetschema.functions.text import declared_chars, spark_expression, spark_type
from fleetschema.staging import stage


def named(column: str) -> Column:
    """The column of exactly this name; a dot in it is no field access.

    Names that differ in case only need ``spark.sql.caseSensitive``, as everywhere in Spark.
    """
    return F.col("`" + column.replace("`", "``") + "`")


# ---- columns --------------------------------------------------------------


def default_value(default_expr: str | None, type_: str, length: int | None = None) -> Column:
    """The default, as a catalog writes it, as a column of the given type; no text, or empty text, is NULL."""
    value = F.expr(spark_expression(default_expr)) if default_expr else F.lit(None)
    return _cut(value.cast(spark_type(type_, length)), type_, length)


def _cut(value: Column, type_: str, length: int | None) -> Column:
    n = declared_chars(type_, length)
    return value if n is None else F.substring(value, 1, n)


def truncated(col: str, type_: str, length: int | None) -> Column:
    """Whether the declared length cuts the value."""
    n = declared_chars(type_, length)
    return F.lit(False) if n is None else F.coalesce(F.char_length(named(col).cast("string")) > n, F.lit(False))


def add_columns(df: DataFrame, columns: Sequence[dict]) -> DataFrame:
    """Adds missing columns; existing rows get the default, else NULL.

    ``columns`` holds rows of ``columns_diff`` of one table, as dicts.
    """
    return df.withColumns({c["name"]: default_value(c["default_expr"], c["type"], c["length"]) for c in columns})


def converted(col: str, type_: str, length: int | None, on_error: str) -> Column:
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    target = spark_type(type_, length)
    value = named(col).cast(target) if on_error == "fail" else named(col).try_cast(target)
    return _cut(value, type_, length)


def not_castable(col: str, type_: str, length: int | None) -> Column:
    return named(col).isNotNull() & named(col).try_cast(spark_type(type_, length)).isNull()


def rewrite_column_type(
    df: DataFrame, col: str, type_: str, length: int | None = None, on_error: str = "fail", by: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The frame with ``col`` converted in place, and what that loses (per ``by``).

    The second frame counts the values that do not convert (``n``) and those that
    the declared length shortens (``n_truncated``), as an explicit cast does.
    """
    failures = df.groupBy(*map(named, by)).agg(
        F.count_if(not_castable(col, type_, length)).alias("n"),
        F.count_if(truncated(col, type_, length)).alias("n_truncated"),
    )
    return df.withColumn(col, converted(col, type_, length, on_error)), failures


def conform_table(
    df: DataFrame, columns_diff: DataFrame, db_id: int, schema: str, table: str, on_error: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """Applies all column differences of one table to its rows in one projection.

    Returns the conformed frame and the violations (column_name, violation, n):
    values that do not convert, values that a declared length shortens, and NULLs
    in columns that become NOT NULL. A value that does not convert is an error
    when the frame is computed; only ``on_error="null"`` makes it NULL, and then the
    violations have to be read before the frame is used.
    Defaults and relaxed nullability change no row. The collected difference
    holds at most 1,600 columns, PostgreSQL's limit for a table.
    """
    mine = (
        (F.col("db_id") == db_id) & (F.col("schema_name") == schema) & (F.col("table_name") == table)
    )
    changes = sorted(
        (r.asDict() for r in columns_diff.where(mine).collect()), key=lambda r: (r["name"], r["operation_type"])
    )
    added = [r for r in changes if r["operation_type"] == "ADD_COLUMN"]
    retyped = {r["name"]: r for r in changes if r["operation_type"] == "ALTER_TYPE"}
    required = sorted(
        {r["name"] for r in changes if r["operation_type"] == "SET_NOT_NULL"}
        | {r["name"] for r in [*added, *retyped.values()] if not r["nullable"]}
    )
    projection = [
        converted(c, retyped[c]["type"], retyped[c]["length"], on_error).alias(c) if c in retyped else named(c)
        for c in df.columns
    ] + [default_value(r["default_expr"], r["type"], r["length"]).alias(r["name"]) for r in added]
    conformed = df.select(*projection)

    flags = {(c, "NOT_CASTABLE"): not_castable(c, r["type"], r["length"]) for c, r in retyped.items()}
    flags |= {
        (c, "TRUNCATED"): truncated(c, r["type"], r["length"])
        for c, r in retyped.items()
        if declared_chars(r["type"], r["length"]) is not None
    }
    new = {r["name"]: r for r in added}
    for c in required:
        if c in new:
            value = default_value(new[c]["default_expr"], new[c]["type"], new[c]["length"])
        elif c in retyped:
            value = named(c).try_cast(spark_type(retyped[c]["type"], retyped[c]["length"]))
        else:
            value = named(c)
        flags[(c, "IS_NULL")] = value.isNull()
    return conformed, _flag_counts(df, flags)


def _flag_counts(df: DataFrame, flags: dict[tuple[str, str], Column]) -> DataFrame:
    """One pass over the rows; one output row per flag that was raised."""
    if not flags:
        return df.sparkSession.createDataFrame([], "column_name string, violation string, n long")
    counted = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(flags.values())])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(v).alias("violation"), F.col(f"_{i}").alias("n"))
        for i, (c, v) in enumerate(flags)
    ]
    return counted.select(F.inline(F.array(*rows))).where("n > 0")


# ---- validation -----------------------------------------------------------


def validate_not_null(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and NULL count of every column, in one pass."""
    return df.groupBy(*map(named, by)).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(named(c).isNull()).alias(f"null_{c}") for c in cols]
    )


def validate_unique(df: DataFrame, cols: Sequence[str], primary: bool = False) -> DataFrame:
    """Keys that break PRIMARY KEY or UNIQUE, with their row count ``n``.

    A key with a NULL part is no duplicate; a primary key does not allow it at all.
    Counts are combined before the shuffle, so a frequent key costs one row per task.
    """
    keys = [named(c) for c in cols]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = reduce(Column.__or__, [k.isNull() for k in keys])
    return counted.where((F.col("n") > 1) | has_null if primary else (F.col("n") > 1) & ~has_null)


def validate_foreign_key(
    child: DataFrame, parent: DataFrame, cols: Sequence[str], ref_cols: Sequence[str]
) -> DataFrame:
    """Child rows whose key has no parent; a key with a NULL part passes.

    The child is read and shuffled once; a key that very many child rows share is
    split by adaptive execution, since a referenced key is unique.
    """
    complete = reduce(Column.__and__, [named(c).isNotNull() for c in cols])
    keys = _parent_keys(parent, ref_cols)
    return child.where(complete).join(keys, _matches(cols), "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, cols: Sequence[str], ref_cols: Sequence[str]) -> DataFrame:
    """Distinct child keys without a parent and their row count ``n``, counted before the shuffle."""
    complete = reduce(Column.__and__, [named(c).isNotNull() for c in cols])
    keys = child.where(complete).groupBy(*map(named, cols)).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(_parent_keys(parent, ref_cols), _matches(cols), "left_anti")


def _parent_keys(parent: DataFrame, ref_cols: Sequence[str]) -> DataFrame:
    return parent.select(*[named(r).alias(f"_ref_{k}") for k, r in enumerate(ref_cols)])


def _matches(cols: Sequence[str]) -> Column:
    return reduce(Column.__and__, [named(c) == F.col(f"_ref_{k}") for k, c in enumerate(cols)])


def validate_check(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the check, as a catalog writes it, is FALSE; NULL passes."""
    return df.where(~F.expr(spark_expression(expression)))


def validate_exclusion(
    df: DataFrame, keys: Sequence[str], start: str, end: str, tiebreak: Sequence[str]
) -> DataFrame:
    """Rows whose interval [start, end) overlaps an earlier one of the same key.

    A running maximum of ``end`` finds them without forming pairs. (keys, start,
    tiebreak) identifies a row. A key is cut into blocks of its sorted rows; each
    block takes over the maximum of the blocks before it, which is at most one row
    per block, since only the first key of a block can go on from an earlier one.
    A NULL start or end is an open bound; rows with a NULL key pass.
    """
    keys, row = list(keys), [*keys, start, *tiebreak]
    order = [F.col(start).asc_nulls_first(), *[F.col(c).asc() for c in tiebreak]]
    # only what the comparison needs is sorted and written; the rows are fetched in the end
    placed = sorted_blocks(df.select(*dict.fromkeys([*row, end])).dropna(subset=keys), order, keys)

    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    block_end = placed.groupBy(*keys, "_block").agg(
        F.max(end).alias("_end"), F.bool_or(F.col(end).isNull()).alias("_open")
    )
    carried = stage(
        block_end.select(
            *keys, "_block", F.max("_end").over(before).alias("_carried"), F.bool_or("_open").over(before).alias("_carried_open")
        ).where(F.col("_carried_open").isNotNull()),
        "carried-ends",
    )
    local = Window.partitionBy("_block", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.greatest(F.max(end).over(local), F.col("_carried"))
    earlier_open = F.coalesce(F.bool_or(F.col(end).isNull()).over(local), F.lit(False)) | F.coalesce("_carried_open", F.lit(False))
    begins = F.row_number().over(Window.partitionBy("_block", *keys).orderBy("_pos")) == 1
    overlaps = (
        earlier_open
        | (earlier > F.col(start))
        | (F.col(start).isNull() & (~begins | F.col("_carried_open").isNotNull()))
    )
    found = placed.join(carried, [*keys, "_block"], "left").withColumn("_overlaps", overlaps).where("_overlaps")
    found = stage(found.select(*[F.col(c).alias(f"_row_{k}") for k, c in enumerate(row)]), "overlapping")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_row_{k}")) for k, c in enumerate(row)])
    return df.join(found, same, "left_semi")


def constraint_violations(
    s: Mapping[str, DataFrame], db_id: int, tables: Mapping[tuple[str, str], DataFrame], side: str = "target"
) -> DataFrame:
    """How often the rows of some tables break the constraints of a snapshot: (schema_name, table_name, name, type, n).

    ``tables`` has the rows of the database's tables by (schema, name). Primary,
    unique and foreign keys are found by the column numbers of the snapshot, checks
    by their text. ``n`` counts broken keys of p and u, rows of f and c. An
    exclusion constraint says in its operators what overlaps; it is listed with
    ``n`` NULL, to be checked by ``validate_exclusion``, and so is a foreign key
    to a table that is not given. The driver holds the constraints and column names of the tables given.
    """
    named_tables = s[f"{side}_tables"].where(F.col("db_id") == db_id).select("oid", "schema_name", "name")
    wanted = reduce(
        Column.__or__, [(F.col("schema_name") == a) & (F.col("name") == b) for a, b in tables], F.lit(False)
    )
    oids = {r["oid"]: (r["schema_name"], r["name"]) for r in named_tables.where(wanted).collect()}
    mine = (F.col("db_id") == db_id) & F.col("table_oid").isin(*oids)
    numbered_ = {(r["table_oid"], r["attnum"]): r["name"] for r in s[f"{side}_columns"].where(mine).collect()}
    found = []
    for c in sorted(s[f"{side}_constraints"].where(mine).collect(), key=lambda c: c["oid"]):
        rows, parent = tables[oids[c["table_oid"]]], oids.get(c["ref_table_oid"])
        cols = [numbered_[c["table_oid"], k] for k in c["cols"] or ()]
        if c["type"] in ("p", "u"):
            broken = validate_unique(rows, cols, primary=c["type"] == "p")
        elif c["type"] == "c":
            broken = validate_check(rows, c["expression"])
        elif c["type"] == "f" and parent:
            broken = validate_foreign_key(rows, tables[parent], cols, [numbered_[c["ref_table_oid"], k] for k in c["ref_cols"]])
        else:
            broken = None
        n = F.lit(None).cast("long") if broken is None else F.count(F.lit(1))
        source = named_tables.sparkSession.range(1) if broken is None else broken
        schema, table = oids[c["table_oid"]]
        head = [F.lit(v).alias(k) for k, v in (("schema_name", schema), ("table_name", table), ("name", c["name"]), ("type", c["type"]))]
        found.append(source.agg(F.max(n).alias("n") if broken is None else n.alias("n")).select(*head, "n"))
    shape = "schema_name string, table_name string, name string, type string, n long"
    return reduce(DataFrame.unionByName, found) if found else named_tables.sparkSession.createDataFrame([], shape)


# ---- sequence numbers and views -------------------------------------------

_LONGEST = 2**63 - 1


def assign_sequence(
    df: DataFrame,
    order_by: Sequence[str],
    start: int | None = None,
    increment: int = 1,
    min_value: int | None = None,
    max_value: int | None = None,
    cycle: bool = False,
    name: str = "id",
) -> DataFrame:
    """Gives rows the values of a sequence in the order of ``order_by``, which identifies a row.

    After its last value a cycling sequence goes on from its other bound
    (``min_value`` when it counts up); any other sequence is exhausted, an error.
    Bounds and start not given are those of a bigint sequence.
    """
    if increment == 0:
        raise ValueError("increment must not be 0")
    if min_value is None:
        min_value = 1 if increment > 0 else -(2**63)
    if max_value is None:
        max_value = _LONGEST if increment > 0 else -1
    last, restart = (max_value, min_value) if increment > 0 else (min_value, max_value)
    start = restart if start is None else start
    if not min_value <= start <= max_value:
        raise ValueError("start is outside the bounds")
    first_lap = min((last - start) // increment + 1, _LONGEST)
    lap = min((last - restart) // increment + 1, _LONGEST)

    placed = sorted_blocks(df, [F.col(c).asc() for c in order_by])
    starts = block_starts(placed)
    if not cycle:
        total = starts.agg(F.sum("_rows")).first()[0] or 0
        if total > first_lap:
            raise ValueError(f"{total} rows need more than the {first_lap} values of the sequence")
    n = F.col("_pos") - F.col("_first") + F.col("_before")  # counts from 0
    value = F.lit(start) + n * F.lit(increment)
    if cycle:
        again = F.lit(restart) + F.pmod(n - F.lit(first_lap), F.lit(lap)) * F.lit(increment)
        value = F.when(n < F.lit(first_lap), value).otherwise(again)
    return placed.join(starts, "_block").select(*df.columns, value.cast("long").alias(name))


def rebuild_views(
    spark: SparkSession,
    order: DataFrame,
    target_views: DataFrame,
    out_path: str,
    tables: Mapping[int, Mapping[str, DataFrame]],
    jobs: int = 8,
) -> DataFrame:
    """Recomputes the views of some databases, base views first, and writes the materialized ones.

    ``order`` comes from ``recreation_order`` over the oids of ``target_views``;
    ``tables`` has for each database the tables that its views may read, by
    ``schema.name`` or bare name. View text is Spark SQL; what it reads is found by
    the session's parser, wherever a table may stand, and a bare name means the
    view's own schema first. Views of one level do not read each other and are
    submitted together, those of all databases at once. Nothing stays in the session.

    Returns (db_id, schema_name, name, level, status, path) for every view of the
    order: REBUILT, or IN_CYCLE for those in or behind a cycle, which are not
    built. ``path`` is that of a materialized view, ``out_path/db_id/schema/name``.
    The driver holds the definitions of a level at a time; rows stay on the executors.
    """
    wanted = order.where(F.col("db_id").isin(*tables)).join(target_views, ["db_id", "oid"])
    wanted = wanted.select("db_id", "level", "oid", "schema_name", "name", "expression", "is_materialized", "in_cycle")
    wanted = stage(wanted, "views-to-build")
    known: dict[int, dict[str, DataFrame]] = {db: dict(of) for db, of in tables.items()}

    def build(view: Row) -> tuple[DataFrame, str | None]:
        frames: dict[str, DataFrame] = {}
        rows = spark.sql(_with_frames(spark, view["expression"], view["schema_name"], known[view["db_id"]], frames), **frames)
        if not view["is_materialized"]:
            return rows, None
        path = f"{out_path}/{view['db_id']}/{view['schema_name']}/{view['name']}"
        rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(rows.schema).parquet(path), path

    done = []
    with ThreadPoolExecutor(jobs) as pool:
        for level in sorted(r["level"] for r in wanted.where("NOT in_cycle").select("level").distinct().collect()):
            views = sorted(wanted.where((F.col("level") == level) & ~F.col("in_cycle")).collect(), key=lambda v: (v["db_id"], v["oid"]))
            for view, (rows, path) in zip(views, list(pool.map(build, views)), strict=True):
                known[view["db_id"]][f"{view['schema_name']}.{view['name']}"] = rows
                done.append((view["db_id"], view["schema_name"], view["name"], level, "REBUILT", path))
    waiting = wanted.where("in_cycle").select("db_id", "schema_name", "name", "level").collect()
    done += [(*v, "IN_CYCLE", None) for v in sorted(waiting)]
    return spark.createDataFrame(done, "db_id int, schema_name string, name string, level int, status string, path string")


def _relations(spark: SparkSession, text: str) -> list[tuple[int, int, list[str], bool]]:
    """The tables that a query names, by the session's own parser: (start, stop, name, whether it has an alias).

    Names of its WITH clauses are left out where they stand for these: in the query
    behind the clause and in the clause's later parts (in a recursive one everywhere).
    """
    found: list[tuple[int, int, list[str], bool]] = []
    items = lambda seq: [seq.apply(k) for k in range(seq.size())]

    def visit(plan, hidden: frozenset[str], aliased: bool = False) -> None:
        kind = plan.getClass().getSimpleName()
        if kind == "UnresolvedRelation":
            name = items(plan.multipartIdentifier())
            if len(name) > 1 or name[0].lower() not in hidden:
                found.append((plan.origin().startIndex().get(), plan.origin().stopIndex().get(), name, aliased))
        if kind == "UnresolvedWith":
            parts = [(p._1(), p._2()) for p in items(plan.cteRelations())]
            own = frozenset(n.lower() for n, _ in parts)
            scope = hidden | own if plan.allowRecursion() else hidden
            for name, part in parts:
                visit(part, scope)
                scope |= {name.lower()}
            hidden |= own
        for child in [*items(plan.children()), *items(plan.subqueries())]:
            visit(child, hidden, kind == "SubqueryAlias")

    visit(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), frozenset())
    return sorted(found, key=lambda r: r[:2])


def _with_frames(
    spark: SparkSession, text: str, schema: str, known: Mapping[str, DataFrame], frames: dict[str, DataFrame]
) -> str:
    """``text`` with a placeholder for every known view or table that it reads; ``frames`` gets what they stand for.

    A bare name means the view's own schema first. Names differ by case only where
    the known ones do.
    """
    folded = {k.lower(): k for k in known}
    out, at = [], 0
    plain = lambda part: part.replace("{", "{{").replace("}", "}}")
    for start, stop, name, aliased in _relations(spark, text):
        tries = [f"{schema}.{name[0]}", name[0]] if len(name) == 1 else [".".join(name)]
        key = next((k for k in tries if k in known), None) or next((folded[k.lower()] for k in tries if k.lower() in folded), None)
        if key is None:
            continue
        frames[slot := f"frame{len(frames)}"] = known[key]
        alias = "" if aliased else " AS `" + name[-1].replace("`", "``") + "`"
        out += [plain(text[at:start]), f"{{{slot}}}", plain(alias)]
        at = stop + 1
    return "".join([*out, plain(text[at:])])
