"""Target against current: one DataFrame per kind of difference.

Every key starts with ``db_id`` and goes down to the object, so one large
database is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.functions.joins import unmatched
from fleetschema.staging import stage

TABLE = ["db_id", "schema_name", "name"]
COLUMN_TABLE = ["db_id", "schema_name", "table_name"]
COLUMN = [*COLUMN_TABLE, "name"]


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


# ---- tables ---------------------------------------------------------------


def new_tables(target_tables: DataFrame, current_tables: DataFrame) -> DataFrame:
    """Target tables (not materialized views) that the database does not have."""
    return (
        target_tables.where("relkind = 'r'")
        .join(current_tables.select(TABLE), TABLE, "left_anti")
        .select(TABLE)
    )


def dropped_tables(current_tables: DataFrame, target_tables: DataFrame) -> DataFrame:
    """Current tables and materialized views that the target does not have."""
    return current_tables.join(target_tables.select(TABLE), TABLE, "left_anti").select(
        "db_id", "oid", "schema_name", "name", "relkind"
    )


def table_pairs(target_tables: DataFrame, current_tables: DataFrame) -> DataFrame:
    """Tables present on both sides: (db_id, table_oid of the target, current_oid)."""
    return target_tables.select(*TABLE, F.col("oid").alias("table_oid")).join(
        current_tables.select(*TABLE, F.col("oid").alias("current_oid")), TABLE
    ).select("db_id", "table_oid", "current_oid")


# ---- columns --------------------------------------------------------------


def columns_diff(target_columns: DataFrame, current_columns: DataFrame, new_tables: DataFrame) -> DataFrame:
    """All column differences; a column gives one row per operation it needs.

    One join of the two sides computes every operation, so each side is read and
    shuffled once.
    """
    cur = _prefixed(current_columns, COLUMN, "cur_")
    found = F.col("cur_table_oid").isNotNull()
    retyped = (F.col("type") != F.col("cur_type")) | (
        F.coalesce("length", F.lit(-1)) != F.coalesce("cur_length", F.lit(-1))
    )
    nullability = F.col("nullable") != F.col("cur_nullable")
    redefaulted = F.coalesce("default_expr", F.lit("")) != F.coalesce("cur_default_expr", F.lit(""))
    default = F.col("default_expr")
    operations = F.array(
        F.when(~found, "ADD_COLUMN"),
        F.when(found & retyped, "ALTER_TYPE"),
        F.when(found & nullability & F.col("cur_nullable"), "SET_NOT_NULL"),
        F.when(found & nullability & F.col("nullable"), "DROP_NOT_NULL"),
        F.when(found & redefaulted & default.isNull(), "DROP_DEFAULT"),
        F.when(found & redefaulted & default.isNotNull(), "SET_DEFAULT"),
    )
    flag = new_tables.select("db_id", "schema_name", F.col("name").alias("table_name")).distinct()
    return (
        target_columns.join(cur, COLUMN, "left")
        # exploding the empty places too keeps the stage in generated code, which a filter on the array would leave
        .select(*COLUMN, "type", "nullable", "length", "default_expr", F.explode(operations).alias("operation_type"))
        .where("operation_type IS NOT NULL")
        .join(flag.withColumn("new_table", F.lit(True)), COLUMN_TABLE, "left")
        .withColumn("new_table", F.coalesce("new_table", F.lit(False)))
        .select(*COLUMN, "type", "nullable", "length", "default_expr", "operation_type", "new_table")
    )


def dropped_columns(current_columns: DataFrame, target_columns: DataFrame, dropped_tables: DataFrame) -> DataFrame:
    """Current columns the target does not have, on tables that stay."""
    gone = dropped_tables.select("db_id", "schema_name", F.col("name").alias("table_name"))
    return (
        current_columns.join(target_columns.select(COLUMN), COLUMN, "left_anti")
        .join(gone, COLUMN_TABLE, "left_anti")
        .select(COLUMN)
    )


# ---- constraints and indexes ----------------------------------------------


def _owned_diff(target: DataFrame, pairs: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Objects of tables present on both sides, matched by table and name."""
    key = ["db_id", "current_oid", "name"]
    cur = current.select(
        "db_id",
        F.col("table_oid").alias("current_oid"),
        "name",
        F.col("oid").alias("cur_oid"),
        F.col("expression").alias("cur_expression"),
    )
    known = F.col("cur_oid").isNotNull()
    return (
        target.join(pairs, ["db_id", "table_oid"])
        .join(cur, key, "left")
        .select(
            "db_id",
            *columns,
            (~known).alias("is_new"),
            (known & ~F.col("expression").eqNullSafe(F.col("cur_expression"))).alias("is_changed"),
        )
    )


def constraints_diff(
    target_constraints: DataFrame, target_tables: DataFrame, current_tables: DataFrame, current_constraints: DataFrame
) -> DataFrame:
    """Target constraints of tables present on both sides, flagged new or changed."""
    pairs = table_pairs(target_tables, current_tables)
    return _owned_diff(
        target_constraints, pairs, current_constraints, ["oid", "table_oid", "name", "type", "expression"]
    )


def indexes_diff(
    target_indexes: DataFrame, target_tables: DataFrame, current_tables: DataFrame, current_indexes: DataFrame
) -> DataFrame:
    """Target indexes of tables present on both sides, flagged new or changed."""
    pairs = table_pairs(target_tables, current_tables)
    return _owned_diff(target_indexes, pairs, current_indexes, ["oid", "table_oid", "name", "expression"])


def _dropped_by_name(current: DataFrame, target: DataFrame, dropped_tables: DataFrame, columns: list[str]) -> DataFrame:
    # a name such as "pk" may occur on very many tables of either side
    gone = dropped_tables.select("db_id", F.col("oid").alias("table_oid"))
    return (
        unmatched(current, target, ["db_id", "name"])
        .join(gone, ["db_id", "table_oid"], "left_anti")
        .select("db_id", *columns)
    )


def dropped_constraints(
    current_constraints: DataFrame, target_constraints: DataFrame, dropped_tables: DataFrame
) -> DataFrame:
    """Current constraints whose name the target does not use, on tables that stay."""
    columns = ["oid", "name", "type", "table_oid", "expression"]
    return _dropped_by_name(current_constraints, target_constraints, dropped_tables, columns)


def dropped_indexes(current_indexes: DataFrame, target_indexes: DataFrame, dropped_tables: DataFrame) -> DataFrame:
    """Current indexes whose name the target does not use, on tables that stay."""
    return _dropped_by_name(current_indexes, target_indexes, dropped_tables, ["oid", "name", "table_oid", "expression"])


# ---- sequences and views --------------------------------------------------


def sequences_diff(target_sequences: DataFrame, current_sequences: DataFrame) -> DataFrame:
    """New or changed sequences. The start value is not compared; NULL on one side is no difference."""
    compared = ["min_value", "max_value", "increment", "cycles", "type"]
    cur = _prefixed(current_sequences, TABLE, "cur_")
    new = F.col("cur_oid").isNull()
    changed = F.coalesce(_any([F.col(c) != F.col(f"cur_{c}") for c in compared]), F.lit(False))
    return (
        target_sequences.join(cur, TABLE, "left")
        .where(new | changed)
        .select(*target_sequences.columns, new.alias("is_new"), (~new & changed).alias("is_changed"))
    )


def views_diff(target_views: DataFrame, current_views: DataFrame) -> DataFrame:
    """Target views that are new or whose text differs."""
    cur = _prefixed(current_views, TABLE, "cur_")
    new = F.col("cur_oid").isNull()
    changed = F.coalesce(F.col("expression") != F.col("cur_expression"), F.lit(False))
    return (
        target_views.join(cur, TABLE, "left")
        .where(new | changed)
        .select(*target_views.columns, new.alias("is_new"), (~new & changed).alias("is_changed"))
    )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


# ---- rows -----------------------------------------------------------------


def row_diff(
    target: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    null_equal: bool = True,
    unique_keys: bool = False,
    blocks: Sequence[int] | None = None,
) -> DataFrame:
    """Keyed compare of two tables: ADDED, REMOVED or CHANGED with the changed columns.

    Keys are meant to be unique on each side. Unless the caller knows that they
    are (``unique_keys``), rows are first combined per key, also before the
    shuffle, so a key found very often is one row per task and gives no pairs; it
    is reported once as DUPLICATE_KEY. Either way each side is shuffled once.
    ``null_equal=False`` compares as SQL does: NULL against a value is no change.
    A key with a NULL part matches nothing. Columns that only one side has cannot
    be compared: they are an error unless ``compare`` says what to compare.

    ``blocks`` is for sides that are mostly equal: only rows of blocks of keys that
    differ are shuffled (``differing_rows``), for one more scan of each side per
    level. A key that is repeated alike on both sides would not be seen so, hence
    it needs ``unique_keys``.
    """
    keys = list(keys)
    if compare is None and (one_sided := sorted(set(target.columns) ^ set(current.columns))):
        raise ValueError(f"columns of one side only: {', '.join(one_sided)}; name the columns to compare")
    compare = list(compare or [c for c in target.columns if c in current.columns and c not in keys])
    if blocks:
        if not unique_keys:
            raise ValueError("blocks need unique_keys")
        target, current = differing_rows(target.select(*keys, *compare), current.select(*keys, *compare), keys, blocks)
    no_columns = F.array().cast("array<string>")
    t, c = (_one_per_key(side, keys, compare, p, unique_keys) for side, p in ((target, "_t"), (current, "_c")))

    def differs(column: str) -> Column:
        a, b = F.col("_t")[column], F.col("_c")[column]
        return ~a.eqNullSafe(b) if null_equal else a != b

    in_t, in_c = F.col("_t_n").isNotNull(), F.col("_c_n").isNotNull()
    op = (
        F.when((F.col("_t_n") > 1) | (F.col("_c_n") > 1), "DUPLICATE_KEY")
        .when(~in_c, "ADDED")
        .when(~in_t, "REMOVED")
        .otherwise("CHANGED")
    )
    changed = F.array_compact(F.array(*[F.when(differs(col), F.lit(col)) for col in compare])) if compare else no_columns
    return (
        t.join(c, keys, "full_outer")
        .select(*keys, op.alias("op"), changed.alias("changed_columns"))
        .withColumn("changed_columns", F.when(F.col("op") == "CHANGED", F.col("changed_columns")).otherwise(no_columns))
        .where((F.col("op") != "CHANGED") | (F.size("changed_columns") > 0))
    )


def _one_per_key(side: DataFrame, keys: list[str], compare: list[str], prefix: str, unique: bool) -> DataFrame:
    """Key, row count ``<prefix>_n`` and the compared columns as the struct ``prefix``."""
    if unique:
        return side.select(*keys, F.lit(1).cast("long").alias(f"{prefix}_n"), F.struct(*compare, F.lit(1)).alias(prefix))
    return (
        side.groupBy(keys)
        .agg(F.count(F.lit(1)).alias(f"{prefix}_n"), *[F.first(c).alias(f"{prefix}_{i}") for i, c in enumerate(compare)])
        .select(*keys, f"{prefix}_n", F.struct(*[F.col(f"{prefix}_{i}").alias(c) for i, c in enumerate(compare)], F.lit(1)).alias(prefix))
    )


def differing_rows(
    target: DataFrame, current: DataFrame, keys: Sequence[str], blocks: Sequence[int] = (4096, 4096)
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose block of keys is not the same on both.

    Keys are dealt to blocks by their hash, and each level cuts the blocks that
    differed into more. A block is the same if both sides have as many rows in it and two
    digests agree: the exclusive or of a 64-bit hash of each row and the sum of
    another, neither of which depends on order. They are combined before the
    shuffle, one row for a block and task. Blocks that differ look the same with a
    chance of about 2^-128. Rows with a NULL key are always returned.
    """
    keys, within, total = list(keys), None, 1
    current = current.select(target.columns)
    for count in blocks:
        total *= count
        t, c = (_digests(side, keys, total, within, p) for side, p in ((target, "t"), (current, "c")))
        same = [F.col(f"t{k}").eqNullSafe(F.col(f"c{k}")) for k in range(3)]
        differ = t.join(c, "block", "full_outer").where(~(same[0] & same[1] & same[2])).select("block")
        within = (stage(differ, "differing-blocks"), total)
    return _within(target, keys, within), _within(current, keys, within)


def _block(keys: list[str], total: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(total))


def _within(side: DataFrame, keys: list[str], within: tuple[DataFrame, int] | None) -> DataFrame:
    if within is None:
        return side
    differ, total = within
    whole = side.dropna(subset=keys)
    found = whole.withColumn("__block", _block(keys, total)).join(differ.withColumnRenamed("block", "__block"), "__block", "left_semi")
    null = _any([F.col(k).isNull() for k in keys])
    return found.select(*side.columns).unionByName(side.where(null))


def _digests(side: DataFrame, keys: list[str], total: int, within: tuple[DataFrame, int] | None, prefix: str) -> DataFrame:
    rows = _within(side, keys, within).dropna(subset=keys)
    nulls = [F.col(c).isNull() for c in rows.columns if c not in keys]
    one, other = F.xxhash64(*rows.columns, *nulls), F.xxhash64(F.lit("other"), *nulls, *reversed(rows.columns))
    return rows.groupBy(_block(keys, total).alias("block")).agg(
        F.count(F.lit(1)).alias(f"{prefix}0"),
        F.bit_xor(one).alias(f"{prefix}1"),
        F.sum(other.cast("decimal(38,0)")).alias(f"{prefix}2"),
    )
