"""The ordered worklist: one row per change, numbered per database and phase.

Each ``plan_*`` function is one rule and returns rows of the shape ``RULE_ROW``; the
drop rules 2 to 8 return names, which ``queue_drops`` turns into rows, one per
object. ``number_worklist`` numbers the rows of all rules. ``ord_*`` columns hold
the order inside a rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.functions.ordering import numbered
from fleetschema.functions.text import qualified, quote_ident, render_type, text, type_text
from fleetschema.operators.diff import COLUMN_TABLE, TABLE

WORKLIST = [
    "db_id",
    "phase",
    "seq",
    "object_type",
    "ddl_operation",
    "schema_name",
    "table_name",
    "object_name",
    "ddl",
    "is_temporary_drop",
    "status",
]
ORDER = ["ord_level", "ord_1", "ord_2", "ord_3", "ord_oid"]
RULE_ROW = ["rule", *[c for c in WORKLIST if c != "seq"], *ORDER]
OWNER = ["db_id", "schema_name", "table_name", "name"]


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _rows(
    df: DataFrame,
    rule: int | Column,
    phase: int,
    object_type: str | Column,
    operation: str,
    ddl: Column,
    *,
    object_name: str | None = "name",
    table_name: str | None = None,
    order: Sequence[str | Column] = (),
    level: Column | None = None,
    oid: Column | None = None,
    temporary: bool | Column = False,
) -> DataFrame:
    def column(value, missing=None):
        if value is None:
            return _no_text() if missing is None else missing
        return F.col(value) if isinstance(value, str) else value

    keys = [column(c) for c in order] + [_no_text()] * (3 - len(order))
    kind = F.lit(object_type) if isinstance(object_type, str) else object_type
    return df.select(
        F.lit(rule).alias("rule"),
        "db_id",
        F.lit(phase).alias("phase"),
        kind.alias("object_type"),
        F.lit(operation).alias("ddl_operation"),
        "schema_name",
        column(table_name).alias("table_name"),
        column(object_name).alias("object_name"),
        ddl.alias("ddl"),
        F.lit(temporary).alias("is_temporary_drop"),
        F.lit("PENDING").alias("status"),
        column(level, F.lit(0)).cast("int").alias("ord_level"),
        *[k.alias(f"ord_{i}") for i, k in enumerate(keys, 1)],
        column(oid, F.lit(0)).cast("long").alias("ord_oid"),
    )


def on_table(objects: DataFrame, tables: DataFrame, some: bool = False) -> DataFrame:
    """Constraints or indexes with the schema and name of their table.

    Objects that have both already are not joined again, except with ``some`` of
    the tables, which picks those on them.
    """
    named = tables.select("db_id", F.col("oid").alias("table_oid"), "schema_name", F.col("name").alias("table_name"))
    if "table_name" not in objects.columns:
        return objects.join(named, ["db_id", "table_oid"])
    return objects.join(named.select("db_id", "table_oid"), ["db_id", "table_oid"], "left_semi") if some else objects


def _table() -> Column:
    return qualified("schema_name", "table_name")


def _object() -> Column:
    return qualified("schema_name", "name")


# ---- phase 1: drop dependent objects --------------------------------------


def _view_kind() -> Column:
    return F.when(F.col("is_materialized"), "MATERIALIZED VIEW").otherwise("VIEW")


def plan_drop_views(affected_views: DataFrame) -> DataFrame:
    ddl = text("DROP ", _view_kind(), " IF EXISTS ", _object(), " CASCADE;")
    first = F.when(F.col("is_materialized"), 0).otherwise(1)
    return _rows(
        affected_views, 1, 1, _view_kind(), "DROP", ddl, order=("schema_name", "name"), level=first, temporary=True
    )


_BY_NAME = ("name", "schema_name", "table_name")
_BY_TABLE = ("schema_name", "table_name", "name")
DROPPED = ["db_id", "object_type", "schema_name", "table_name", "object_name"]


def _candidates(df: DataFrame, rule: int, object_type: str) -> DataFrame:
    """Objects that a drop rule asks for, as names only; ``queue_drops`` makes rows of them."""
    table = F.col("table_name") if object_type == "CONSTRAINT" else _no_text()
    return df.select(
        "db_id",
        F.lit(object_type).alias("object_type"),
        "schema_name",
        table.alias("table_name"),
        F.col("name").alias("object_name"),
        F.lit(rule).alias("rule"),
    )


def plan_drop_removed_fks(dropped_constraints: DataFrame, current_tables: DataFrame) -> DataFrame:
    return _candidates(on_table(dropped_constraints.where("type = 'f'"), current_tables), 2, "CONSTRAINT")


def plan_drop_fks_to_altered(
    current_constraints: DataFrame, current_tables: DataFrame, altered: DataFrame
) -> DataFrame:
    referenced = altered.select("db_id", F.col("oid").alias("ref_table_oid"))
    fks = current_constraints.where("type = 'f'").join(referenced, ["db_id", "ref_table_oid"], "left_semi")
    return _candidates(on_table(fks, current_tables), 3, "CONSTRAINT")


def plan_drop_pks(current_constraints: DataFrame, altered: DataFrame) -> DataFrame:
    return _candidates(on_table(current_constraints.where("type = 'p'"), altered, some=True), 4, "CONSTRAINT")


def _index_backed(current_constraints: DataFrame, current_indexes: DataFrame) -> DataFrame:
    """Constraints that an index of the same table backs, with the index name."""
    backing = current_indexes.where("backs_constraint IS NOT NULL").select(
        "db_id", "table_oid", F.col("backs_constraint").alias("name"), F.col("name").alias("index_name")
    )
    owner = [c for c in ("schema_name", "table_name") if c in current_constraints.columns]
    return current_constraints.select("db_id", "table_oid", "name", *owner).join(backing, ["db_id", "table_oid", "name"])


def plan_drop_backed(current_constraints: DataFrame, current_indexes: DataFrame, altered: DataFrame) -> DataFrame:
    return _candidates(on_table(_index_backed(current_constraints, current_indexes), altered, some=True), 5, "CONSTRAINT")


def plan_drop_backed_removed(
    current_constraints: DataFrame,
    current_indexes: DataFrame,
    current_tables: DataFrame,
    target_indexes: DataFrame,
    target_tables: DataFrame,
) -> DataFrame:
    backed = on_table(_index_backed(current_constraints, current_indexes), current_tables)
    kept = on_table(target_indexes, target_tables).select(*COLUMN_TABLE, F.col("name").alias("index_name"))
    return _candidates(backed.join(kept, [*COLUMN_TABLE, "index_name"], "left_anti"), 6, "CONSTRAINT")


def plan_drop_indexes(current_indexes: DataFrame, altered: DataFrame, new_tables: DataFrame) -> DataFrame:
    free = on_table(current_indexes.where("backs_constraint IS NULL"), altered, some=True)
    fresh = new_tables.select("db_id", "schema_name", F.col("name").alias("table_name"))
    return _candidates(free.join(fresh, COLUMN_TABLE, "left_anti"), 7, "INDEX")


def plan_drop_removed_indexes(dropped_indexes: DataFrame, current_tables: DataFrame) -> DataFrame:
    return _candidates(on_table(dropped_indexes, current_tables), 8, "INDEX")


def queue_drops(*candidates: DataFrame) -> DataFrame:
    """Rows for the drop rules 2 to 8; an object that several rules ask for is queued by the first.

    Names are grouped before any text is made, with a partial minimum before the shuffle.
    """
    queued = union_rules(*candidates).groupBy(DROPPED).agg(F.min("rule").alias("rule")).withColumnRenamed("object_name", "name")
    is_index = F.col("object_type") == "INDEX"
    ddl = F.when(is_index, text("DROP INDEX IF EXISTS ", _object(), ";")).otherwise(_drop_constraint_text())
    # rules 5 and 6 go by table, the others by name
    by_table = F.col("rule").isin(5, 6)
    keys = [F.when(by_table, F.col(t)).otherwise(F.col(n)) for t, n in zip(_BY_TABLE, _BY_NAME, strict=True)]
    return _rows(
        queued, F.col("rule"), 1, F.col("object_type"), "DROP", ddl,
        table_name="table_name", order=keys, temporary=~F.col("rule").isin(2, 8),
    )


def _drop_constraint_text() -> Column:
    return text("ALTER TABLE ", _table(), " DROP CONSTRAINT IF EXISTS ", quote_ident("name"), ";")


# ---- phase 2: structural changes ------------------------------------------


def plan_schemas(new_tables: DataFrame) -> DataFrame:
    ddl = text("CREATE SCHEMA IF NOT EXISTS ", quote_ident("schema_name"), ";")
    schemas = new_tables.select("db_id", "schema_name").distinct()
    return _rows(schemas, 9, 2, "SCHEMA", "CREATE", ddl, object_name="schema_name", order=("schema_name",))


_LARGEST_BIGINT = "9223372036854775807"  # fixed value: bigint maximum


def _sequence_bounds() -> Column:
    return text(
        " MINVALUE ",
        F.col("min_value"),
        " MAXVALUE ",
        F.coalesce(F.col("max_value").cast("string"), F.lit(_LARGEST_BIGINT)),
        " INCREMENT ",
        F.col("increment"),
        F.when(F.col("cycles"), " CYCLE").otherwise(" NO CYCLE"),
        ";",
    )


def plan_create_sequences(sequences_diff: DataFrame) -> DataFrame:
    ddl = text(
        "CREATE SEQUENCE IF NOT EXISTS ", _object(), " AS ", F.col("type"), " START ", F.col("start_value"), _sequence_bounds()
    )
    return _rows(sequences_diff.where("is_new"), 10, 2, "SEQUENCE", "CREATE", ddl, order=("schema_name", "name"))


def plan_alter_sequences(sequences_diff: DataFrame) -> DataFrame:
    ddl = text("ALTER SEQUENCE ", _object(), " AS ", F.col("type"), _sequence_bounds())
    return _rows(sequences_diff.where("is_changed"), 11, 2, "SEQUENCE", "ALTER", ddl, order=("schema_name", "name"))


def plan_create_tables(new_tables: DataFrame) -> DataFrame:
    ddl = text("CREATE TABLE IF NOT EXISTS ", _object(), " ();")
    return _rows(new_tables, 12, 2, "TABLE", "CREATE", ddl, order=("schema_name", "name"))


def _column_text() -> Column:
    return render_type(F.col("type"), F.col("length"), F.col("nullable"), F.col("default_expr"))


def _clauses_per_table(clauses: DataFrame, order: str) -> DataFrame:
    """One row per table; a table has at most 1,600 columns, so its clause list is bounded."""
    return clauses.groupBy(COLUMN_TABLE).agg(
        F.expr(f"listagg(clause, ', ') WITHIN GROUP (ORDER BY {order})").alias("clauses")
    )


def plan_new_table_columns(target_columns: DataFrame, new_tables: DataFrame) -> DataFrame:
    fresh = new_tables.select("db_id", "schema_name", F.col("name").alias("table_name"))
    clause = text("ADD COLUMN IF NOT EXISTS ", quote_ident("name"), " ", _column_text())
    added = target_columns.join(fresh, COLUMN_TABLE, "left_semi").select(*COLUMN_TABLE, "name", clause.alias("clause"))
    ddl = text("ALTER TABLE ", _table(), " ", F.col("clauses"), ";")
    return _rows(
        _clauses_per_table(added, "name"), 13, 2, "COLUMN", "CREATE", ddl,
        object_name=None, table_name="table_name", order=("schema_name", "table_name"),
    )


# Operations batched into one statement per table.
BATCHED = ("ADD_COLUMN", "SET_DEFAULT", "DROP_DEFAULT", "DROP_NOT_NULL")


def _existing(columns_diff: DataFrame, new_tables: DataFrame) -> DataFrame:
    fresh = new_tables.select("db_id", "schema_name", F.col("name").alias("table_name"))
    return columns_diff.join(fresh, COLUMN_TABLE, "left_anti")


def plan_alter_aggregate(columns_diff: DataFrame, new_tables: DataFrame) -> DataFrame:
    op = F.col("operation_type")
    change = (
        F.when(op == "ADD_COLUMN", _column_text())
        .when(op == "SET_DEFAULT", text("SET DEFAULT ", F.col("default_expr")))
        .when(op == "DROP_DEFAULT", F.lit("DROP DEFAULT"))
        .when(op == "DROP_NOT_NULL", F.lit("DROP NOT NULL"))
    )
    verb = F.when(op == "ADD_COLUMN", "ADD").otherwise("ALTER")
    clause = text(verb, " COLUMN ", quote_ident("name"), " ", change)
    batched = _existing(columns_diff.where(op.isin(*BATCHED)), new_tables).select(
        *COLUMN_TABLE, "name", "operation_type", clause.alias("clause")
    )
    ddl = text("ALTER TABLE ", _table(), " ", F.col("clauses"), ";")
    return _alter_rows(_clauses_per_table(batched, "name, operation_type"), 14, ddl, None)


def _alter_rows(df: DataFrame, rule: int, ddl: Column, name: str | None) -> DataFrame:
    # the three ALTER rules share one numbering; rows without a column name come last in their table
    return _rows(
        df if name else df.withColumn("name", _no_text()), rule, 2, "COLUMN", "ALTER", ddl,
        object_name=name, table_name="table_name", order=_BY_TABLE, oid=F.lit(rule),
    )


def plan_set_not_null(columns_diff: DataFrame, new_tables: DataFrame) -> DataFrame:
    changed = _existing(columns_diff.where("operation_type = 'SET_NOT_NULL'"), new_tables)
    ddl = text("ALTER TABLE ", _table(), " ALTER COLUMN ", quote_ident("name"), " SET NOT NULL;")
    return _alter_rows(changed, 15, ddl, "name")


def plan_alter_type(columns_diff: DataFrame, new_tables: DataFrame) -> DataFrame:
    changed = _existing(columns_diff.where("operation_type = 'ALTER_TYPE'"), new_tables)
    old, new = quote_ident("name"), quote_ident("concat('new_', name)")
    alter = text("ALTER TABLE ", _table())
    ddl = F.concat_ws(
        "\n",
        text(alter, " ADD COLUMN ", new, " ", _column_text(), ";"),
        text("UPDATE ", _table(), " SET ", new, " = ", old, "::", type_text(F.col("type"), F.col("length")), ";"),
        text(alter, " DROP COLUMN ", old, ";"),
        text(alter, " RENAME COLUMN ", new, " TO ", old, ";"),
    )
    return _alter_rows(changed, 16, ddl, "name")


def plan_drop_tables(dropped_tables: DataFrame) -> DataFrame:
    ddl = text("DROP TABLE IF EXISTS ", _object(), ";")
    return _rows(dropped_tables.where("relkind = 'r'"), 17, 2, "TABLE", "DROP", ddl, order=("schema_name", "name"))


def _add_constraints(df: DataFrame, rule: int, phase: int) -> DataFrame:
    ddl = text("ALTER TABLE ", _table(), " ADD CONSTRAINT ", quote_ident("name"), " ", F.col("expression"), ";")
    return _rows(df, rule, phase, "CONSTRAINT", "CREATE", ddl, table_name="table_name", order=_BY_TABLE)


def plan_add_checks(constraints_diff: DataFrame, target_tables: DataFrame) -> DataFrame:
    return _add_constraints(on_table(constraints_diff.where("type = 'c' AND is_new"), target_tables), 18, 2)


def plan_add_uniques(constraints_diff: DataFrame, target_tables: DataFrame) -> DataFrame:
    return _add_constraints(on_table(constraints_diff.where("type = 'u' AND is_new"), target_tables), 19, 2)


def plan_drop_checks_uniques(dropped_constraints: DataFrame, current_tables: DataFrame) -> DataFrame:
    gone = on_table(dropped_constraints.where("type IN ('c', 'u')"), current_tables)
    return _rows(
        gone, 20, 2, "CONSTRAINT", "DROP", _drop_constraint_text(), table_name="table_name", order=_BY_TABLE
    )


# ---- phase 3: rebuild dependent objects -----------------------------------


def _dropped_for_now(queue: DataFrame, object_type: str) -> DataFrame:
    return queue.where(
        (F.col("phase") == 1)
        & (F.col("object_type") == object_type)
        & (F.col("ddl_operation") == "DROP")
        & F.col("is_temporary_drop")
    )


def plan_recreate_indexes(
    queue: DataFrame,
    current_indexes: DataFrame,
    current_tables: DataFrame,
    target_indexes: DataFrame,
    target_tables: DataFrame,
) -> DataFrame:
    queued = _dropped_for_now(queue, "INDEX").select(*TABLE[:2], F.col("object_name").alias("name"))
    known = on_table(current_indexes, current_tables).select(OWNER).join(queued, TABLE, "left_semi")
    back = on_table(target_indexes, target_tables).join(known, OWNER, "left_semi")
    ddl = text(F.col("expression"), ";")
    return _rows(
        back.dropDuplicates(TABLE), 21, 3, "INDEX", "CREATE", ddl, order=("schema_name", "name")
    )


def _dropped_constraint_targets(
    queue: DataFrame,
    types: tuple[str, ...],
    current_constraints: DataFrame,
    current_tables: DataFrame,
    target_constraints: DataFrame,
    target_tables: DataFrame,
) -> DataFrame:
    queued = _dropped_for_now(queue, "CONSTRAINT").select(*COLUMN_TABLE, F.col("object_name").alias("name"))
    known = (
        on_table(current_constraints.where(F.col("type").isin(*types)), current_tables)
        .select(OWNER)
        .join(queued, OWNER, "left_semi")
    )
    return on_table(target_constraints, target_tables).join(known, OWNER, "left_semi").dropDuplicates(OWNER)


def plan_recreate_pks(
    queue: DataFrame,
    current_constraints: DataFrame,
    current_tables: DataFrame,
    target_constraints: DataFrame,
    target_tables: DataFrame,
) -> DataFrame:
    """Primary keys, and the unique and exclusion constraints dropped with their index."""
    back = _dropped_constraint_targets(
        queue, ("p", "u", "x"), current_constraints, current_tables, target_constraints, target_tables
    )
    return _add_constraints(back, 22, 3)


def plan_recreate_fks(
    queue: DataFrame,
    recreated_pks: DataFrame,
    current_constraints: DataFrame,
    current_tables: DataFrame,
    target_constraints: DataFrame,
    target_tables: DataFrame,
) -> DataFrame:
    """Foreign keys whose referenced primary key comes back in this phase, or was never dropped."""
    fks = _dropped_constraint_targets(
        queue, ("f",), current_constraints, current_tables, target_constraints, target_tables
    )
    pks = on_table(target_constraints.where("type = 'p'"), target_tables).select(
        *OWNER, F.col("table_oid").alias("ref_table_oid")
    )
    named = [*COLUMN_TABLE, F.col("object_name").alias("name")]
    gone = queue.where("phase = 1 AND object_type = 'CONSTRAINT' AND ddl_operation = 'DROP'").select(named).distinct()
    back = recreated_pks.select(named).distinct()
    # a table has one primary key, so this is one row per table
    state = (
        pks.join(gone.withColumn("is_gone", F.lit(True)), OWNER, "left")
        .join(back.withColumn("is_back", F.lit(True)), OWNER, "left")
        .select("db_id", "ref_table_oid", "is_gone", "is_back")
    )
    ready = F.coalesce("is_back", F.lit(False)) | ~F.coalesce("is_gone", F.lit(False))
    return _add_constraints(fks.join(state, ["db_id", "ref_table_oid"], "left").where(ready), 23, 3)


def plan_recreate_views(order: DataFrame, target_views: DataFrame) -> DataFrame:
    """Views of the target that were dropped and new views, base views first, views in a cycle last.

    ``order`` is the ``creation_order`` of these views.
    """
    level = F.when(F.col("in_cycle"), _IN_CYCLE).otherwise(F.col("level"))
    back = target_views.join(order.select("db_id", "oid", level.alias("level")), ["db_id", "oid"])
    kind = F.when(F.col("is_materialized"), "MATERIALIZED VIEW").otherwise("OR REPLACE VIEW")
    ddl = text("CREATE ", kind, " ", _object(), " AS ", F.col("expression"), ";")
    return _rows(back, 24, 3, _view_kind(), "CREATE", ddl, level=F.col("level"), oid=F.col("oid"))


_IN_CYCLE = 2**31 - 1


# ---- numbering and strategy -----------------------------------------------


def union_rules(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def number_worklist(rules: DataFrame) -> DataFrame:
    """Numbers rule rows 1, 2, ... per (db_id, phase): by rule, then in the order of the rule.

    Rows with a ``_row``, unique in their phase, are sorted without their text, which is joined afterwards.
    """
    rank = F.when(F.col("rule").between(14, 16), 14).otherwise(F.col("rule"))
    order = [rank.asc(), *[F.col(c).asc_nulls_last() for c in ORDER]]
    if "_row" not in rules.columns:
        return numbered(rules, order, ["db_id", "phase"]).select(WORKLIST)
    keys = rules.select("db_id", "phase", "_row", "rule", *ORDER)
    places = numbered(keys, order, ["db_id", "phase"]).select("phase", "_row", "seq")
    return rules.join(places, ["phase", "_row"]).select(WORKLIST)


def classify_strategy(columns_diff: DataFrame) -> DataFrame:
    """How an existing table is changed: SHADOW (a type), AGGREGATE (several clauses in one statement) or DIRECT."""
    op = F.col("operation_type")
    return (
        columns_diff.where("NOT new_table")
        .groupBy(COLUMN_TABLE)
        .agg(F.count_if(op == "ALTER_TYPE").alias("types"), F.count_if(op.isin(*BATCHED)).alias("clauses"))
        .select(
            *COLUMN_TABLE,
            F.when(F.col("types") > 0, "SHADOW").when(F.col("clauses") > 1, "AGGREGATE").otherwise("DIRECT").alias("strategy"),
        )
    )
