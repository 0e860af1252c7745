"""One query per operator, over the whole given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.env import Env, env
from checks.sqltext import fixtures, oracle, oracles, with_clause
from fleetschema.functions.text import render_type
from fleetschema.operators import actions, constraints, diff, exclusion, fleet, graph, rows, runlog, snapshots
from fleetschema.plans import migration
from fleetschema.plans import worklist as w
from fleetschema.sources.catalog import SIDES, read_catalog, write_catalog
from fleetschema.staging import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Callable[[Env], DataFrame]) -> Callable[[Env], DataFrame]:
    QUERIES[make.__name__] = lambda spark, sf_dir: make(env(spark, sf_dir))
    return make


def _both_sides(e: Env, snapshot: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    sides = [snapshot(e.raw(s)).withColumn("side", F.lit(s)) for s in ("current", "target")]
    return sides[0].unionByName(sides[1])


# ---- sources and snapshots ------------------------------------------------


# a number and a text of each relation, by which its rows are compared
_CONTENTS = {
    "namespace": ("oid", "nspname"),
    "class": ("oid", "relname"),
    "attribute": ("attrelid + attnum", "attname"),
    "type": ("oid", "typname"),
    "attrdef": ("oid", "''"),
    "constraint": ("oid", "conname"),
    "index": ("indexrelid", "''"),
    "sequence": ("seqrelid + seqmax", "''"),
    "depend": ("objid + refobjid", "deptype"),
    "rewrite": ("oid + ev_class", "''"),
    "proc": ("oid", "proname"),
    "trigger": ("oid", "tgname"),
    "definitions": ("object_oid", "definition"),
}


@query
def s01_read_catalog(e: Env) -> DataFrame:
    path = new_folder(e.spark, "export")
    out = None
    for side in SIDES:
        write_catalog(e.raw(side), path, side)
        for relation, df in read_catalog(e.spark, path, side).items():
            number, text = _CONTENTS[relation]
            n = df.groupBy("db_id").agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.expr(number)).cast("long").alias("numbers"),
                F.sum(F.length(F.expr(text))).alias("characters"),
            )
            n = n.select(F.lit(side).alias("side"), F.lit(relation).alias("relation"), "db_id", "n", "numbers", "characters")
            out = n if out is None else out.unionByName(n)
    return out


@query
def s02_object_definitions(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.object_definitions)


@query
def s03_snapshot_tables(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.snapshot_tables)


@query
def s04_snapshot_columns(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.snapshot_columns)


@query
def s05_snapshot_constraints(e: Env) -> DataFrame:
    found = _both_sides(e, snapshots.snapshot_constraints)
    return found.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("cols", "ref_cols")})


@query
def s06_snapshot_indexes(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.snapshot_indexes)


@query
def s07_snapshot_sequences(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.snapshot_sequences)


@query
def s08_snapshot_views(e: Env) -> DataFrame:
    return _both_sides(e, snapshots.snapshot_views)


@query
def s09_fan_out_model(e: Env) -> DataFrame:
    model = e.snapshots["target_tables"].withColumnRenamed("db_id", "model_id").drop("oid")
    tenants = e.table("supplier").select(
        F.col("s_suppkey").cast("int").alias("db_id"), (F.col("s_suppkey") % 20).cast("int").alias("model_id")
    )
    return snapshots.fan_out_model(model, tenants)


# ---- differences ----------------------------------------------------------


def _difference_query(name: str, of: str, operation: str | None = None) -> None:
    def make(e: Env) -> DataFrame:
        out = migration.difference(e.snapshots, of)
        return out if operation is None else out.where(F.col("operation_type") == operation)

    make.__name__ = name
    query(make)


_difference_query("d01_new_tables", "new_tables")
_difference_query("d02_add_column", "columns_diff", "ADD_COLUMN")
_difference_query("d03_alter_type", "columns_diff", "ALTER_TYPE")
_difference_query("d04_set_not_null", "columns_diff", "SET_NOT_NULL")
_difference_query("d05_drop_not_null", "columns_diff", "DROP_NOT_NULL")
_difference_query("d06_drop_default", "columns_diff", "DROP_DEFAULT")
_difference_query("d07_set_default", "columns_diff", "SET_DEFAULT")
_difference_query("d08_columns_diff", "columns_diff")
_difference_query("d09_constraints_diff", "constraints_diff")
_difference_query("d10_indexes_diff", "indexes_diff")
_difference_query("d11_sequences_diff", "sequences_diff")
_difference_query("d12_views_diff", "views_diff")
_difference_query("d13_dropped_tables", "dropped_tables")
_difference_query("d14_dropped_columns", "dropped_columns")
_difference_query("d15_dropped_constraints", "dropped_constraints")
_difference_query("d16_dropped_indexes", "dropped_indexes")


def _changed_text(df: DataFrame) -> DataFrame:
    return df.withColumn("changed_columns", F.array_join("changed_columns", ","))


@query
def d17_row_diff(e: Env) -> DataFrame:
    orders = e.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    target = orders.where(key % 13 != 0).select(
        key,
        F.when(key % 7 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 35 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return _changed_text(diff.row_diff(target, orders.where(key % 11 != 0), ["o_orderkey"], unique_keys=True))


@query
def d17_row_diff_by_blocks(e: Env) -> DataFrame:
    """Sides that are mostly equal: only blocks of keys that differ are shuffled."""
    orders = e.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    target = orders.where(key % 1301 != 0).withColumn(
        "o_orderpriority", F.when(key % 907 != 0, F.col("o_orderpriority"))
    )
    current = orders.where(key % 1103 != 0)
    return _changed_text(diff.row_diff(target, current, ["o_orderkey"], unique_keys=True, blocks=(64, 64)))


@query
def d17_row_diff_repeated(e: Env) -> DataFrame:
    """A key that is not unique: (order, line number) occurs up to several times."""
    lines = e.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    target = lines.where("l_partkey % 13 <> 0").withColumn(
        "l_discount", F.when(F.col("l_suppkey") % 4 == 0, F.col("l_discount") + 1).otherwise(F.col("l_discount"))
    )
    current = lines.where("l_partkey % 11 <> 0").withColumn(
        "l_quantity", F.when(F.col("l_suppkey") % 6 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return _changed_text(diff.row_diff(target, current, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount"]))


@query
def d17_row_diff_sequences(e: Env) -> DataFrame:
    """The strict form of the sequence difference: NULL against a value counts, and so does the start."""
    s = e.snapshots
    compare = ["type", "start_value", "max_value", "increment"]
    return _changed_text(diff.row_diff(s["target_sequences"], s["current_sequences"], diff.TABLE, compare))


# ---- dependencies ---------------------------------------------------------


@query
def g00_dependency_edges(e: Env) -> DataFrame:
    raw = e.raw("current")
    return graph.dependency_edges(raw["depend"], raw["rewrite"])


@query
def g01_direct_dependents(e: Env) -> DataFrame:
    s, d = e.snapshots, e.diffs
    touched = d["altered"].select("db_id", "oid").unionByName(d["dropped_tables"].select("db_id", "oid"))
    return graph.direct_dependents(s["current_depends"], s["current_views"], touched)


@query
def g02_tenant_views(e: Env) -> DataFrame:
    s, d = e.snapshots, e.diffs
    saved = graph.tenant_views(
        d["altered"], d["dropped_tables"], s["current_depends"], s["current_views"], s["target_views"]
    )
    return saved.withColumn("depends_on", F.array_join("depends_on", ",")).drop("error_msg")


@query
def g03_affected_views(e: Env) -> DataFrame:
    s, d = e.snapshots, e.diffs
    return graph.affected_views(
        d["views_diff"], d["altered"], d["dropped_tables"], s["current_depends"], s["current_views"]
    )


@query
def g04_dependency_closure(e: Env) -> DataFrame:
    """From the views that read no view; database 3 starts inside its cycle."""
    views, edges = e.snapshots["current_views"], e.snapshots["current_depends"]
    ids = views.select("db_id", "oid")
    inner = edges.join(ids.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"], "left_semi")
    roots = ids.where("db_id <> 3").join(
        inner.select("db_id", F.col("view_oid").alias("oid")).distinct(), ["db_id", "oid"], "left_anti"
    )
    return graph.dependency_closure(edges, roots.unionByName(ids.where("db_id = 3 AND oid = 1300000003")))


def _roots_and_edges(e: Env) -> tuple[DataFrame, DataFrame]:
    """Views that read no view, and in database 3 one inside its cycle."""
    views, edges = e.snapshots["current_views"], e.snapshots["current_depends"]
    ids = views.select("db_id", "oid")
    inner = edges.join(ids.withColumnRenamed("oid", "ref_oid"), ["db_id", "ref_oid"], "left_semi")
    readers = inner.select("db_id", F.col("view_oid").alias("oid")).distinct()
    roots = ids.where("db_id <> 3").join(readers, ["db_id", "oid"], "left_anti")
    return roots.unionByName(ids.where("db_id = 3 AND oid = 1300000003")), edges.where("ref_oid <> view_oid")


@query
def g04_dependency_paths(e: Env) -> DataFrame:
    seeds, edges = _roots_and_edges(e)
    found = graph.dependency_paths(edges, seeds)
    return found.withColumn("path", F.concat_ws(">", F.col("path").cast("array<string>")))


@query
def g04_closure_by_recursion(e: Env) -> DataFrame:
    seeds, edges = _roots_and_edges(e)
    return graph.closure_by_recursion(edges, seeds)


@query
def g05_cycle_members(e: Env) -> DataFrame:
    edges = e.snapshots["current_depends"]
    return graph.cycle_members(graph.recreation_order(edges, e.snapshots["current_views"]), edges)


@query
def g05_recreation_order(e: Env) -> DataFrame:
    return graph.recreation_order(e.snapshots["current_depends"], e.snapshots["current_views"])


# ---- worklist -------------------------------------------------------------

# name -> (rule number, block of the check SQL)
RULES = {
    "w01_drop_views": (1, "o_queue"),
    "w02_drop_removed_fks": (2, "o_queue"),
    "w03_drop_fks_to_altered": (3, "o_queue"),
    "w04_drop_pks_on_altered": (4, "o_queue"),
    "w05_drop_index_backed_on_altered": (5, "o_queue"),
    "w06_drop_backed_by_removed_index": (6, "o_queue"),
    "w07_drop_indexes_on_altered": (7, "o_queue"),
    "w08_drop_removed_indexes": (8, "o_queue"),
    "w09_create_schemas": (9, "o_w09"),
    "w10_create_sequences": (10, "o_w09"),
    "w11_alter_sequences": (11, "o_w09"),
    "w12_create_tables": (12, "o_w09"),
    "w13_add_columns_new_tables": (13, "o_w13"),
    "w14_alter_aggregate": (14, "o_w13"),
    "w15_alter_set_not_null": (15, "o_w13"),
    "w16_alter_type_shadow": (16, "o_w13"),
    "w17_drop_tables": (17, "o_w09"),
    "w18_add_checks": (18, "o_w18"),
    "w19_add_uniques": (19, "o_w18"),
    "w20_drop_checks_uniques": (20, "o_w02"),
    "w21_recreate_indexes": (21, "o_w21"),
    "w22_recreate_pks": (22, "o_w18"),
    "w23_recreate_fks": (23, "o_w18"),
    "w24_recreate_views": (24, "o_w24"),
}
RULE_COLUMNS = [c for c in w.WORKLIST if c != "seq"]


def _rule_rows(e: Env, rule: int) -> DataFrame:
    s, d = e.snapshots, e.diffs
    new, columns = d["new_tables"], d["columns_diff"]
    if rule <= 8:
        return e.queue().where(F.col("rule") == rule)
    recreated = lambda: (s["current_constraints"], s["current_tables"], s["target_constraints"], s["target_tables"])
    match rule:
        case 9:
            return w.plan_schemas(new)
        case 10:
            return w.plan_create_sequences(d["sequences_diff"])
        case 11:
            return w.plan_alter_sequences(d["sequences_diff"])
        case 12:
            return w.plan_create_tables(new)
        case 13:
            return w.plan_new_table_columns(s["target_columns"], new)
        case 14:
            return w.plan_alter_aggregate(columns, new)
        case 15:
            return w.plan_set_not_null(columns, new)
        case 16:
            return w.plan_alter_type(columns, new)
        case 17:
            return w.plan_drop_tables(d["dropped_tables"])
        case 18:
            return w.plan_add_checks(d["constraints_diff"], s["target_tables"])
        case 19:
            return w.plan_add_uniques(d["constraints_diff"], s["target_tables"])
        case 20:
            return w.plan_drop_checks_uniques(d["dropped_constraints"], s["current_tables"])
        case 21:
            return w.plan_recreate_indexes(
                e.queue(), s["current_indexes"], s["current_tables"], s["target_indexes"], s["target_tables"]
            )
        case 22:
            return w.plan_recreate_pks(e.queue(), *recreated())
        case 23:
            return w.plan_recreate_fks(e.queue(), w.plan_recreate_pks(e.queue(), *recreated()), *recreated())
        case 24:
            return w.plan_recreate_views(e.order(), s["target_views"])


def _rule_query(name: str, rule: int) -> None:
    def make(e: Env) -> DataFrame:
        return _rule_rows(e, rule).select(RULE_COLUMNS)

    make.__name__ = name
    query(make)


for _name, (_rule, _) in RULES.items():
    _rule_query(_name, _rule)


@query
def w25_render_type(e: Env) -> DataFrame:
    c = F.col
    return e.snapshots["target_columns"].select(
        "db_id",
        "schema_name",
        "table_name",
        "name",
        render_type(c("type"), c("length"), c("nullable"), c("default_expr")).alias("rendered"),
    )


@query
def w26_number_worklist(e: Env) -> DataFrame:
    return e.build_worklist()


@query
def w26_from_exports(e: Env) -> DataFrame:
    """The whole run: exports written and read, snapshots taken and written, worklist built from them."""
    exports, tables = new_folder(e.spark, "exports"), new_folder(e.spark, "snapshots")
    for side in SIDES:
        write_catalog(e.raw(side), exports, side)
        migration.write_tables(migration.take_snapshots(read_catalog(e.spark, exports, side), side), tables)
    return migration.build_worklist(migration.read_snapshots(e.spark, tables))


@query
def w27_classify_strategy(e: Env) -> DataFrame:
    return w.classify_strategy(e.diffs["columns_diff"])


# ---- run log --------------------------------------------------------------


def _runs(e: Env) -> DataFrame:
    """Outcomes of two runs; the second one repeats some rows."""
    ids = e.worklist().select("db_id", "phase", "seq").where("seq % 7 <> 0 OR db_id % 4 = 1")
    failed = (F.col("seq") % 50 == 0) & (F.col("db_id") % 3 == 0)
    first = ids.select(
        *runlog.ROW_ID,
        F.when(failed, "ERROR").otherwise("DONE").alias("status"),
        F.when(failed, F.concat(F.lit("failed at "), F.col("seq").cast("string"))).alias("error_msg"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("recorded_at"),
    )
    second = ids.where("seq % 100 = 0").select(
        *runlog.ROW_ID,
        F.lit("DONE").alias("status"),
        F.lit(None).cast("string").alias("error_msg"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("recorded_at"),
    )
    return first.unionByName(second)


def _recorded(e: Env) -> DataFrame:
    return runlog.record_status(e.worklist(), _runs(e))


@query
def l01_pending(e: Env) -> DataFrame:
    return runlog.pending(_recorded(e)).drop("error_msg", "executed_at")


@query
def l02_record_status(e: Env) -> DataFrame:
    return _recorded(e).withColumn("executed_at", F.date_format("executed_at", "yyyy-MM-dd HH:mm:ss"))


@query
def l03_publish_gate(e: Env) -> DataFrame:
    return runlog.publish_gate(_recorded(e), dry_run=False)


@query
def l03_publish_databases(e: Env) -> DataFrame:
    """A first version of every database, then a second one of those that passed the gate, read by manifests."""
    path = new_folder(e.spark, "published")
    first = e.table("events").select("event_id", "event_type", (F.col("user_id") % 20).cast("int").alias("db_id"))
    gate = runlog.publish_gate(_recorded(e), dry_run=False)
    runlog.publish_databases(first, gate.withColumn("publish", F.lit(True)), path, 1)
    second = first.where("event_id % 3 <> 0").withColumn("event_type", F.upper("event_type"))
    runlog.publish_databases(second, gate, path, 2)
    return runlog.read_published(e.spark, path, first.schema)


@query
def l04_run_report(e: Env) -> DataFrame:
    return runlog.run_report(_recorded(e))


@query
def l04_run_errors(e: Env) -> DataFrame:
    return runlog.run_errors(_recorded(e))


@query
def l04_unplanned_differences(e: Env) -> DataFrame:
    return runlog.unplanned_differences(e.snapshots, e.diffs, e.worklist())


# ---- row work -------------------------------------------------------------


@query
def r01_add_columns(e: Env) -> DataFrame:
    new = [
        {"name": "note", "type": "varchar", "length": -1, "default_expr": "'n/a'::character varying"},
        {"name": "batch", "type": "int8", "length": -1, "default_expr": "3 + 4"},
        {"name": "weight", "type": "float8", "length": -1, "default_expr": None},
        {"name": "code", "type": "varchar", "length": 7, "default_expr": "'abcdef'::character varying(7)"},
        {"name": "owner", "type": "uuid", "length": -1, "default_expr": "'00000000-0000-0000-0000-000000000000'::uuid"},
    ]
    return rows.add_columns(e.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), new)


def _event_codes(e: Env) -> DataFrame:
    """Events with a text column that mostly holds numbers."""
    code = (
        F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string")))
        .when(F.col("event_id") % 17 == 0, F.lit(None))
        .otherwise(F.col("user_id").cast("string"))
    )
    return e.table("events").select("event_id", "event_type", "user_id", code.alias("code"))


@query
def r02_rewrite_column_type(e: Env) -> DataFrame:
    return rows.rewrite_column_type(_event_codes(e), "code", "int4", on_error="null")[0]


@query
def r02_rewrite_failures(e: Env) -> DataFrame:
    return rows.rewrite_column_type(_event_codes(e), "code", "int4", by=["event_type"])[1]


@query
def r02_rewrite_char(e: Env) -> DataFrame:
    names = e.table("customer").select("c_custkey", "c_name")
    return rows.rewrite_column_type(names, "c_name", "varchar", 14)[0]


@query
def r02_rewrite_char_failures(e: Env) -> DataFrame:
    names = e.table("customer").select("c_mktsegment", "c_name")
    return rows.rewrite_column_type(names, "c_name", "varchar", 14, by=["c_mktsegment"])[1]


@query
def r03_validate_not_null(e: Env) -> DataFrame:
    lines = e.table("lineitem").select(
        "l_returnflag",
        F.nullif("l_linenumber", F.lit(7)).alias("line"),
        F.when(F.col("l_suppkey") % 10 != 3, F.col("l_suppkey")).alias("supp"),
    )
    return rows.validate_not_null(lines, ["line", "supp"], by=["l_returnflag"])


@query
def r04_validate_unique(e: Env) -> DataFrame:
    return rows.validate_unique(e.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def r04_validate_primary_key(e: Env) -> DataFrame:
    keys = e.table("events").select(F.nullif(F.col("user_id") % 50, F.lit(7)).alias("k"))
    return rows.validate_unique(keys, ["k"], primary=True)


def _child_and_parent(e: Env) -> tuple[DataFrame, DataFrame]:
    return (
        e.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
        e.table("part").where("p_partkey % 10 <> 0"),
    )


@query
def r04_constraints_by_key_number(e: Env) -> DataFrame:
    """Constraints as a snapshot holds them, on the rows of the given tables."""
    child, parent = e.table("lineitem"), e.table("part").where("p_partkey % 10 <> 0")
    names = {10: child.columns, 11: parent.columns, 12: e.table("orders").columns}
    columns = e.spark.createDataFrame(
        [(1, oid, c, k) for oid, cols in names.items() for k, c in enumerate(cols, 1)], "db_id int, table_oid long, name string, attnum int"
    )
    tables = e.spark.createDataFrame(
        [(1, 10, "app", "lineitem", "r"), (1, 11, "app", "part", "r"), (1, 12, "app", "orders", "r")], migration.SNAPSHOT_COLUMNS["tables"]
    )
    at = lambda oid, *cols: [names[oid].index(c) + 1 for c in cols]
    rules = e.spark.createDataFrame(
        [
            (1, 1, "line_key", "u", 10, None, at(10, "l_orderkey", "l_linenumber"), None, "UNIQUE (l_orderkey, l_linenumber)", None, None),
            (1, 2, "line_part", "f", 10, 11, at(10, "l_partkey"), at(11, "p_partkey"), "FOREIGN KEY (l_partkey) REFERENCES part(p_partkey)", "a", "a"),
            (1, 3, "line_flag", "c", 10, None, at(10, "l_returnflag"), None, "CHECK (((l_returnflag)::text = ANY (ARRAY['A'::text, 'N'::text])))", None, None),
            (1, 4, "line_discount", "c", 10, None, at(10, "l_discount"), None, "CHECK ((l_discount <= (0.08)::double precision))", None, None),
            (1, 5, "order_key", "p", 12, None, at(12, "o_orderkey"), None, "PRIMARY KEY (o_orderkey)", None, None),
            (1, 6, "order_customer", "u", 12, None, at(12, "o_custkey"), None, "UNIQUE (o_custkey)", None, None),
            (1, 7, "order_booked", "x", 12, None, at(12, "o_custkey"), None, "EXCLUDE USING gist (o_custkey WITH =, booked WITH &&)", None, None),
        ],
        migration.SNAPSHOT_COLUMNS["constraints"],
    )
    given = {("app", "lineitem"): child, ("app", "part"): parent, ("app", "orders"): e.table("orders")}
    return rows.constraint_violations({"target_tables": tables, "target_columns": columns, "target_constraints": rules}, 1, given)


@query
def r05_validate_foreign_key(e: Env) -> DataFrame:
    return rows.validate_foreign_key(*_child_and_parent(e), ["l_partkey"], ["p_partkey"])


@query
def r05_orphan_keys(e: Env) -> DataFrame:
    return rows.orphan_keys(*_child_and_parent(e), ["l_partkey"], ["p_partkey"])


@query
def r05_foreign_key_effects(e: Env) -> DataFrame:
    """Some customers and suppliers go: orders and lines with them, lines of a part keep no part, and orders hang on each other."""
    orders = e.table("orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") / 3).cast("long").alias("earlier"))
    tables = {
        "customer": e.table("customer").select("c_custkey"),
        "part": e.table("part").select("p_partkey"),
        "supplier": e.table("supplier").select("s_suppkey"),
        "orders": orders.withColumn("earlier", F.nullif("earlier", F.lit(0).cast("long"))),
        "line": e.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey")
        ),
    }
    keys = {"customer": ["c_custkey"], "part": ["p_partkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "line": ["l_orderkey", "l_linenumber"]}
    fk = actions.ForeignKey
    foreign = [
        fk("orders", ("o_custkey",), "customer", ("c_custkey",), "c"),
        fk("orders", ("earlier",), "orders", ("o_orderkey",), "c"),
        fk("line", ("l_orderkey",), "orders", ("o_orderkey",), "c"),
        fk("line", ("l_partkey",), "part", ("p_partkey",), "n", "c"),
        fk("line", ("l_suppkey",), "supplier", ("s_suppkey",), "a"),
    ]
    deleted = {
        "customer": tables["customer"].where("c_custkey % 50 = 7"),
        "part": tables["part"].where("p_partkey % 40 = 3"),
        "supplier": tables["supplier"].where("s_suppkey % 10 = 1"),
    }
    updated = {"part": (["p_partkey"], tables["part"].where("p_partkey % 40 = 5"))}
    return actions.foreign_key_effects(tables, keys, foreign, deleted, updated)


@query
def r06_validate_check(e: Env) -> DataFrame:
    lines = e.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return rows.validate_check(lines, "CASE WHEN l_quantity = 50 THEN NULL ELSE l_discount END <= 0.08D")


@query
def r07_validate_exclusion(e: Env) -> DataFrame:
    booked = e.table("events").select("event_id", "user_id", "ts", (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("te"))
    return rows.validate_exclusion(booked, ["user_id"], "ts", "te", ["event_id"]).select("event_id", "user_id")


def _booked(e: Env) -> DataFrame:
    """Events that take a span of time and a span of desks; database and group are those of the user."""
    desk = F.col("event_id") * 7 % 100
    return e.table("events").select(
        "event_id",
        (F.col("user_id") % 20).cast("int").alias("db_id"),
        "event_type",
        "ts",
        F.when(F.col("event_id") % 97 != 0, F.col("ts") + F.expr("INTERVAL 30 HOURS")).alias("te"),
        F.when(F.col("event_id") % 89 != 0, desk).alias("desk_from"),
        (desk + F.col("event_id") % 6).alias("desk_to"),
    )


@query
def r07_excluded_boxes(e: Env) -> DataFrame:
    """Two ranges, one inclusive, with open bounds, and a column that has to differ."""
    rule = exclusion.Exclusion(["db_id"], [("ts", "te", "[)"), ("desk_from", "desk_to", "[]")], ["event_type"])
    return exclusion.excluded_rows(_booked(e), rule, ["event_id"]).select("event_id", "db_id")


@query
def r04_fleet_violations(e: Env) -> DataFrame:
    """The constraints of twenty databases, not the same in all, on orders and lines keyed by database."""
    orders = e.table("orders").withColumn("db_id", (F.col("o_orderkey") % 20).cast("int"))
    lines = e.table("lineitem").withColumn("db_id", (F.col("l_orderkey") % 20).cast("int"))
    given = {("app", "orders"): orders.where("o_orderkey % 9 <> 0"), ("app", "lines"): lines, ("app", "booked"): _booked(e)}
    names = {10: lines.columns, 11: orders.columns, 12: _booked(e).columns}
    at = lambda oid, *cols: [names[oid].index(c) + 1 for c in cols]
    tables, columns, rules = [], [], []
    for db in range(20):
        tables += [(db, 10, "app", "lines", "r"), (db, 11, "app", "orders", "r"), (db, 12, "app", "booked", "r")]
        columns += [(db, oid, c, k) for oid, cols in names.items() for k, c in enumerate(cols, 1)]
        limit = "0.08" if db % 2 else "0.05"
        rules += [
            (db, 1, "order_key", "p", 11, None, at(11, "o_orderkey"), None, "PRIMARY KEY (o_orderkey)", None, None),
            (db, 2, "line_key", "u", 10, None, at(10, "l_orderkey", "l_linenumber"), None, "UNIQUE (l_orderkey, l_linenumber)", None, None),
            (db, 3, "line_order", "f", 10, 11, at(10, "l_orderkey"), at(11, "o_orderkey"), "FOREIGN KEY (l_orderkey) REFERENCES orders(o_orderkey)", "a", "a"),
            (db, 4, "line_discount", "c", 10, None, at(10, "l_discount"), None, f"CHECK ((l_discount <= ({limit})::double precision))", None, None),
        ]
        if db % 4 == 0:
            rules.append((db, 5, "booked_desk", "x", 12, None, at(12, "event_type"), None, "EXCLUDE USING gist (event_type WITH =, tsrange(ts, te) WITH &&, int8range(desk_from, desk_to, '[]'::text) WITH &&)", None, None))
        if db % 5 == 0:
            rules.append((db, 6, "booked_shape", "x", 12, None, at(12, "event_type"), None, "EXCLUDE USING gist (event_type WITH =, shape WITH &&)", None, None))
    s = {
        "target_tables": e.spark.createDataFrame(tables, migration.SNAPSHOT_COLUMNS["tables"]),
        "target_columns": e.spark.createDataFrame(columns, "db_id int, table_oid long, name string, attnum int"),
        "target_constraints": e.spark.createDataFrame(rules, migration.SNAPSHOT_COLUMNS["constraints"]),
    }
    return constraints.fleet_violations(s, given)


_COLUMN = "db_id int, schema_name string, table_name string, name string, type string, length int, nullable boolean, default_expr string, table_oid long"


def _conformed(e: Env) -> tuple[DataFrame, DataFrame]:
    """The events brought to a target with other types and two more columns, as the column difference says."""
    name = (1, "app", "events")
    current = e.spark.createDataFrame(
        [
            (*name, "event_id", "int8", -1, False, None, 1),
            (*name, "event_type", "text", -1, False, None, 1),
            (*name, "code", "text", -1, True, None, 1),
        ],
        _COLUMN,
    )
    target = e.spark.createDataFrame(
        [
            (*name, "event_id", "int8", -1, False, None, 2),
            (*name, "event_type", "varchar", 8, False, None, 2),
            (*name, "code", "int4", -1, False, None, 2),
            (*name, "region", "text", -1, False, "'eu'", 2),
            (*name, "shard", "int4", -1, False, None, 2),
        ],
        _COLUMN,
    )
    none = e.spark.createDataFrame([], "db_id int, schema_name string, name string")
    changes = diff.columns_diff(target, current, none)
    return rows.conform_table(_event_codes(e).drop("user_id"), changes, *name, on_error="null")


@query
def r08_conform_table(e: Env) -> DataFrame:
    return _conformed(e)[0]


@query
def r08_conform_violations(e: Env) -> DataFrame:
    return _conformed(e)[1]


def _fleet(e: Env) -> tuple[DataFrame, DataFrame]:
    """Events of twenty databases in one frame, and their differences: three ways to differ, and none."""
    event = _event_codes(e).withColumn("db_id", (F.col("user_id") % 20).cast("int")).drop("user_id")
    kind = F.col("db_id") % 4
    region = F.when(kind == 3, "uk").when((kind == 2) & (F.col("event_id") % 5 != 0), "us")
    shard = F.when(kind == 3, (F.col("event_id") % 10).cast("int"))
    side = "db_id int, schema_name string, table_name string, name string, type string, length int, nullable boolean, default_expr string, table_oid long"
    same = [("event_id", "int8", -1, False, None)]
    target = [*same, ("event_type", "varchar", 8, False, None), ("code", "int4", -1, False, None), ("region", "text", -1, False, "'eu'::text"), ("shard", "int4", -1, False, None)]
    current = {
        0: [*same, ("event_type", "text", -1, False, None), ("code", "text", -1, True, None)],
        1: target[:3],
        2: [*same, ("event_type", "text", -1, False, None), ("code", "text", -1, True, None), ("region", "text", -1, True, None)],
        3: target,
    }
    columns = lambda of: e.spark.createDataFrame([(db, "app", "events", *c, 1) for db in range(20) for c in of(db % 4)], side)
    none = e.spark.createDataFrame([], "db_id int, schema_name string, name string")
    changes = diff.columns_diff(columns(lambda _: target), columns(current.get), none)
    return event.withColumns({"region": region, "shard": shard}), changes


@query
def r08_conform_fleet(e: Env) -> DataFrame:
    return fleet.conform_fleet(*_fleet(e), "app", "events", on_error="null")[0]


@query
def r08_conform_fleet_violations(e: Env) -> DataFrame:
    return fleet.conform_fleet(*_fleet(e), "app", "events", on_error="null")[1]


@query
def r09_assign_sequence(e: Env) -> DataFrame:
    return rows.assign_sequence(
        e.table("events").select("event_id"), ["event_id"], 100, 5, min_value=100, max_value=2595, cycle=True
    )


@query
def r09_assign_sequence_plain(e: Env) -> DataFrame:
    orders = e.table("orders").select("o_orderdate", "o_orderkey")
    return rows.assign_sequence(
        orders, ["o_orderdate", "o_orderkey"], 1000, -3, min_value=-(2**40), max_value=1000
    ).select("o_orderkey", "id")


def _rebuilt(e: Env) -> tuple[str, DataFrame]:
    """Views on each other in two schemas that share names, some in a cycle, and a second database."""
    view = "db_id int, oid long, schema_name string, name string, expression string, is_materialized boolean"
    customers = "SELECT c.c_custkey, c.c_mktsegment, sum(v.qty) AS qty, count(*) AS orders FROM customer c JOIN v_order_customer v ON v.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_mktsegment"
    views = e.spark.createDataFrame(
        [
            (0, 1, "app", "totals", customers, True),
            (0, 2, "app", "v_order_customer", "SELECT o.o_orderkey, o.o_custkey, q.qty FROM orders o JOIN app.v_order_qty q ON q.l_orderkey = o.o_orderkey", False),
            (0, 3, "app", "v_order_qty", "SELECT l_orderkey, sum(l_quantity) AS qty, 'app.totals' AS note FROM lineitem GROUP BY l_orderkey", True),
            (0, 4, "audit", "v_order_customer", "SELECT o_custkey, 1.0D AS qty FROM app.v_order_customer", False),
            (0, 5, "audit", "totals", "SELECT t.c_custkey, sum(v.qty) AS qty FROM app.totals t JOIN v_order_customer v ON v.o_custkey = t.c_custkey GROUP BY t.c_custkey", True),
            (0, 6, "app", "loop_a", "SELECT * FROM app.loop_b", False),
            (0, 7, "app", "loop_b", "SELECT * FROM app.loop_a", False),
            (0, 8, "app", "behind", "SELECT * FROM app.loop_a", True),
            (1, 1, "app", "totals", "SELECT count(*) AS n FROM orders", True),
        ],
        view,
    )
    reads = [(3, 2), (2, 1), (2, 4), (1, 5), (4, 5), (6, 7), (7, 6), (6, 8)]
    edges = e.spark.createDataFrame([(0, *r) for r in reads], "db_id int, ref_oid long, view_oid long")
    order = graph.recreation_order(edges, views)
    out = new_folder(e.spark, "rebuilt")
    mine = {t: e.table(t) for t in ("lineitem", "orders", "customer")}
    return out, rows.rebuild_views(e.spark, order, views, out, {0: mine, 1: {"orders": e.table("orders")}})


@query
def r10_rebuild_views(e: Env) -> DataFrame:
    out, _ = _rebuilt(e)
    read = lambda name, key: e.spark.read.parquet(f"{out}/0/{name.replace('.', '/')}").select(
        F.lit(name).alias("view_name"), F.col(key).alias("key"), "qty"
    )
    return read("app.totals", "c_custkey").unionByName(read("app.v_order_qty", "l_orderkey")).unionByName(
        read("audit.totals", "c_custkey")
    )


@query
def r10_rebuild_status(e: Env) -> DataFrame:
    _, status = _rebuilt(e)
    return status.withColumn("written", F.col("path").isNotNull()).drop("path")


def oracle_sql() -> dict[str, str]:
    out = {}
    for name in QUERIES:
        if name in RULES:
            rule, block = RULES[name]
            out[name] = _rule_oracle(rule, block)
        elif name in oracles():
            out[name] = oracle(name)
    out["w26_from_exports"] = _whole_run_oracle()
    return out


def _whole_run_oracle() -> str:
    """The worklist's SQL over tables that a catalog lists: materialized views are among them."""
    blocks = {**fixtures(), **oracles()}
    for side in SIDES:
        blocks[f"plain_{side}_tables"] = blocks[f"{side}_tables"]
        blocks[f"{side}_tables"] = (
            f"SELECT oid, db_id, schema_name, name, relkind FROM plain_{side}_tables "
            f"UNION ALL SELECT oid, db_id, schema_name, name, 'm' FROM {side}_views WHERE is_materialized"
        )
    return with_clause("SELECT * FROM worklist", blocks)


def _rule_oracle(rule: int, block: str) -> str:
    return with_clause(f"SELECT {', '.join(RULE_COLUMNS)} FROM {block} WHERE rule = {rule}", {**fixtures(), **oracles()})
