import pytest
from pyspark.sql import functions as F

from fleetschema.functions.text import KEY_WORDS, quote_ident, render_type
from fleetschema.operators import rows, runlog
from fleetschema.plans import migration
from fleetschema.plans import worklist as w


def quoted(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return [r[0] for r in df.select(quote_ident("name")).collect()]


def test_quote_ident(spark):
    names = ["abc", "_a1", "1a", "Abc", "a b", 'a"b', "select", "user", "a$b", "", "abc\n", "é", "date", None]
    assert quoted(spark, *names) == [
        "abc", "_a1", '"1a"', '"Abc"', '"a b"', '"a""b"', '"select"', '"user"', '"a$b"', '""', '"abc\n"', '"é"', "date", None
    ]
    assert len(KEY_WORDS) == len(set(KEY_WORDS)) < 200


def test_render_type(spark):
    df = spark.createDataFrame(
        [("varchar", 10, True, None), ("varchar", -1, False, "'x'"), ("bpchar", None, True, ""), ("int4", 4, False, "1")],
        "type string, length int, nullable boolean, default_expr string",
    )
    out = df.select(render_type(*[F.col(c) for c in df.columns])).collect()
    assert [r[0] for r in out] == ["varchar(10)", "varchar NOT NULL DEFAULT 'x'", "bpchar DEFAULT ", "int4 NOT NULL DEFAULT 1"]


def test_numbers_are_unique_and_without_gaps(e):
    per_phase = e.worklist().groupBy("db_id", "phase").agg(
        F.count("*").alias("n"), F.max("seq").alias("last"), F.count_distinct("seq").alias("distinct")
    )
    assert per_phase.where("n <> last OR n <> distinct").isEmpty()
    assert rows.validate_unique(e.worklist(), ["db_id", "phase", "seq"], primary=True).isEmpty()


def test_no_object_is_dropped_twice(e):
    drops = e.queue().where("rule BETWEEN 2 AND 8")
    assert drops.groupBy("db_id", "object_type", "schema_name", "table_name", "object_name").count().where("count > 1").isEmpty()


def test_foreign_keys_come_after_the_primary_keys(e):
    created = e.worklist().where("phase = 3 AND object_type = 'CONSTRAINT'").withColumn(
        "is_fk", F.col("ddl").contains("FOREIGN KEY")
    )
    ends = created.groupBy("db_id").agg(
        F.max(F.when(~F.col("is_fk"), F.col("seq"))).alias("last_pk"), F.min(F.when(F.col("is_fk"), F.col("seq"))).alias("first_fk")
    )
    assert ends.where("first_fk IS NOT NULL AND last_pk IS NOT NULL").count() > 0
    assert ends.where("first_fk < last_pk").isEmpty()


def test_worklist_vocabulary(e):
    wl = e.worklist()
    assert rows.validate_check(
        wl,
        "object_type IN ('SCHEMA', 'TABLE', 'COLUMN', 'CONSTRAINT', 'VIEW', 'MATERIALIZED VIEW', 'INDEX', 'SEQUENCE')"
        " AND ddl_operation IN ('CREATE', 'DROP', 'ALTER') AND phase IN (1, 2, 3) AND ddl LIKE '%;'",
    ).isEmpty()
    counted = rows.validate_not_null(wl, ["phase", "seq", "object_type", "ddl", "ddl_operation", "is_temporary_drop"]).first()
    assert list(counted)[1:] == [0] * 6


def test_snapshot_integrity(e):
    """Keys and references that the staging tables of a database would enforce."""
    s = e.snapshots
    for side in ("target", "current"):
        tables, columns = s[f"{side}_tables"], s[f"{side}_columns"]
        for kind in ("tables", "constraints", "indexes", "sequences", "views"):
            assert rows.validate_unique(s[f"{side}_{kind}"], ["db_id", "oid"], primary=True).isEmpty()
        assert rows.validate_unique(columns, ["db_id", "table_oid", "name"], primary=True).isEmpty()
        for child in (columns, s[f"{side}_constraints"], s[f"{side}_indexes"]):
            assert rows.validate_foreign_key(child, tables, ["db_id", "table_oid"], ["db_id", "oid"]).isEmpty()
        constraints = s[f"{side}_constraints"]
        assert rows.validate_foreign_key(constraints, tables, ["db_id", "ref_table_oid"], ["db_id", "oid"]).isEmpty()
        assert rows.validate_check(constraints, "type IN ('p', 'f', 'u', 'c', 'x')").isEmpty()


CONSTRAINTS = "db_id int, oid long, name string, type string, table_oid long, ref_table_oid long, expression string"
# key columns and actions of constraints are carried only
SHAPES = {**migration.SNAPSHOT_COLUMNS, "constraints": CONSTRAINTS}
DEPENDS = SHAPES.pop("depends")


def snapshots(spark, depends=(), target_depends=(), **given):
    out = {
        f"{side}_{kind}": spark.createDataFrame(list(given.get(f"{side}_{kind}", ())), shape)
        for side in ("target", "current")
        for kind, shape in SHAPES.items()
    }
    edges = {"current_depends": depends, "target_depends": target_depends}
    return {**out, **{n: spark.createDataFrame(list(rows), DEPENDS) for n, rows in edges.items()}}


def ddl_of(worklist):
    return [(r["phase"], r["seq"], r["ddl"]) for r in worklist.orderBy("db_id", "phase", "seq").collect()]


def test_tables_are_replaced_and_read_back(spark, tmp_path):
    one = {"target_tables": [(1, 1, "s", "t", "r"), (2, 2, "s", "u", "m")]}
    for _ in range(2):
        given = snapshots(spark, [(1, 1, 2)], **one)
        for side in ("target", "current"):
            for column in ("cols", "ref_cols", "on_delete", "on_update"):
                given[f"{side}_constraints"] = given[f"{side}_constraints"].withColumn(column, F.lit(None).cast("string"))
        migration.write_tables(given, str(tmp_path))
    back = migration.read_snapshots(spark, str(tmp_path))
    assert len(back) == 14
    assert sorted(tuple(r) for r in back["target_tables"].collect()) == one["target_tables"]


def test_rows_present_are_skipped(spark, tmp_path):
    path = str(tmp_path / "phases")
    for _ in range(2):
        runlog.append_missing(runlog.phases(spark), path, ["phase"])
    assert sorted(r["phase"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_nothing_to_do(spark):
    assert migration.build_worklist(snapshots(spark)).isEmpty()
    same = [(1, 1, "s", "t", "r")]
    assert migration.build_worklist(snapshots(spark, target_tables=same, current_tables=same)).isEmpty()


def test_one_table_with_everything(spark):
    """A type change on a table with a primary key, a unique key, an index, a foreign key to it and two views."""
    def column(name, type_="int4", length=-1, nullable=True, default=None):
        return (1, 0, "s", "Big Table", name, nullable, type_, length, default, None)
    shared = dict(
        constraints=[
            (1, 100, "pk", "p", 1, None, "PRIMARY KEY (id)"),
            (1, 101, "uq", "u", 1, None, "UNIQUE (code)"),
            (1, 102, "fk", "f", 2, 1, 'FOREIGN KEY (big_id) REFERENCES s."Big Table"(id)'),
        ],
        indexes=[
            (1, 200, 1, "ix", 'CREATE INDEX ix ON s."Big Table" (code)', None),
            (1, 201, 1, "pk", "CREATE UNIQUE INDEX pk", "pk"),
            (1, 202, 1, "uq", "CREATE UNIQUE INDEX uq", "uq"),
        ],
    )
    tables = [(1, 1, "s", "Big Table", "r"), (1, 2, "s", "child", "r")]
    views = [(1, 300, "s", "v1", "SELECT 1", True), (1, 301, "s", "v2", "SELECT 2", False), (1, 302, "s", "mine", "SELECT 3", False)]
    s = snapshots(
        spark,
        [(1, 1, 300), (1, 300, 301), (1, 1, 301), (1, 1, 302)],
        target_tables=tables,
        current_tables=tables,
        target_columns=[column("id"), column("code", "varchar", 24, False, "'x'"), column("order", default="1")],
        current_columns=[column("id"), column("code", "int4", -1, True, "'x'")],
        target_views=views[:2],
        current_views=views,
        **{f"{side}_{k}": v for side in ("target", "current") for k, v in shared.items()},
    )
    t = 's."Big Table"'
    assert ddl_of(migration.build_worklist(s)) == [
        (1, 1, "DROP MATERIALIZED VIEW IF EXISTS s.v1 CASCADE;"),
        (1, 2, "DROP VIEW IF EXISTS s.mine CASCADE;"),
        (1, 3, "DROP VIEW IF EXISTS s.v2 CASCADE;"),
        (1, 4, "ALTER TABLE s.child DROP CONSTRAINT IF EXISTS fk;"),
        (1, 5, f"ALTER TABLE {t} DROP CONSTRAINT IF EXISTS pk;"),
        (1, 6, f"ALTER TABLE {t} DROP CONSTRAINT IF EXISTS uq;"),
        (1, 7, "DROP INDEX IF EXISTS s.ix;"),
        (2, 1, f"ALTER TABLE {t} ALTER COLUMN code SET NOT NULL;"),
        (
            2, 2,
            f"ALTER TABLE {t} ADD COLUMN new_code varchar(24) NOT NULL DEFAULT 'x';\nUPDATE {t} SET new_code = code::varchar(24);\n"
            f"ALTER TABLE {t} DROP COLUMN code;\nALTER TABLE {t} RENAME COLUMN new_code TO code;",
        ),
        (2, 3, f'ALTER TABLE {t} ADD COLUMN "order" int4 DEFAULT 1;'),
        (3, 1, 'CREATE INDEX ix ON s."Big Table" (code);'),
        (3, 2, f"ALTER TABLE {t} ADD CONSTRAINT pk PRIMARY KEY (id);"),
        (3, 3, f"ALTER TABLE {t} ADD CONSTRAINT uq UNIQUE (code);"),
        (3, 4, f"ALTER TABLE s.child ADD CONSTRAINT fk FOREIGN KEY (big_id) REFERENCES {t}(id);"),
        (3, 5, "CREATE MATERIALIZED VIEW s.v1 AS SELECT 1;"),
        (3, 6, "CREATE OR REPLACE VIEW s.v2 AS SELECT 2;"),
    ]


def test_foreign_key_waits_for_a_lost_primary_key(spark):
    """The referenced key is dropped and the target does not have it under that table any more: no foreign key comes back."""
    tables = [(1, 1, "s", "a", "r"), (1, 2, "s", "b", "r")]
    fk = (1, 102, "fk", "f", 2, 1, "FOREIGN KEY (x) REFERENCES s.a(x)")
    pk = (1, 100, "pk", "p", 1, None, "PRIMARY KEY (x)")
    s = snapshots(
        spark,
        target_tables=tables,
        current_tables=tables,
        target_columns=[(1, 1, "s", "a", "x", True, "int8", -1, None, None)],
        current_columns=[(1, 1, "s", "a", "x", True, "int4", -1, None, None)],
        current_constraints=[pk, fk],
        target_constraints=[fk],
    )
    third = [d for p, _, d in ddl_of(migration.build_worklist(s)) if p == 3]
    assert third == ["ALTER TABLE s.b ADD CONSTRAINT fk FOREIGN KEY (x) REFERENCES s.a(x);"]
    s["target_constraints"] = spark.createDataFrame([pk, fk], CONSTRAINTS)
    third = [d for p, _, d in ddl_of(migration.build_worklist(s)) if p == 3]
    assert third == ["ALTER TABLE s.a ADD CONSTRAINT pk PRIMARY KEY (x);", "ALTER TABLE s.b ADD CONSTRAINT fk FOREIGN KEY (x) REFERENCES s.a(x);"]


def test_strategy(spark):
    def op(table, name, operation, new=False):
        return (1, "s", table, name, operation, new)
    changes = spark.createDataFrame(
        [op("a", "x", "ALTER_TYPE"), op("a", "y", "ADD_COLUMN"), op("b", "x", "ADD_COLUMN"), op("b", "y", "DROP_DEFAULT"),
         op("c", "x", "SET_DEFAULT"), op("d", "x", "SET_NOT_NULL"), op("d", "y", "SET_NOT_NULL"), op("e", "x", "ADD_COLUMN", True)],
        "db_id int, schema_name string, table_name string, name string, operation_type string, new_table boolean",
    )
    out = {r["table_name"]: r["strategy"] for r in w.classify_strategy(changes).collect()}
    assert out == {"a": "SHADOW", "b": "AGGREGATE", "c": "DIRECT", "d": "DIRECT"}


# ---- run log --------------------------------------------------------------


@pytest.fixture
def small_run(spark):
    worklist = spark.createDataFrame(
        [(d, 1, i, "PENDING") for d in (1, 2, 3) for i in (1, 2)], "db_id int, phase int, seq long, status string"
    )
    outcomes = spark.sql(
        "SELECT * FROM VALUES (1, 1, 1L, 'ERROR', 'no', TIMESTAMP'2024-01-01'), (1, 1, 1L, 'DONE', NULL, TIMESTAMP'2024-01-02'),"
        " (1, 1, 2L, 'DONE', NULL, TIMESTAMP'2024-01-01'), (2, 1, 1L, 'DONE', NULL, TIMESTAMP'2024-01-01'),"
        " (2, 1, 2L, 'ERROR', 'bad', TIMESTAMP'2024-01-01') AS t(db_id, phase, seq, status, error_msg, recorded_at)"
    )
    return worklist, outcomes


def test_latest_outcome_counts(small_run):
    worklist, outcomes = small_run
    out = runlog.record_status(worklist, outcomes)
    status = {(r["db_id"], r["seq"]): (r["status"], r["error_msg"], r["executed_at"] is not None) for r in out.collect()}
    assert status[1, 1] == ("DONE", None, True)
    assert status[2, 2] == ("ERROR", "bad", False)
    assert status[3, 1] == ("PENDING", None, False)
    assert [(r["db_id"], r["seq"]) for r in runlog.pending(out).collect()] == [(3, 1), (3, 2)]
    dry = runlog.record_status(worklist, outcomes, dry_run=True).where("status = 'DRY RUN'")
    assert dry.count() == 3


def test_gate_and_publish(spark, small_run, tmp_path):
    worklist, outcomes = small_run
    out = runlog.record_status(worklist, outcomes)
    gate = runlog.publish_gate(out, dry_run=False)
    # 2 has an error, 3 has never run
    assert {r["db_id"]: r["publish"] for r in gate.collect()} == {1: True, 2: False, 3: False}
    unknown = out.withColumn("status", F.when(F.col("db_id") > 1, F.col("status")))
    assert runlog.publish_gate(unknown, dry_run=False).where("publish").isEmpty()
    assert runlog.publish_gate(out).where("publish").isEmpty()
    data = spark.createDataFrame([(d, i) for d in (1, 2, 3, 4) for i in range(5)], "db_id int, x int")
    runlog.publish(data, gate, str(tmp_path / "out"))
    assert sorted(r["db_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1] * 5


def test_a_view_comes_after_the_new_views_that_it_reads(spark):
    """In the target the changed view a reads the new view n, which reads the new view m."""
    view = lambda oid, name, text: (1, oid, "s", name, text, False)
    s = snapshots(
        spark, [(1, 11, 10)], [(1, 23, 20), (1, 24, 23), (1, 21, 22)],
        current_views=[view(10, "a", "old"), view(11, "b", "b"), view(12, "c", "c")],
        target_views=[view(20, "a", "new"), view(21, "b", "b"), view(22, "c", "c"), view(23, "n", "n"), view(24, "m", "m")],
    )
    # edges are (read, reader): n reads m here, a reads n
    s["target_depends"] = spark.createDataFrame([(1, 24, 23), (1, 23, 20)], DEPENDS)
    made = [r["object_name"] for r in migration.build_worklist(s).where("phase = 3").orderBy("seq").collect()]
    assert made.index("m") < made.index("n") < made.index("a") and set(made) == {"a", "n", "m"}
