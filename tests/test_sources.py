import pytest

from fleetschema import staging
from fleetschema.operators import snapshots
from fleetschema.plans import migration
from fleetschema.sources import catalog


def raw(spark, **given):
    frames = {}
    for relation, columns in catalog.RELATIONS.items():
        frames[relation] = spark.createDataFrame(given.get(relation, []), f"db_id int, {columns}")
    return frames


def test_constraint_keys_and_actions(spark):
    one = raw(
        spark,
        namespace=[(1, 5, "s"), (1, 6, "pg_catalog"), (2, 6, "s")],
        constraint=[
            (1, 9, "fk", "f", 5, 10, 11, 0, [1, 2], [3, 4], "c", " "),
            (1, 8, "ck", "c", 5, 0, 0, 0, [1], None, " ", " "),
            (1, 7, "x", "c", 6, 10, 0, 0, None, None, " ", " "),
        ],
        definitions=[(1, "constraint", 9, "FOREIGN KEY"), (2, "constraint", 8, "other database"), (1, "index", 8, "other kind")],
    )
    out = {r["name"]: r.asDict() for r in snapshots.snapshot_constraints(one).collect()}
    assert out.keys() == {"fk", "ck"}
    fk, ck = out["fk"], out["ck"]
    assert (fk["cols"], fk["ref_cols"], fk["on_delete"], fk["on_update"]) == ([1, 2], [3, 4], "c", None)
    assert (fk["table_oid"], fk["ref_table_oid"], fk["expression"]) == (10, 11, "FOREIGN KEY")
    assert (ck["table_oid"], ck["ref_table_oid"], ck["expression"]) == (None, None, None)


def test_export_round_trip(spark, tmp_path):
    one = raw(spark, namespace=[(1, 5, "s")], **{"class": [(1, 1, 5, "t", "r"), (1, 2, 5, "q", "S")]})
    two = raw(spark, namespace=[(2, 5, "s")], **{"class": [(2, 1, 5, "u", "m")]})
    for frames in (one, two):
        catalog.write_catalog(frames, str(tmp_path), "current")
    back = catalog.read_catalog(spark, str(tmp_path), "current")
    assert {tuple(r) for r in snapshots.snapshot_tables(back).collect()} == {(1, 1, "s", "t", "r"), (2, 1, "s", "u", "m")}
    assert set(migration.take_snapshots(back, "current")) >= {"current_tables", "current_views", "current_depends"}


def test_an_export_written_again_is_replaced(spark, tmp_path):
    path = str(tmp_path)
    three = raw(spark, namespace=[(d, 5, "s") for d in (1, 65, 2)], **{"class": [(d, 1, 5, "t", "r") for d in (1, 65, 2)]})
    for _ in range(2):
        catalog.write_catalog(three, path, "target")
    # database 1 shares its folder with 65; its table is gone in the second export
    catalog.write_catalog(raw(spark, namespace=[(1, 5, "s"), (1, 6, "u")]), path, "target")
    back = catalog.read_catalog(spark, path, "target")
    assert sorted((r["db_id"], r["nspname"]) for r in back["namespace"].collect()) == [(1, "s"), (1, "u"), (2, "s"), (65, "s")]
    assert sorted(r["db_id"] for r in back["class"].collect()) == [2, 65]


def test_an_export_may_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path)
    catalog.write_catalog(raw(spark, namespace=[(1, 5, "s"), (2, 5, "s")]), path, "target")
    catalog.write_catalog(catalog.read_catalog(spark, path, "target", [1]), path, "target")
    assert sorted(r["db_id"] for r in catalog.read_catalog(spark, path, "target")["namespace"].collect()) == [1, 2]


def test_databases_are_pruned(spark, tmp_path):
    catalog.write_catalog(raw(spark, namespace=[(d, 5, "s") for d in range(4)]), str(tmp_path), "target")
    one = catalog.read_catalog(spark, str(tmp_path), "target", [2])["namespace"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(db_bucket" in plan or "PartitionFilters: [(db_bucket" in plan or "PartitionFilters: [db_bucket" in plan
    assert [r["db_id"] for r in one.collect()] == [2]


def test_a_session_without_a_shared_folder_is_an_error():
    class Nothing:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_root(Nothing)


def test_missing_export_columns_are_null(spark):
    df = spark.createDataFrame([(1, 2, "k")], "db_id int, oid long, conname string")
    assert catalog.shaped(df, "constraint").first()["conkey"] is None


def test_jdbc_options():
    out = catalog.jdbc_options("jdbc:postgresql://host/db", "(SELECT 1) t", {"user": "u", "fetchsize": "5"})
    assert out["url"] == "jdbc:postgresql://host/db" and out["dbtable"] == "(SELECT 1) t"
    assert out["user"] == "u" and out["fetchsize"] == "5"


def test_each_database_follows_its_model(spark):
    model = spark.createDataFrame([("a", "t1"), ("a", "t2"), ("b", "t3")], "model_id string, name string")
    databases = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "none")], "db_id int, model_id string")
    out = snapshots.fan_out_model(model, databases)
    assert sorted((r["db_id"], r["name"]) for r in out.collect()) == [(1, "t1"), (1, "t2"), (2, "t3"), (3, "t1"), (3, "t2")]


def test_staging_uses_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        assert staging.run_folder(spark).startswith(root.rstrip("/"))
    df = staging.stage(spark.range(3).toDF("x"), "probe")
    assert df.count() == 3 and staging.run_folder(spark) in df.inputFiles()[0]
