"""What a run over a fleet writes and copies."""

from pathlib import Path

import pytest

from checks.env import Env
from checks.session import for_fleet
from fleetschema import staging
from fleetschema.operators import runlog


@pytest.fixture
def small(spark, tmp_path):
    """An environment over small tables of its own."""
    n, orders = 40, spark.range(1, 241, 1, 2)
    tables = {
        "orders": orders.selectExpr("id AS o_orderkey", f"id % {n} + 1 AS o_custkey", "concat(id % 5 + 1, '-X') AS o_orderpriority"),
        "lineitem": orders.selectExpr("id AS l_orderkey", "explode(sequence(1, 3)) AS l_linenumber").selectExpr(
            "*", "l_orderkey * 3 + l_linenumber AS l_partkey", "l_orderkey + l_linenumber AS l_suppkey",
            "substr('ANR', l_linenumber, 1) AS l_returnflag", "if(l_orderkey % 2 = 0, 'O', 'F') AS l_linestatus", "cast(l_linenumber AS double) AS l_quantity",
        ),
        "customer": spark.range(1, n + 1).selectExpr("id AS c_custkey"),
        "part": spark.range(1, 61).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size"),
        "supplier": spark.range(1, 21).selectExpr("id AS s_suppkey"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Env(for_fleet(spark), str(tmp_path))


def folders(spark, label):
    return {p.name for p in Path(staging.run_folder(spark).removeprefix("file:")).glob(f"{label}-*")}


def test_fixtures_are_worked_out_once(spark, small):
    before = folders(spark, "fx_tables")
    small.fixture("current_indexes"), small.fixture("target_constraints")
    assert len(folders(spark, "fx_tables") - before) == 1
    plan = small.sql("SELECT * FROM target_indexes")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_a_worklist_leaves_no_owners_and_takes_the_differences_given(spark, small):
    owners, diffs = folders(spark, "owned"), folders(spark, "columns_diff")
    worklist = small.worklist()
    assert worklist.count() > 0 and folders(spark, "owned") == owners
    left = runlog.unplanned_differences(small.snapshots, small.diffs, worklist)
    assert left.where("kind = 'NEW TABLE'").count() == 0
    assert len(folders(spark, "columns_diff") - diffs) == 1


def test_shuffle_files_go_with_their_statement(spark, small):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    before = files().size()
    staging.stage(spark.range(5000, numPartitions=4).repartition(7, "id"), "probe")
    assert files().size() <= before


def test_a_session_keeps_what_it_sets(spark):
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    held = spark.conf.get(key)
    try:
        spark.conf.set(key, "5m")
        assert for_fleet(spark).conf.get(key) == "5m"
        spark.conf.unset(key)
        assert for_fleet(spark).conf.get(key) == "32m"
    finally:
        spark.conf.set(key, held)
