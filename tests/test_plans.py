"""What the physical plans must not hold."""

import re

import pytest

from checks.queries import QUERIES
from fleetschema.operators import snapshots
from fleetschema.plans import worklist as w
from tests.conftest import SF

# one-row totals over the whole table: every task sends a single partial row
TOTALS = {"r08_conform_violations", "r04_constraints_by_key_number"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_single_partition_and_no_pairs(spark, name):
    text = plan(QUERIES[name](spark, SF))
    if name not in TOTALS:
        assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "Python" not in text


def test_column_difference_reads_each_side_once(spark):
    text = plan(QUERIES["d08_columns_diff"](spark, SF))
    assert text.count("FileScan parquet") == 4  # two column and two table snapshots
    assert "HashedRelation" in text or "SortMergeJoin" in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["r05_orphan_keys"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint>" in text and "ReadSchema: struct<p_partkey:bigint>" in text


def test_a_foreign_key_reads_the_child_once(spark):
    text = plan(QUERIES["r05_validate_foreign_key"](spark, SF))
    assert text.count("ReadSchema: struct<l_orderkey") == 1 and text.count("LeftAnti") == 1


def test_attributes_are_shuffled_by_table_once(spark, e):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(snapshots.snapshot_columns(e.raw("target")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    # by table, and for the type's name; no third time for the defaults
    assert not [k for k in keys if "attnum" in k]
    assert len([k for k in keys if "atttypid" in k]) <= 2


def test_the_worklist_is_numbered_without_its_text(spark):
    rows = spark.createDataFrame([(1, 1, 0, 9, "long text")], "db_id int, phase int, _row long, rule int, ddl string")
    rows = rows.selectExpr("*", "0 AS ord_level", "'a' AS ord_1", "'b' AS ord_2", "'c' AS ord_3", "0L AS ord_oid")
    named = rows.selectExpr("*", *[f"'' AS {c}" for c in w.WORKLIST if c not in (*rows.columns, "seq")])
    out = w.number_worklist(named)
    assert [(r["seq"], r["ddl"]) for r in out.collect()] == [(1, "long text")]
    assert "ddl" not in re.search(r"ReadSchema: (struct<[^\n]*_block[^\n]*|[^\n]*_place[^\n]*)", plan(out))[0]
