"""A key with a third of all rows: adaptive execution has to be able to split it, and blocks have to cut it."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from fleetschema.functions.joins import unmatched
from fleetschema.functions.ordering import sorted_blocks
from fleetschema.operators import graph, rows
from fleetschema.plans import worklist as w

# sizes at which a test table counts as large, and no broadcast, as at scale
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def as_if_large(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()  # runs the plan that this frame shows
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=60000):
    """A third of the rows have key 0. Several input files, as splitting goes by map output."""
    return spark.range(0, n, 1, 12).select(
        F.lit(1).alias("db_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("long").alias("k"), "id"
    )


def test_missing_hot_key_is_split(spark):
    with as_if_large(spark):
        df = hot(spark)
        out = unmatched(df, df.where("k <> 0 AND k % 2 = 0"), ["k"])
        assert "skew=true" in final_plan(out)
        assert out.count() == df.where("k = 0 OR k % 2 = 1").count()


def test_object_read_by_most_views_is_split(spark):
    with as_if_large(spark):
        depends = hot(spark).select("db_id", F.col("k").alias("ref_oid"), (F.col("id") + 10**9).alias("view_oid"))
        views = depends.select(
            "db_id", F.col("view_oid").alias("oid"), F.lit("s").alias("schema_name"), F.lit("v").alias("name"), F.lit(False).alias("is_materialized")
        )
        objects = spark.range(100).select(F.lit(1).alias("db_id"), F.col("id").alias("oid"))
        out = graph.direct_dependents(depends, views, objects)
        assert "skew=true" in final_plan(out)
        assert out.count() == depends.where("ref_oid < 100").count()


def test_table_referenced_by_most_keys_is_split(spark):
    with as_if_large(spark):
        keys = hot(spark).select(
            "db_id", F.col("id").alias("oid"), F.concat(F.lit("fk"), "id").alias("name"), F.lit("f").alias("type"),
            (F.col("id") + 10**6).alias("table_oid"), F.col("k").alias("ref_table_oid"), F.lit("x").alias("expression"),
        )
        tables = hot(spark).select(
            "db_id", (F.col("id") + 10**6).alias("oid"), F.lit("s").alias("schema_name"), F.concat(F.lit("t"), "id").alias("name")
        )
        altered = spark.range(100).select(F.lit(1).alias("db_id"), F.col("id").alias("oid"))
        out = w.plan_drop_fks_to_altered(keys, tables, altered)
        assert "skew=true" in final_plan(out)
        assert out.count() == keys.where("ref_table_oid < 100").count()


def test_walks_over_a_hot_node(spark):
    """A node with a third of all edges, under the same sizes."""
    with as_if_large(spark):
        edges = hot(spark, 6000).select("db_id", F.col("k").alias("ref_oid"), (F.col("id") + 10**6).alias("view_oid"))
        seeds = spark.range(1).select(F.lit(1).alias("db_id"), "id").toDF("db_id", "oid")
        assert graph.dependency_closure(edges, seeds).count() == 1 + edges.where("ref_oid = 0").count()
        nodes = edges.select("db_id", F.col("ref_oid").alias("oid")).union(edges.select("db_id", "view_oid"))
        levels = graph.recreation_order(edges, nodes).groupBy("level").count().collect()
        assert {r["level"]: r["count"] for r in levels} == {1: edges.select("ref_oid").distinct().count(), 2: 6000}


def test_blocks_cut_a_hot_group(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        placed = sorted_blocks(hot(spark), [F.col("id").asc()], ["k"])
        sizes = [r["count"] for r in placed.groupBy("_block").count().collect()]
        assert len(sizes) > 12 and max(sizes) < 3 * 60000 / 16
        assert placed.where("k = 0").select("_block").distinct().count() >= 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("primary", [True, False])
def test_frequent_key_is_counted_before_the_shuffle(spark, primary):
    plan = rows.validate_unique(hot(spark), ["k"], primary)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
