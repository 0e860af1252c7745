"""The rows of a model for every database that follows it."""

import re

from pyspark.sql import functions as F

from fleetschema.operators import snapshots
from tests.test_skew import as_if_large


def test_a_model_is_not_copied_for_every_partition(spark):
    with as_if_large(spark):
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        model = spark.range(2000).select(F.lit(7).alias("model_id"), F.col("id").alias("oid"))
        databases = spark.range(3).select(F.col("id").cast("int").alias("db_id"), F.lit(7).alias("model_id"))
        out = snapshots.fan_out_model(model, databases)
        assert {(r["db_id"], r["oid"]) for r in out.collect()} == {(d, o) for d in range(3) for o in range(2000)}
        read = re.findall(r"rowCount=([\d.E+]+)", spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted"))
        assert read and max(map(float, read)) <= 2000


def test_a_model_is_dealt_to_parts_and_groups(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "MODEL_ROWS", 10)
    monkeypatch.setattr(snapshots, "FOLLOWERS", 4)
    model = spark.createDataFrame([(1, i % 25) for i in range(50)] + [(2, 1), (None, 2)], "model_id int, oid int")
    databases = spark.createDataFrame([(d, 1) for d in range(9)] * 2 + [(9, 2), (10, 3), (11, None)], "db_id int, model_id int")
    got = sorted((r["db_id"], r["oid"]) for r in snapshots.fan_out_model(model, databases).collect())
    assert got == sorted([(d, i % 25) for d in range(9) for i in range(50)] + [(9, 1)])
