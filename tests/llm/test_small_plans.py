"""What the driver holds: plans that do not grow with the levels of the tree."""

from pyspark.sql import functions as F

from fleetschema.llm import sharding
from fleetschema.staging import stage_observed


def test_plans_of_the_tree_do_not_grow(spark, monkeypatch):
    joins, cuts = [], sharding._median_cuts

    def counted(points, nodes, n):
        joins.append(points._jdf.queryExecution().analyzed().toString().count("Join"))
        return cuts(points, nodes, n)

    monkeypatch.setattr(sharding, "_median_cuts", counted)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") + 1).cast("int")).alias("text"))
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("a"), "n_chars": F.length("text")})
    dealt = sharding.shard_documents(docs, shards=4)
    assert dealt.count() == 60 and joins == [0, 0]


def test_sums_of_written_rows(spark):
    table, seen = stage_observed(spark.range(5), "five", n=F.count(F.lit(1)), total=F.sum("id"))
    assert table.count() == seen["n"] == 5 and seen["total"] == 10
    table, seen = stage_observed(spark.range(5).where("id > 9"), "none", n=F.count(F.lit(1)))
    assert table.count() == 0 and not seen.get("n")
