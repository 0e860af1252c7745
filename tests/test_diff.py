import random

import pytest
from pyspark.sql import functions as F

from fleetschema.operators import diff
from fleetschema.operators.diff import row_diff

SCHEMA = "k int, a string, b int"


def rows(df):
    return sorted(((r["k"], r["op"], tuple(r["changed_columns"])) for r in df.collect()), key=str)


def random_side(seed):
    r = random.Random(seed)
    return [(k, r.choice(["x", "y", None]), r.choice([1, 2, None])) for k in range(200) if r.random() < 0.8]


@pytest.mark.parametrize("unique", [True, False])
def test_against_itself_is_empty(spark, unique):
    x = spark.createDataFrame(random_side(1), SCHEMA)
    assert row_diff(x, x, ["k"], unique_keys=unique).isEmpty()


@pytest.mark.parametrize("unique", [True, False])
def test_against_python(spark, unique):
    a, b = random_side(1), random_side(2)
    out = row_diff(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k"], unique_keys=unique)
    x, y = {r[0]: r[1:] for r in a}, {r[0]: r[1:] for r in b}
    want = [(k, "ADDED", ()) for k in x.keys() - y.keys()] + [(k, "REMOVED", ()) for k in y.keys() - x.keys()]
    for k in x.keys() & y.keys():
        changed = tuple(c for c, p, q in zip("ab", x[k], y[k], strict=True) if p != q)
        if changed:
            want.append((k, "CHANGED", changed))
    assert rows(out) == sorted(want, key=str)


def test_swapping_sides_swaps_added_and_removed(spark):
    a, b = (spark.createDataFrame(random_side(s), SCHEMA) for s in (3, 4))
    swap = {"ADDED": "REMOVED", "REMOVED": "ADDED"}
    there, back = rows(row_diff(a, b, ["k"])), rows(row_diff(b, a, ["k"]))
    assert there == sorted(((k, swap.get(op, op), c) for k, op, c in back), key=str)


def test_applying_the_difference_gives_the_target(spark):
    a, b = (spark.createDataFrame(random_side(s), SCHEMA) for s in (5, 6))
    changes = row_diff(a, b, ["k"])
    kept = b.join(changes.select("k"), "k", "left_anti")
    brought = a.join(changes.where("op <> 'REMOVED'").select("k"), "k", "left_semi")
    out = kept.unionByName(brought)
    assert out.exceptAll(a).isEmpty() and a.exceptAll(out).isEmpty()


def test_sql_comparison_ignores_null_against_value(spark):
    a = spark.createDataFrame([(1, None, 1), (2, "x", 1)], SCHEMA)
    b = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], SCHEMA)
    assert rows(row_diff(a, b, ["k"], null_equal=False)) == [(2, "CHANGED", ("a",))]
    assert rows(row_diff(a, b, ["k"])) == [(1, "CHANGED", ("a",)), (2, "CHANGED", ("a",))]


def test_a_key_that_fills_both_sides_gives_one_row(spark):
    """One key on all 20,000 rows of both sides: as a join this would be 400 million pairs."""
    many = spark.range(20000).select(F.lit(7).alias("k"), F.lit("x").alias("a"), F.col("id").cast("int").alias("b"))
    other = spark.createDataFrame([(8, "x", 1)], SCHEMA)
    assert rows(row_diff(many.unionByName(other), many, ["k"])) == [(7, "DUPLICATE_KEY", ()), (8, "ADDED", ())]


def test_only_keys(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    for unique in (True, False):
        assert rows(row_diff(a, b, ["k"], unique_keys=unique)) == [(1, "ADDED", ()), (3, "REMOVED", ())]


COLUMN = "db_id int, table_oid long, schema_name string, table_name string, name string, nullable boolean, type string, length int, default_expr string"
NEW = "db_id int, schema_name string, name string"


def operations(spark, target, current, new=()):
    out = diff.columns_diff(
        spark.createDataFrame(target, COLUMN), spark.createDataFrame(current, COLUMN), spark.createDataFrame(list(new), NEW)
    )
    return sorted((r["name"], r["operation_type"], r["new_table"]) for r in out.collect())


def column(name, nullable=True, type_="int4", length=-1, default=None, table="t", db=1):
    return (db, 9, "s", table, name, nullable, type_, length, default)


def test_column_rules(spark):
    assert operations(spark, [column("a")], []) == [("a", "ADD_COLUMN", False)]
    assert operations(spark, [column("a")], [], [(1, "s", "t")]) == [("a", "ADD_COLUMN", True)]
    assert operations(spark, [], [column("a")]) == []
    # a NULL length is the same as none
    assert operations(spark, [column("a", length=None)], [column("a")]) == []
    # an empty default is the same as none
    assert operations(spark, [column("a", default="")], [column("a")]) == []
    assert operations(spark, [column("a", default=None)], [column("a", default="1")]) == [("a", "DROP_DEFAULT", False)]
    every = operations(spark, [column("a", False, "text", -1, "1")], [column("a", True, "int4", -1, "2")])
    assert [o for _, o, _ in every] == ["ALTER_TYPE", "SET_DEFAULT", "SET_NOT_NULL"]
    # another database has nothing to do with it
    assert operations(spark, [column("a")], [column("a", db=2)]) == [("a", "ADD_COLUMN", False)]
    assert operations(spark, [column("a", default="x")] * 1, [column("a", default="")]) == [("a", "SET_DEFAULT", False)]


def test_sequence_null_bound_is_no_difference(spark):
    schema = "db_id int, oid long, schema_name string, name string, type string, start_value long, min_value long, max_value long, increment long, cycles boolean"
    a = spark.createDataFrame([(1, 1, "s", "q", "int8", 5, 1, None, 1, False)], schema)
    b = spark.createDataFrame([(1, 2, "s", "q", "int8", 1, 1, 100, 1, False)], schema)
    assert diff.sequences_diff(a, b).isEmpty()
    assert [r["changed_columns"] for r in row_diff(a, b, diff.TABLE, ["start_value", "max_value"]).collect()] == [
        ["start_value", "max_value"]
    ]


def test_constraint_is_matched_by_table_and_name(spark):
    t = "db_id int, oid long, schema_name string, name string, relkind string"
    c = "db_id int, oid long, name string, type string, table_oid long, ref_table_oid long, expression string"
    tt = spark.createDataFrame([(1, 10, "s", "a", "r"), (1, 11, "s", "b", "r")], t)
    ct = spark.createDataFrame([(1, 20, "s", "a", "r"), (1, 21, "s", "b", "r")], t)
    tc = spark.createDataFrame([(1, 1, "k", "c", 10, None, "x"), (1, 2, "k", "c", 11, None, "y")], c)
    cc = spark.createDataFrame([(1, 3, "k", "c", 20, None, "x")], c)
    out = {r["oid"]: (r["is_new"], r["is_changed"]) for r in diff.constraints_diff(tc, tt, ct, cc).collect()}
    assert out == {1: (False, False), 2: (True, False)}
    # dropped constraints go by bare name
    assert diff.dropped_constraints(cc, tc, ct.limit(0)).isEmpty()


def test_columns_of_one_side_are_an_error(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, a int"), spark.createDataFrame([(1, 3)], "k int, b int")
    with pytest.raises(ValueError, match="a, b"):
        row_diff(a, b, ["k"])
    assert row_diff(a, b, ["k"], compare=[]).isEmpty()


@pytest.mark.parametrize("seed", [7, 8])
def test_blocks_give_the_same_difference(spark, seed):
    a = random_side(seed) + [(None, "x", 1)]
    b = [(k, v, w) if k is None or k % 50 else (k, "changed", w) for k, v, w in a if k != 77] + [(1000, None, None)]
    x, y = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    for null_equal in (True, False):
        plain = row_diff(x, y, ["k"], null_equal=null_equal, unique_keys=True)
        assert rows(row_diff(x, y, ["k"], null_equal=null_equal, unique_keys=True, blocks=(8, 8))) == rows(plain)
    with pytest.raises(ValueError, match="unique_keys"):
        row_diff(x, y, ["k"], blocks=(8,))


def test_equal_blocks_are_not_shuffled(spark):
    x = spark.range(20_000).selectExpr("id AS k", "concat('a', id) AS a", "CAST(NULL AS int) AS b")
    y = x.withColumn("a", F.when(F.col("k") != 5, F.col("a"))).where("k <> 6")
    t, c = diff.differing_rows(x, y, ["k"], (64, 64))
    assert 2 <= t.count() <= 40 and t.count() == c.count() + 1
    same = diff.differing_rows(x, x, ["k"], (64, 64))
    assert [s.count() for s in same] == [0, 0]
    # a value that changes places with NULL, and two rows that change theirs
    z = x.withColumn("b", F.when(F.col("k") == 9, 0))
    assert diff.differing_rows(x, z, ["k"], (64,))[0].where("k = 9").count() == 1
    swapped = x.withColumn("a", F.when(F.col("k") == 1, "a2").when(F.col("k") == 2, "a1").otherwise(F.col("a")))
    assert diff.differing_rows(x, swapped, ["k"], (1,))[0].count() == 20_000
