import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.functions.ordering import numbered
from fleetschema.functions.text import declared_chars, spark_expression, spark_type
from fleetschema.operators import rows


def test_validate_not_null_without_groups(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert tuple(rows.validate_not_null(df, ["a", "b"]).first()) == (3, 1, 2)


def test_unique_and_primary(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None), (2, 1)], "a int, b int")
    assert sorted(tuple(r) for r in rows.validate_unique(df, ["a", "b"]).collect()) == [(1, 1, 2)]
    primary = rows.validate_unique(df, ["a", "b"], primary=True).collect()
    assert {tuple(r) for r in primary} == {(1, 1, 2), (1, None, 2)}


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (None, 9), (3, None), (4, 4)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "x int, y int")
    out = rows.validate_foreign_key(child, parent, ["a", "b"], ["x", "y"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (4, 4)]
    keys = rows.orphan_keys(child.unionByName(child), parent, ["a", "b"], ["x", "y"])
    assert sorted(tuple(r) for r in keys.collect()) == [(1, 2, 2), (4, 4, 2)]


def test_check_lets_null_pass(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    assert [r["a"] for r in rows.validate_check(df, "a > 0").collect()] == [-1]


@pytest.mark.parametrize("seed", range(3))
def test_exclusion_against_brute_force(spark, seed):
    """Half of the rows share one key; some ends and starts are open."""
    r = random.Random(seed)
    base = datetime(2024, 1, 1)
    data = []
    for i in range(400):
        start = base + timedelta(minutes=r.randrange(20000))
        end = None if r.random() < 0.004 else start + timedelta(minutes=r.randrange(1, 60))
        key = 0 if r.random() < 0.5 else r.choice([1, 2, 3, None])
        data.append((i, key, None if r.random() < 0.004 else start, end))
    df = spark.createDataFrame(data, "id int, k int, s timestamp_ntz, e timestamp_ntz")
    got = {x["id"] for x in rows.validate_exclusion(df, ["k"], "s", "e", ["id"]).collect()}
    low, high = datetime.min, datetime.max
    want = set()
    for i, k, s, e in data:
        for j, k2, s2, e2 in data:
            earlier = (s2 or low, j) < (s or low, i)
            if k is not None and k == k2 and earlier and (e2 or high) > (s or low):
                want.add(i)
    assert got == want


def test_numbering_splits_one_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("g"), F.hash("id").alias("h"), "id"
    )
    out = numbered(df, [F.col("h").desc(), F.col("id").asc()], ["g"], "n")
    want = spark.sql("SELECT 1").limit(0)  # noqa: F841
    df.createOrReplaceTempView("numbering")
    want = spark.sql("SELECT *, CAST(row_number() OVER (PARTITION BY g ORDER BY h DESC, id) AS BIGINT) AS n FROM numbering")
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def values(spark, count, **options):
    out = rows.assign_sequence(spark.range(count).select(F.col("id").alias("x")), ["x"], **options)
    return [r["id"] for r in out.orderBy("x").collect()]


def by_hand(count, start, increment, low, high, cycle):
    out, v = [], start
    for _ in range(count):
        if not low <= v <= high:
            assert cycle
            v = low if increment > 0 else high
        out.append(v)
        v += increment
    return out


@pytest.mark.parametrize(
    "start,increment,low,high,cycle",
    [(1, 1, 1, 1000, False), (5, 3, 2, 20, True), (7, -2, -4, 9, True), (10, -1, -500, 10, False), (1, 7, 1, 3, True)],
)
def test_assign_sequence(spark, start, increment, low, high, cycle):
    got = values(spark, 97, start=start, increment=increment, min_value=low, max_value=high, cycle=cycle)
    assert got == by_hand(97, start, increment, low, high, cycle)


def test_sequence_defaults_and_exhaustion(spark):
    assert values(spark, 3) == [1, 2, 3]
    assert values(spark, 3, increment=-1) == [-1, -2, -3]
    assert values(spark, 3, increment=-1, cycle=True) == [-1, -2, -3]
    with pytest.raises(ValueError, match="11 rows"):
        values(spark, 11, max_value=10)
    with pytest.raises(ValueError, match="bounds"):
        values(spark, 1, start=0)


def test_rewrite_modes(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "id int, v string")
    out, failures = rows.rewrite_column_type(df, "v", "int4", on_error="null")
    assert out.schema["v"].dataType == T.IntegerType()
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 5), (2, None), (3, None)]
    assert tuple(failures.first()) == (1, 0)
    with pytest.raises(NumberFormatException):
        rows.rewrite_column_type(df, "v", "int4")[0].collect()
    cut, lost = rows.rewrite_column_type(spark.createDataFrame([("abcdef",), ("abc",), (None,)], "v string"), "v", "varchar", 7)
    assert [r["v"] for r in cut.collect()] == ["abc", "abc", None] and tuple(lost.first()) == (0, 1)


def test_type_names():
    assert spark_type("numeric", ((10 << 16) | 2) + 4) == T.DecimalType(10, 2)
    assert spark_type("numeric", -1) == T.DecimalType(38, 18)
    assert spark_type("_int4") == T.ArrayType(T.IntegerType())
    assert spark_type("timestamp") == T.TimestampNTZType()
    with pytest.raises(ValueError):
        spark_type("hstore")
    assert declared_chars("varchar", 14) == 10
    assert declared_chars("varchar", -1) is None
    assert declared_chars("int4", 14) is None


DIFF = "db_id int, schema_name string, table_name string, name string, type string, nullable boolean, length int, default_expr string, operation_type string"


def test_conform(spark):
    df = spark.createDataFrame([(1, "7", "a"), (2, "z", None)], "id int, v string, w string")
    def change(name, type_, nullable, default, op):
        return (1, "s", "t", name, type_, nullable, -1, default, op)
    changes = spark.createDataFrame(
        [
            change("v", "int4", False, None, "ALTER_TYPE"),
            change("w", "text", False, None, "SET_NOT_NULL"),
            change("x", "int8", False, "40 + 2", "ADD_COLUMN"),
            change("y", "int8", False, None, "ADD_COLUMN"),
            change("id", "int4", True, "1", "SET_DEFAULT"),
            (2, "s", "t", "other", "int4", True, -1, None, "ADD_COLUMN"),
        ],
        DIFF,
    )
    with pytest.raises(NumberFormatException):  # losing a value has to be asked for
        rows.conform_table(df, changes, 1, "s", "t")[0].collect()
    out, violations = rows.conform_table(df, changes, 1, "s", "t", on_error="null")
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 7, "a", 42, None), (2, None, None, 42, None)]
    assert sorted(tuple(r) for r in violations.collect()) == [
        ("v", "IS_NULL", 1), ("v", "NOT_CASTABLE", 1), ("w", "IS_NULL", 1), ("y", "IS_NULL", 2)
    ]
    same, none = rows.conform_table(df, changes, 3, "s", "t")
    assert same.columns == df.columns and none.isEmpty()


def test_names_with_a_dot(spark):
    df = spark.createDataFrame([(1, "5", None), (1, "long text", 2)], "`a.b` int, `c.d` string, `e``f` int")
    change = lambda name, type_, length, op: (1, "s", "t", name, type_, False, length, None, op)
    changes = spark.createDataFrame([change("c.d", "varchar", 8, "ALTER_TYPE"), change("e`f", "int4", -1, "SET_NOT_NULL")], DIFF)
    out, violations = rows.conform_table(df, changes, 1, "s", "t")
    assert [r["c.d"] for r in out.collect()] == ["5", "long"]
    assert sorted(map(tuple, violations.collect())) == [("c.d", "TRUNCATED", 1), ("e`f", "IS_NULL", 1)]
    assert [r["n"] for r in rows.validate_unique(df, ["a.b"]).collect()] == [2]
    assert tuple(rows.validate_not_null(df, ["a.b", "e`f"]).first()) == (2, 0, 1)
    parent = spark.createDataFrame([(2,)], "`x.y` int")
    assert rows.validate_foreign_key(df, parent, ["a.b"], ["x.y"]).count() == 2
    assert rows.orphan_keys(df, parent, ["e`f"], ["x.y"]).isEmpty()


def test_rebuilt_views_leave_nothing_behind(spark, tmp_path):
    spark.createDataFrame([(7,)], "x int").createOrReplaceTempView("v")
    before = {t.name for t in spark.catalog.listTables()}
    views = spark.createDataFrame(
        [(1, 1, "a", "v", "SELECT 1 AS x", False), (1, 2, "b", "v", "SELECT 2 AS x", False),
         (1, 3, "a", "w", "SELECT v.x, p.x AS y, 'a.v {x}' AS t FROM v JOIN b . v p ON true", True),
         (1, 4, "b", "w", "SELECT x FROM v", True)],
        "db_id int, oid long, schema_name string, name string, expression string, is_materialized boolean",
    )
    order = views.selectExpr("db_id", "oid", "CASE WHEN name = 'v' THEN 1 ELSE 2 END AS level", "false AS in_cycle")
    rows.rebuild_views(spark, order, views, str(tmp_path), {1: {}})
    assert tuple(spark.read.parquet(f"{tmp_path}/1/a/w").first()) == (1, 2, "a.v {x}")
    assert spark.read.parquet(f"{tmp_path}/1/b/w").first()["x"] == 2
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("v").first()["x"] == 7
    spark.catalog.dropTempView("v")


def test_catalog_texts(spark):
    one = spark.createDataFrame([(3, "it's")], "`Odd Name` int, t string")
    value = lambda text: one.selectExpr(spark_expression(text)).first()[0]
    assert value("'n/a'::character varying") == "n/a" and value("'it''s'::text = t") is True
    assert value(r"'a\b'::bpchar") == r"a\b" and value("'::text'") == "::text"
    assert value("(2)::numeric(10,2) + (1)::bigint") == 3 and value('"Odd Name"') == 3
    assert value("CHECK (((\"Odd Name\" > 0) AND (t <> 'x'::text)))") is True
    assert value("CHECK (((t)::text = ANY ((ARRAY['a'::character varying, 'it''s'::character varying])::text[])))") is True
    with pytest.raises(ValueError, match="assign_sequence"):
        spark_expression("nextval('s.q'::regclass)")
    assert spark_type("uuid") == T.StringType() and spark_type("oid") == T.LongType() and declared_chars('"char"', -1) == 1


CHECKS = {
    "CHECK (((t)::text ~~ 'a%'::text))": ["a", "abc"],
    "CHECK (((t)::text !~~ '%b%'::text))": ["a", "ABC", "x.y", "12", "né"],
    "((t)::text ~~* 'aB%'::text)": ["abc", "ABC"],
    "((t)::text !~~* 'ab%'::text)": ["a", "x.y", "12", "né"],
    r"((t)::text ~ '^\d+$'::text)": ["12"],
    r"(t ~ E'^\\d+$'::text)": ["12"],
    "((t)::text ~* '^ABC$'::text)": ["abc", "ABC"],
    "(t !~* ('a' || 'b'))": ["a", "x.y", "12", "né"],
    "((t)::text !~ '^[[:alpha:]]+$'::text)": ["x.y", "12"],
    r"(t ~ '\yy'::text)": ["x.y"],
    "((t)::text ~~ ANY (ARRAY['a%'::text, '%.y'::text]))": ["a", "abc", "x.y"],
    "((t)::text !~~ ALL ((ARRAY['a%'::character varying, '%.y'::character varying])::text[]))": ["ABC", "12", "né"],
    "((t)::text <> ALL (ARRAY['a'::text, 'abc'::text]))": ["ABC", "x.y", "12", "né"],
    "((length((t)::text) = ANY (ARRAY[1, 2])) AND (t IS NOT NULL))": ["a", "12", "né"],
    "(('2024-01-31'::date + '1 mon'::interval) = '2024-02-29'::timestamp without time zone) AND (t = 'a')": ["a"],
    "(('2024-01-01 00:00:00'::timestamp without time zone - '1 day 02:30:00.5'::interval) < '2023-12-30 21:29:59.6'::timestamp without time zone) AND (t = 'a')": ["a"],
    "(char_length(t) <= 2) AND NOT (t ~~ 'n_')": ["a", "12"],
}


@pytest.mark.parametrize("text", CHECKS)
def test_operators_of_catalog_texts(spark, text):
    values = ["a", "abc", "ABC", "x.y", "12", "né", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    kept = {r["t"] for r in df.subtract(rows.validate_check(df, text)).collect()} - {None}
    assert kept == set(CHECKS[text])


@pytest.mark.parametrize(
    "text",
    ["(a @> b)", "(a ^ 2)", "(p)::point", "a ~ '\\mx'", "a ~ ANY (ARRAY['x'])", "a = ANY (b)", "'1 fortnight'::interval", "(b)::interval", "a = ALL (ARRAY[1])", "(a ~~ )", "a -> 'x'", "x::inet", "(a"],
)
def test_what_has_no_counterpart_is_an_error(text):
    with pytest.raises(ValueError, match="no counterpart here"):
        spark_expression(text)


def test_casts_keep_a_numeric_scale(spark):
    assert str(spark.range(1).selectExpr(spark_expression("(2.345)::numeric(10,2)")).first()[0]) == "2.35"
    assert spark.range(1).selectExpr(spark_expression("(ARRAY['1'::text, '2'::text])::integer[]")).first()[0] == [1, 2]
    assert spark.range(1).selectExpr(spark_expression("'a.b'::text || s.\"X y\"").replace("s.`X y`", "'!'")).first()[0] == "a.b!"


READS = {
    "WITH a AS (SELECT 1 AS x) SELECT x, 'cte' AS y FROM a": [(1, "cte")],
    "WITH b AS (SELECT * FROM a), c AS (SELECT * FROM b) SELECT * FROM c": [(1, "a")],
    "SELECT a.x, b.y FROM a JOIN `s`.`b` ON a.x < b.x": [(1, "s.b")],
    "SELECT a.x, b.y FROM a, b": [(1, "s.b")],
    "SELECT x, y FROM a WHERE EXISTS (SELECT 1 FROM t.b WHERE b.x = 9)": [(1, "a")],
    "SELECT (SELECT max(x) FROM b) AS x, '{FROM a}' AS y": [(2, "{FROM a}")],
    "SELECT * FROM (SELECT * FROM A q) UNION ALL SELECT * FROM t.b": [(1, "a"), (9, "t.b")],
    "SELECT k.x, k.y FROM a AS k /* JOIN b */ -- FROM b": [(1, "a")],
    "WITH a AS (SELECT * FROM a) SELECT * FROM a": [(1, "a")],
    "SELECT x, y FROM (WITH b AS (SELECT 5 AS x, 'in' AS y) SELECT * FROM b) UNION ALL SELECT * FROM b": [(2, "s.b"), (5, "in")],
}


@pytest.mark.parametrize("text", READS)
def test_views_read_what_the_parser_says(spark, text, tmp_path):
    row = lambda x, y: spark.createDataFrame([(x, y)], "x int, y string")
    tables = {1: {"a": row(1, "a"), "s.b": row(2, "s.b"), "t.b": row(9, "t.b")}}
    views = spark.createDataFrame([(1, 5, "s", "v", text, True)], "db_id int, oid long, schema_name string, name string, expression string, is_materialized boolean")
    order = spark.createDataFrame([(1, 5, 1, False)], "db_id int, oid long, level int, in_cycle boolean")
    done = rows.rebuild_views(spark, order, views, str(tmp_path), tables)
    assert sorted(tuple(r) for r in spark.read.parquet(done.first()["path"]).select("x", "y").collect()) == READS[text]
