"""Row work on all databases at once: conformed tables, constraints, exclusion over several ranges, publishing."""

import json
import random

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from checks.queries import QUERIES, _fleet
from checks.env import env
from fleetschema.operators import actions, constraints, exclusion, fleet, rows, runlog
from fleetschema.plans import migration
from fleetschema.staging import new_folder
from tests.conftest import SF
from tests.test_skew import as_if_large, final_plan

DIFF = "db_id int, schema_name string, table_name string, name string, type string, nullable boolean, length int, default_expr string, operation_type string"


# ---- conform ----------------------------------------------------------------


def test_fleet_gives_what_each_database_gives_alone(spark):
    """Every database by ``conform_table`` on its own rows, in its own columns."""
    events, changes = _fleet(env(spark, SF))
    events = events.cache()
    conformed, violations = fleet.conform_fleet(events, changes, "app", "events", on_error="null")
    conformed, violations = conformed.toPandas(), {tuple(r) for r in violations.collect()}
    for db in (0, 1, 2):
        mine = events.where(F.col("db_id") == db)
        mine = mine.drop("region", "shard") if db < 2 else mine.drop("shard")
        mine = mine.withColumn("code", F.expr("try_cast(code AS int)")) if db == 1 else mine
        one, broken = rows.conform_table(mine, changes, db, "app", "events", on_error="null")
        got = conformed[conformed["db_id"] == db][one.columns].astype(object)
        want = one.toPandas().astype(object)
        assert sorted(map(str, got.where(got.notna(), None).values.tolist())) == sorted(map(str, want.where(want.notna(), None).values.tolist()))
        alone = {(db, *r) for r in broken.collect()}
        # a database that has the type already is read as it, so what does not convert counts here
        assert {v for v in violations if v[0] == db and not (db == 1 and v[1] == "code")} == alone
    events.unpersist()


def test_work_grows_with_classes_and_not_with_databases(spark):
    def of(databases):
        change = [("s", "t", "a", "int4", False, -1, None, "ALTER_TYPE"), ("s", "t", "b", "text", True, -1, "'x'", "ADD_COLUMN")]
        diff = spark.createDataFrame([(db, *c) for db in range(databases) for c in change[: 1 + db % 2]], DIFF)
        df = spark.createDataFrame([(db, str(db)) for db in range(databases)], "db_id int, a string")
        tracker, group = spark.sparkContext.statusTracker(), f"fleet-{databases}"
        spark.sparkContext.setJobGroup(group, group)
        out, broken = fleet.conform_fleet(df, diff, "s", "t")
        found = {tuple(r) for r in out.collect()}
        broken.collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert found == {(db, db, "x" if db % 2 else None) for db in range(databases)}
        return len(tracker.getJobIdsForGroup(group)), len(fleet.signature_classes(diff, "s", "t")[1])

    few, many = of(4), of(200)
    assert few[1] == many[1] == 2 and many[0] <= few[0] + 2


def test_the_rows_are_read_once_for_the_projection(spark):
    text = QUERIES["r08_conform_fleet"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReadSchema: struct<event_id") == 1


def test_conform_cases(spark):
    diff = lambda *r: spark.createDataFrame([(db, "s", "t", *x) for db, x in r], DIFF)
    df = spark.createDataFrame([(1, "1"), (2, "x"), (None, "3"), (3, None)], "db_id int, a string")
    retype = ("a", "int4", True, -1, None, "ALTER_TYPE")
    out, broken = fleet.conform_fleet(df, diff((1, retype), (2, retype)), "s", "t", on_error="null")
    assert {tuple(r) for r in out.collect()} == {(1, 1), (2, None), (None, 3), (3, None)}
    assert {tuple(r) for r in broken.collect()} == {(2, "a", "NOT_CASTABLE", 1)}
    out, broken = fleet.conform_fleet(df, diff(), "s", "t")
    assert out.columns == df.columns and out.count() == 4 and broken.collect() == []
    out, broken = fleet.conform_fleet(df.limit(0), diff((1, retype)), "s", "t")
    assert out.collect() == [] == broken.collect()
    with pytest.raises(ValueError, match="target type of a"):
        fleet.conform_fleet(df, diff((1, retype), (2, ("a", "float8", True, -1, None, "ALTER_TYPE"))), "s", "t")
    with pytest.raises(ValueError, match="lack"):
        fleet.conform_fleet(df, diff((1, ("z", "int4", True, -1, None, "ALTER_TYPE"))), "s", "t")
    with pytest.raises(ValueError, match="over 1 ways"):
        fleet.signature_classes(diff((1, retype), (2, ("b", "int4", True, -1, None, "ADD_COLUMN"))), "s", "t", max_classes=1)


def test_databases_that_have_an_added_column_keep_it(spark):
    diff = spark.createDataFrame([(1, "s", "t", "b", "varchar", False, 6, "'long text'", "ADD_COLUMN")], DIFF)
    df = spark.createDataFrame([(1, None), (2, "own and longer"), (3, None)], "db_id int, b string")
    out, broken = fleet.conform_fleet(df, diff, "s", "t")
    assert {tuple(r) for r in out.collect()} == {(1, "lo"), (2, "own and longer"), (3, None)} and broken.collect() == []


# ---- exclusion --------------------------------------------------------------


def overlaps(a, b, c, d, bounds):
    low, high = float("-inf"), float("inf")
    a, c = (low if x is None else x for x in (a, c))
    b, d = (high if x is None else x for x in (b, d))
    filled = (a <= b and c <= d) if bounds == "[]" else (a < b and c < d)
    return filled and ((a <= d and c <= b) if bounds == "[]" else (a < d and c < b))


@pytest.mark.parametrize("seed", range(4))
def test_boxes_against_all_pairs(spark, seed):
    """Very different sizes, open bounds, empty ranges and NULLs; half of the rows lie in one place."""
    r = random.Random(seed)
    bounds = [("[)", "[]"), ("[]", "()"), ("(]", "[)"), ("[]", "[]")][seed]

    def span():
        if r.random() < 0.4:
            a = r.randrange(0, 6)
        else:
            a = r.randrange(-300, 300)
        b = a + r.choice([0, 0, 1, 2, 5, 40, 400]) - (r.random() < 0.05)
        return None if r.random() < 0.03 else a, None if r.random() < 0.03 else b

    data = [(i, r.choice([1, 1, 1, 2, None]), *span(), *span(), r.choice(["x", "y", "z", None])) for i in range(150)]
    df = spark.createDataFrame(data, "id int, k int, a int, b int, c int, d int, v string")
    df = df.withColumns({c: F.col(c).cast("double") for c in "cd"}) if seed % 2 else df
    rule = exclusion.Exclusion(["k"], [("a", "b", bounds[0]), ("c", "d", bounds[1])], ["v"] if seed < 2 else [])

    def conflict(x, y):
        same = x[1] is not None and x[1] == y[1] and overlaps(*x[2:4], *y[2:4], bounds[0]) and overlaps(*x[4:6], *y[4:6], bounds[1])
        return same and (seed >= 2 or (None not in (x[6], y[6]) and x[6] != y[6]))

    got = sorted(x["id"] for x in exclusion.excluded_rows(df, rule, ["id"]).collect())
    assert got == sorted({y[0] for y in data for x in data if x[0] < y[0] and conflict(x, y)}) and got
    either = {x["k"]: x["n"] for x in exclusion.count_excluded(df.drop("id"), rule, "k").collect()}
    want = {}
    for y in data:
        if any(x[0] != y[0] and conflict(x, y) for x in data):
            want[y[1]] = want.get(y[1], 0) + 1
    assert either == want


def test_one_value_by_key(spark):
    data = [(1, 1, "a"), (2, 1, "a"), (3, 1, "b"), (4, 1, "a"), (5, 2, "c"), (6, 2, "c"), (7, 2, None), (8, None, "d")]
    df = spark.createDataFrame(data, "id int, k int, v string")
    rule = exclusion.Exclusion(["k"], [], ["v"])
    assert sorted(r["id"] for r in exclusion.excluded_rows(df, rule, ["id"]).collect()) == [3, 4]
    assert {tuple(r) for r in exclusion.count_excluded(df, rule, "k").collect()} == {(1, 4)}
    everywhere = exclusion.Exclusion([], [], ["v"])
    assert sorted(r["id"] for r in exclusion.excluded_rows(df, everywhere, ["id"]).collect()) == [3, 4, 5, 6, 8]
    assert exclusion.excluded_rows(df.limit(0), rule, ["id"]).collect() == []


def test_a_hot_cell_is_split(spark):
    """All boxes in one cell: adaptive execution divides the task of the semi join."""
    df = spark.range(0, 4000, 1, 12).selectExpr("id AS o0", "1 AS e0", "5 AS s0", "6 AS t0", "concat(id, repeat('x', 100)) AS d0")
    rule = exclusion.Exclusion(["k"], [("c", "d", "[)")], ["v"])
    with as_if_large(spark):
        boxes = exclusion._by_cells(df, rule, ["o0"], False)
        assert "skew=true" in final_plan(boxes) and boxes.count() == 3999


def test_clauses_of_catalogs():
    text = """EXCLUDE USING gist (room WITH =, "From Day" WITH <>, tsrange(a, "B b", '[]'::text) WITH &&, span WITH &&) WHERE ((room > 3))"""
    rule = exclusion.parse_exclusion(text, {"span": ("lo", "hi", "[)")})
    assert rule == exclusion.Exclusion(["room"], [("a", "B b", "[]"), ("lo", "hi", "[)")], ["From Day"], "((room > 3))")
    assert exclusion.parse_exclusion(text) is None
    assert exclusion.parse_exclusion("EXCLUDE USING gist (lower(a) WITH =, b WITH &&)", {"b": ("x", "y", "[)")}) is None
    assert exclusion.parse_exclusion("EXCLUDE USING gist (a WITH @>)") is None
    with pytest.raises(ValueError, match="bounds"):
        exclusion.Exclusion([], [("a", "b", "<>")])
    with pytest.raises(ValueError, match="validate_unique"):
        exclusion.Exclusion(["a"])


# ---- constraints ------------------------------------------------------------


def catalog(spark, tables, rules):
    """Snapshots of databases 1 and 2 that hold the same tables."""
    oid = {t: k for k, t in enumerate(tables, 10)}
    at = lambda t, cols: None if cols is None else [tables[t].index(c) + 1 for c in cols]
    return {
        "target_tables": spark.createDataFrame([(db, o, "s", t, "r") for db in (1, 2) for t, o in oid.items()], migration.SNAPSHOT_COLUMNS["tables"]),
        "target_columns": spark.createDataFrame(
            [(db, o, c, k) for db in (1, 2) for t, o in oid.items() for k, c in enumerate(tables[t], 1)], "db_id int, table_oid long, name string, attnum int"
        ),
        "target_constraints": spark.createDataFrame(
            [(db, n, name, kind, oid[t], oid.get(ref), at(t, cols), at(ref, ref_cols) if ref in oid else None, text, "a", "a")
             for n, (dbs, name, kind, t, cols, ref, ref_cols, text) in enumerate(rules) for db in dbs],
            migration.SNAPSHOT_COLUMNS["constraints"],
        ),
    }


def test_fleet_counts_what_each_database_counts_alone(spark):
    r = random.Random(8)
    parent = [(db, k, r.choice("uv")) for db in (1, 2) for k in range(20) for _ in range(1 + (r.random() < 0.2))]
    child = [(r.choice([1, 2, None]), r.choice([None, *range(25)]), r.choice([None, *range(4)]), r.randrange(9)) for _ in range(300)]
    given = {
        ("s", "parent"): spark.createDataFrame(parent, "db_id int, id int, tag string"),
        ("s", "child"): spark.createDataFrame(child, "db_id int, ref int, part int, v int"),
    }
    s = catalog(spark, {"parent": ["db_id", "id", "tag"], "child": ["db_id", "ref", "part", "v"], "far": ["id"]}, [
        ([1, 2], "pk", "p", "parent", ["id"], None, None, "PRIMARY KEY (id)"),
        ([1], "ck", "p", "child", ["ref", "part"], None, None, "PRIMARY KEY (ref, part)"),
        ([2], "cu", "u", "child", ["ref", "part"], None, None, "UNIQUE (ref, part)"),
        ([1, 2], "fk", "f", "child", ["ref"], "parent", ["id"], "FOREIGN KEY (ref) REFERENCES parent(id)"),
        ([2], "fk2", "f", "child", ["v"], "parent", ["id"], "FOREIGN KEY (v) REFERENCES parent(id)"),
        ([1], "lost", "f", "child", ["v"], "far", ["id"], "FOREIGN KEY (v) REFERENCES far(id)"),
        ([1, 2], "ch", "c", "child", ["v"], None, None, "CHECK ((v < 5))"),
        ([2], "ch", "c", "parent", ["tag"], None, None, "CHECK (((tag)::text = 'u'::text))"),
    ])
    got = {tuple(x) for x in constraints.fleet_violations(s, given).collect()}
    want = set()
    for db in (1, 2):
        mine = {t: df.where(F.col("db_id") == db) for t, df in given.items()}
        want |= {(db, *x) for x in rows.constraint_violations(s, db, mine).collect()}
    assert got == want and len(want) == 11
    nothing = constraints.fleet_violations(s, {t: df.limit(0) for t, df in given.items()}).collect()
    assert {x["n"] for x in nothing} == {0, None} and len(nothing) == 11


def test_a_table_is_read_once_for_all_its_keys_and_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("1 AS db_id", "id AS a", "id % 7 AS b", "id % 3 AS c").write.parquet(path)
    cols = ["db_id", "a", "b", "c"]
    s = catalog(spark, {"t": cols}, [([1, 2], f"u{c}", "u", "t", [c], None, None, "") for c in "abc"] + [
        ([1], f"c{k}", "c", "t", ["a"], None, None, f"CHECK ((a < {k}))") for k in range(5)
    ])
    reads = []
    held = constraints.stage
    constraints.stage = lambda df, label: (reads.append(df._jdf.queryExecution().executedPlan().toString()) if label == "entries" else None, held(df, label))[1]
    try:
        got = {(x["db_id"], x["name"]): x["n"] for x in constraints.fleet_violations(s, {("s", "t"): spark.read.parquet(path)}).collect()}
    finally:
        constraints.stage = held
    assert len(reads) == 1 and reads[0].count("FileScan parquet") - reads[0].count("ReadSchema: struct<db_id:int,name:string") <= 2
    assert reads[0].count("ReadSchema: struct<db_id:int,a:bigint") == 1
    assert got[1, "ua"] == 0 and got[1, "ub"] == 7 and got[1, "uc"] == 3 and [got[1, f"c{k}"] for k in range(5)] == [100 - k for k in range(5)]
    assert got[2, "ua"] == 0


# ---- publishing -------------------------------------------------------------


def published(spark, path, schema):
    out = {}
    for r in runlog.read_published(spark, path, schema).collect():
        out.setdefault(r["db_id"], []).append((r["version"], r["x"]))
    return {db: sorted(v) for db, v in out.items()}


def test_a_run_that_breaks_off_is_repeated(spark, monkeypatch):
    path = new_folder(spark, "publish-test")
    rows_ = spark.createDataFrame([(db, x) for db in range(4) for x in range(db + 1)] + [(None, 9)], "db_id int, x int")
    gate = spark.createDataFrame([(db, db != 3) for db in range(5)], "db_id int, publish boolean")
    assert {tuple(r)[:2] + (r["n_rows"],) for r in runlog.publish_databases(rows_, gate, path, 1).collect()} == {(0, 1, 1), (1, 1, 2), (2, 1, 3), (4, 1, 0)}
    first = {0: [(1, 0)], 1: [(1, 0), (1, 1)], 2: [(1, 0), (1, 1), (1, 2)]}
    assert published(spark, path, rows_.schema) == first

    newer, everyone = rows_.withColumn("x", F.col("x") + 10), gate.withColumn("publish", F.lit(True))
    commit = runlog._commit

    def broken(made, at):  # one database's manifest appears, then the run dies
        commit(made.where("db_id = 1"), at)
        raise RuntimeError("killed")

    monkeypatch.setattr(runlog, "_commit", broken)
    with pytest.raises(RuntimeError, match="killed"):
        runlog.publish_databases(newer, everyone, path, 2)
    monkeypatch.setattr(runlog, "_commit", commit)
    # each database is as a whole of one version
    assert published(spark, path, rows_.schema) == first | {1: [(2, 10), (2, 11)]}
    again = runlog.publish_databases(newer, everyone, path, 2)
    assert {r["db_id"] for r in again.collect()} == {0, 2, 3, 4}
    assert published(spark, path, rows_.schema) == {db: [(2, 10 + x) for x in range(db + 1)] for db in range(4)}
    assert runlog.publish_databases(newer, everyone, path, 2).collect() == []
    assert runlog.manifests(spark, path).groupBy("db_id", "version").count().where("count > 1").count() == 0


def test_a_short_write_publishes_nothing(spark, monkeypatch):
    """Rows of database 2 are gone when what was written is counted."""
    path = new_folder(spark, "publish-test")
    rows_ = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "db_id int, x int")
    gate = spark.createDataFrame([(1, True), (2, True)], "db_id int, publish boolean")
    reader = DataFrameReader.parquet

    def short(self, *paths, **options):
        found = reader(self, *paths, **options)
        return found.where("db_id <> 2 OR x = 1") if "/data/" in paths[0] else found

    monkeypatch.setattr(DataFrameReader, "parquet", short)
    with pytest.raises(RuntimeError, match="1 databases were not written whole"):
        runlog.publish_databases(rows_, gate, path, 1)
    monkeypatch.setattr(DataFrameReader, "parquet", reader)
    assert runlog.manifests(spark, path).collect() == [] == runlog.read_published(spark, path, rows_.schema).collect()
    assert runlog.abandoned_attempts(spark, path).count() == 1


# ---- foreign-key actions ----------------------------------------------------


def effects(data, fks, deleted, updated):
    """Row by row, until nothing more is reached."""
    met, blocked = {}, []
    frontier = {(t, "DELETE", (), r) for t, ids in deleted.items() for r in ids} | {(t, "UPDATE", c, r) for t, (c, ids) in updated.items() for r in ids}
    depth = 0
    while frontier:
        met |= {e: depth for e in frontier}
        found = set()
        for t, effect, columns, row in frontier:
            for k in (k for k in fks if k.parent == t and (effect == "DELETE" or set(k.ref_cols) & set(columns))):
                action = k.on_delete if effect == "DELETE" else k.on_update
                value = [data[t][row][c] for c in k.ref_cols]
                for child, v in data[k.child].items():
                    if None in value or [v[c] for c in k.cols] != value:
                        continue
                    if action in "ar":
                        blocked.append((k, action, child, depth + 1))
                    elif action == "c" and effect == "DELETE":
                        found.add((k.child, "DELETE", (), child))
                    else:
                        found.add((k.child, {"n": "SET_NULL", "d": "SET_DEFAULT", "c": "UPDATE"}[action], k.cols, child))
        frontier, depth = found - met.keys(), depth + 1
    gone = {(t, r) for t, e, _, r in met if e == "DELETE"}
    out = {(t, r, e, ",".join(c)): d for (t, e, c, r), d in met.items() if e == "DELETE" or (t, r) not in gone}
    for k, action, child, d in blocked:
        if not ((k.child, child) in gone if action == "a" else child in deleted.get(k.child, ())):
            key = (k.child, child, "RESTRICTED", ",".join(k.cols))
            out[key] = min(d, out.get(key, d))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_actions_against_row_by_row(spark, seed):
    """Three tables that refer to each other in a cycle and to themselves, with every action."""
    r = random.Random(seed)
    pick = lambda: r.choice("arcnd")
    fk = actions.ForeignKey
    fks = [
        fk("b", ("x",), "a", ("id",), "c", pick()), fk("c", ("x",), "b", ("id",), "c" if seed else "n", pick()), fk("a", ("x",), "c", ("id",), pick(), "c"),
        fk("b", ("y",), "b", ("id",), pick(), pick()), fk("c", ("y",), "b", ("x",), pick(), pick()), fk("a", ("y",), "a", ("id",), "c", pick()),
    ]
    data = {t: {i: {"id": i, "x": r.choice([None, *range(25)]), "y": r.choice([None, *range(25)])} for i in range(25)} for t in "abc"}
    frames = {t: spark.createDataFrame([(v["id"], v["x"], v["y"]) for v in rows_.values()], "id int, x int, y int") for t, rows_ in data.items()}
    deleted, updated = {"a": [1, 2], "b": [3]}, {"b": (("id",), [5, 6])}
    ids = lambda some: spark.createDataFrame([(i,) for i in some], "id int")
    got = actions.foreign_key_effects(
        frames, {t: ["id"] for t in "abc"}, fks, {t: ids(v) for t, v in deleted.items()}, {t: (c, ids(v)) for t, (c, v) in updated.items()}
    )
    want = effects(data, fks, deleted, updated)
    assert {(x["table_name"], json.loads(x["key"])["id"], x["effect"], x["columns"]): x["depth"] for x in got.collect()} == want


def test_actions_stay_in_a_database(spark):
    parent = spark.createDataFrame([(1, 1), (2, 1)], "db_id int, id int")
    child = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (None, 11, 1)], "db_id int, id int, ref int")
    fk = actions.ForeignKey("child", ("ref",), "parent", ("id",), "c")
    tables, keys = {"parent": parent, "child": child}, {"parent": ["id"], "child": ["id"]}
    got = actions.foreign_key_effects(tables, keys, [fk], {"parent": parent.where("db_id = 2")}, by=["db_id"])
    assert {(x["table_name"], x["key"], x["depth"]) for x in got.collect()} == {("parent", '{"db_id":2,"id":1}', 0), ("child", '{"db_id":2,"id":10}', 1)}
    assert actions.foreign_key_effects(tables, keys, [fk]).collect() == []
