"""A snapshot's constraints on the rows of all databases of a fleet, each table read once however many it has."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetschema.functions.text import spark_expression
from fleetschema.operators.exclusion import count_excluded, parse_exclusion
from fleetschema.operators.rows import named
from fleetschema.staging import stage

_RULE = ["type", "expression", "cols", "ref_table", "ref_cols"]
_FOUND = "db_id int, schema_name string, table_name string, name string, type string, n long"


def _rules(s: Mapping[str, DataFrame], side: str, schema: str, table: str, max_rules: int) -> tuple[DataFrame, list[dict]]:
    """(db_id, name, k) of a table's constraints, and the distinct rules k; columns are named by their numbers."""
    tables = s[f"{side}_tables"].select("db_id", F.col("oid").alias("table_oid"), "schema_name", F.col("name").alias("table_name"))
    mine = tables.where((F.col("schema_name") == schema) & (F.col("table_name") == table))
    found = s[f"{side}_constraints"].join(mine.select("db_id", "table_oid"), ["db_id", "table_oid"])
    names = s[f"{side}_columns"].groupBy("db_id", "table_oid").agg(F.map_from_entries(F.collect_list(F.struct("attnum", "name"))).alias("of"))
    other = names.select("db_id", F.col("table_oid").alias("ref_table_oid"), F.col("of").alias("ref_of"))
    parents = tables.select("db_id", F.col("table_oid").alias("ref_table_oid"), F.concat_ws("\0", "schema_name", "table_name").alias("ref_table"))
    numbered = lambda cols, of: F.transform(F.coalesce(F.col(cols), F.array().cast("array<int>")), lambda k: F.col(of)[k])
    said = (
        found.join(names, ["db_id", "table_oid"], "left")
        .join(other, ["db_id", "ref_table_oid"], "left")
        .join(parents, ["db_id", "ref_table_oid"], "left")
        .select("db_id", "name", "type", "expression", numbered("cols", "of").alias("cols"), "ref_table", numbered("ref_cols", "ref_of").alias("ref_cols"))
        # the text of a key says no more than its columns, which catalogs may write in several ways
        .withColumn("expression", F.when(F.col("type").isin("c", "x"), F.col("expression")))
    )
    said = stage(said.withColumn("rule", F.sha2(F.to_json(F.struct(*_RULE)), 256)), "rules")
    distinct = said.groupBy("rule").agg(*[F.first(c).alias(c) for c in _RULE]).limit(max_rules + 1).collect()
    if len(distinct) > max_rules:
        raise ValueError(f"{schema}.{table} has over {max_rules} different constraints in the fleet")
    distinct.sort(key=lambda r: r["rule"])
    numbers = said.sparkSession.createDataFrame([(r["rule"], k) for k, r in enumerate(distinct)], "rule string, k int")
    return said.join(numbers, "rule").select("db_id", "name", "type", "k"), [r.asDict() for r in distinct]


def _key(columns: list[str]) -> Column:
    return F.array(*[named(c).cast("string") for c in columns])


def _entry(k: int, key: Column) -> Column:
    return F.struct(F.lit(k).alias("k"), key.cast("array<string>").alias("key"))


def fleet_violations(
    s: Mapping[str, DataFrame],
    tables: Mapping[tuple[str, str], DataFrame],
    side: str = "target",
    ranges: Mapping[str, tuple[str, str, str]] | None = None,
    max_rules: int = 500,
) -> DataFrame:
    """How often the rows of every database break its constraints: (db_id, schema_name, table_name, name, type, n).

    ``tables`` has the rows of all databases by (schema, name), with ``db_id``.
    A row gives one small entry for each key it has, and one for each check it
    breaks; entries are counted by (database, constraint, key) before one shuffle,
    so a table is read once for all its keys and checks. The same counts are met
    with the parents' keys, read once for each parent. Databases that share a
    constraint share its entry; the driver holds the distinct ones.

    ``n`` counts broken keys of p and u, rows of c and f, and rows of x that conflict with any other. Exclusion constraints
    are read a second time (``excluded_rows``; ``ranges`` as in ``parse_exclusion``);
    one that is written in other operators, and a foreign key to a table that is
    not given, have ``n`` NULL. Keys are compared by their text. Rows without a
    ``db_id`` belong to no database; a database without rows has counts of zero.
    """
    spark = next(iter(s.values())).sparkSession
    parts, rules_of = [], {t: _rules(s, side, *t, max_rules) for t in tables}
    parents: dict[tuple[str, str], dict[tuple[str, ...], DataFrame]] = {}
    for (schema, table), (members, rules) in rules_of.items():
        if not rules:
            continue
        held = members.groupBy("db_id").agg(F.collect_set("k").alias("__ks"))
        # a database has one row here, so a hot one is split by adaptive execution
        rows = tables[schema, table].join(held, "db_id")
        entries = []
        for k, r in enumerate(rules):
            if r["type"] in ("p", "u"):
                entries.append(F.when(F.array_contains("__ks", k), _entry(k, _key(r["cols"]))))
            elif r["type"] == "f" and tuple((r["ref_table"] or "").split("\0")) in tables:
                whole = reduce(Column.__and__, [named(c).isNotNull() for c in r["cols"]])
                entries.append(F.when(F.array_contains("__ks", k) & whole, _entry(k, _key(r["cols"]))))
            elif r["type"] == "c":
                broken = ~F.expr(spark_expression(r["expression"]))
                entries.append(F.when(F.array_contains("__ks", k) & broken, _entry(k, F.array(F.lit("")))))
        if entries:
            each = rows.select("db_id", F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
            counted = stage(each.groupBy("db_id", "e.k", "e.key").agg(F.count(F.lit(1)).alias("n")), "entries")
            kinds = {t: [k for k, r in enumerate(rules) if r["type"] == t] for t in "pucf"}
            null = F.exists("key", lambda x: x.isNull())
            repeated = (F.col("k").isin(kinds["u"]) & (F.col("n") > 1) & ~null) | (F.col("k").isin(kinds["p"]) & ((F.col("n") > 1) | null))
            keys = counted.where(repeated).groupBy("db_id", "k").agg(F.count(F.lit(1)).alias("n"))
            checks = counted.where(F.col("k").isin(kinds["c"])).groupBy("db_id", "k").agg(F.sum("n").alias("n"))
            found = keys.unionByName(checks)
            there = [k for k in kinds["f"] if tuple((rules[k]["ref_table"] or "").split("\0")) in tables]
            if there:
                found = found.unionByName(_orphans(counted.where(F.col("k").isin(there)), rules, there, tables))
            found = members.join(found, ["db_id", "k"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        else:
            found, there = members.withColumn("n", F.lit(0).cast("long")), []
        for k, r in enumerate(rules):
            if r["type"] == "x":
                found = _with_excluded(found, k, rows, parse_exclusion(r["expression"], ranges))
        unknown = [k for k, r in enumerate(rules) if r["type"] == "f" and k not in there]
        n = F.when(~F.col("k").isin(unknown), F.col("n")) if unknown else F.col("n")
        head = [F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name")]
        parts.append(found.select("db_id", *head, "name", "type", n.cast("long").alias("n")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _FOUND)


def _orphans(counted: DataFrame, rules: list[dict], there: list[int], tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows whose key no parent has, by (database, rule); a parent is read once for all rules that refer to it."""
    by_parent: dict[tuple[str, ...], list[int]] = {}
    for k in there:
        by_parent.setdefault(tuple(rules[k]["ref_table"].split("\0")), []).append(k)
    parents = [
        tables[parent].select("db_id", F.inline(F.array(*[_entry(k, _key(rules[k]["ref_cols"])) for k in ks])))
        for parent, ks in by_parent.items()
    ]
    missing = counted.join(reduce(DataFrame.unionByName, parents), ["db_id", "k", "key"], "left_anti")
    return missing.groupBy("db_id", "k").agg(F.sum("n").alias("n"))


def _with_excluded(found: DataFrame, k: int, rows: DataFrame, rule) -> DataFrame:
    if rule is None:
        return found.withColumn("n", F.when(F.col("k") != k, F.col("n")))
    mine = rows.where(F.array_contains("__ks", k)).drop("__ks")
    n = count_excluded(mine, rule, by="db_id").select("db_id", F.lit(k).alias("k"), F.col("n").alias("__n"))
    joined = found.join(n, ["db_id", "k"], "left")
    return joined.withColumn("n", F.coalesce("__n", "n")).drop("__n")
