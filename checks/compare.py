"""Runs queries on Spark and their SQL on DuckDB, and compares whole results."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.env import TABLES  # noqa: E402
from checks.queries import QUERIES, oracle_sql  # noqa: E402
from checks.session import prepared  # noqa: E402


def local_spark(cpus: str = "8", partitions: int = 8) -> SparkSession:
    return prepared(
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(df: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(v) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 9))
        return str(v)

    ordered = df[sorted(df.columns)]
    return sorted(tuple(text(v) for v in r) for r in ordered.astype(object).where(ordered.notna(), None).itertuples(index=False))


def compare(spark: SparkSession, con, name: str, sf_dir: str, sql: str) -> str | None:
    """None when the results are the same, else what differs."""
    got = QUERIES[name](spark, sf_dir)
    table = got.toArrow().to_pandas(types_mapper=pd.ArrowDtype)
    want_arrow = con.sql(sql).to_arrow_table()
    want = want_arrow.to_pandas(types_mapper=pd.ArrowDtype)
    if sorted(table.columns) != sorted(want.columns):
        return f"columns {sorted(table.columns)} / {sorted(want.columns)}"
    kinds = {c: (str(table[c].dtype), str(want[c].dtype)) for c in table.columns if str(table[c].dtype).replace("large_", "") != str(want[c].dtype).replace("large_", "")}
    kinds = {c: k for c, k in kinds.items() if not all("timestamp" in x for x in k)}
    if len(table) != len(want):
        return f"{len(table)} rows / {len(want)} rows {kinds or ''}"
    a, b = rows_of(table), rows_of(want)
    if a != b:
        first = next((x, y) for x, y in zip(a, b, strict=True) if x != y)
        return f"rows differ, first {first}"
    return f"types {kinds}" if kinds else None


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opt = args.parse_args()
    spark, con, sql = local_spark(), duck(opt.sf), oracle_sql()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in QUERIES:
        if opt.names and not any(name.startswith(n) for n in opt.names):
            continue
        started = time.time()
        try:
            problem = compare(spark, con, name, opt.sf, sql[name]) if name in sql else "no SQL"
        except Exception as x:  # noqa: BLE001
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
