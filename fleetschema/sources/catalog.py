"""Catalog exports of the fleet: one parquet table per catalog relation and side, in folders of several databases."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetschema.staging import stage

SIDES = ("target", "current")

# The catalog relations and the columns of each that are read.
RELATIONS: dict[str, str] = {
    "namespace": "oid long, nspname string",
    "class": "oid long, relnamespace long, relname string, relkind string",
    "attribute": "attrelid long, attname string, atttypid long, atttypmod int, attnum int, attnotnull boolean, attisdropped boolean",
    "type": "oid long, typname string",
    "attrdef": "oid long, adrelid long, adnum int",
    "constraint": "oid long, conname string, contype string, connamespace long, conrelid long, confrelid long, "
    "conindid long, conkey array<smallint>, confkey array<smallint>, confdeltype string, confupdtype string",
    "index": "indexrelid long, indrelid long",
    "sequence": "seqrelid long, seqtypid long, seqstart long, seqmin long, seqmax long, seqincrement long, seqcycle boolean",
    "depend": "objid long, refobjid long, deptype string",
    "rewrite": "oid long, ev_class long",
    "proc": "oid long, pronamespace long, proname string",
    "trigger": "oid long, tgrelid long, tgname string, tgisinternal boolean",
    # texts deparsed by the server: view, index, constraint, function, default and trigger
    "definitions": "object_type string, object_oid long, definition string",
}


def shaped(df: DataFrame, relation: str) -> DataFrame:
    """The columns of a relation, cast; a column that an export does not have is NULL."""
    wanted = [f.strip().rsplit(" ", 1) for f in RELATIONS[relation].split(",")]
    return df.select(
        *[F.col("db_id").cast("int")],
        *[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted],
    )


#: partitions of a written table; a fleet of any width is so many folders
BUCKETS = 64
BUCKET = "db_bucket"


def bucketed(df: DataFrame) -> DataFrame:
    """With the folder each database goes to. Rebalanced by it: a large database is written by several tasks."""
    return df.withColumn(BUCKET, F.pmod("db_id", F.lit(BUCKETS))).hint("rebalance", BUCKET)


def of_databases(df: DataFrame, databases: Iterable[int] | None) -> DataFrame:
    """The rows of some databases, from their folders only; of all with None."""
    if databases is not None:
        ids = sorted(set(databases))
        df = df.where(F.col(BUCKET).isin({i % BUCKETS for i in ids}) & F.col("db_id").isin(ids))
    return df.drop(BUCKET)


def read_catalog(
    spark: SparkSession, path: str, side: str, databases: Iterable[int] | None = None
) -> dict[str, DataFrame]:
    """The relations of one side, read from ``path/side/relation``; of some databases, or of all."""
    _check(side)
    databases = None if databases is None else list(databases)
    return {
        r: of_databases(
            spark.read.schema(f"{columns}, db_id int, {BUCKET} int").parquet(f"{path}/{side}/{r}"), databases
        ).select("db_id", *[f.strip().split(" ")[0] for f in columns.split(",")])
        for r, columns in RELATIONS.items()
    }


def write_catalog(raw: dict[str, DataFrame], path: str, side: str) -> None:
    """Puts relations into an export in the layout that ``read_catalog`` reads.

    What the export has of the databases in ``raw`` is replaced, in all relations
    given; other databases stay. Only the folders that these databases are in are
    written anew: first the new files, then the old ones are deleted, so a run that
    breaks off loses nothing and has to be repeated. One writer at a time for an
    export. The relations do not depend on each other, so their jobs are submitted together.
    """
    _check(side)
    shapes = {r: shaped(df, r) for r, df in raw.items()}
    ids = reduce(DataFrame.unionByName, [df.select("db_id") for df in shapes.values()]).distinct()
    ids = stage(ids, "exported-databases")
    spark = ids.sparkSession
    buckets = [r[0] for r in ids.select(F.pmod("db_id", F.lit(BUCKETS))).distinct().collect()]  # at most BUCKETS

    def write(relation: str) -> None:
        place, rows, replaced = f"{path}/{side}/{relation}", shapes[relation], []
        if folders := [f for b in buckets if exists(spark, f := f"{place}/{BUCKET}={b}")]:
            read = spark.read.schema(f"{RELATIONS[relation]}, db_id int, {BUCKET} int").option("basePath", place)
            old = read.parquet(*folders)
            replaced = old.inputFiles()
            rows = rows.unionByName(old.drop(BUCKET).join(ids, "db_id", "left_anti"))
        bucketed(rows).write.mode("append").partitionBy(BUCKET).parquet(place)
        delete(spark, replaced)

    with ThreadPoolExecutor(4) as jobs:
        list(jobs.map(write, raw))


def exists(spark: SparkSession, folder: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def delete(spark: SparkSession, files: list[str]) -> None:
    for file in files:  # named as URIs
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)


def read_database(
    spark: SparkSession, db_id: int, url: str, relations: dict[str, str], options: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """One live database over JDBC: ``relations`` maps a relation to a table or ``(query) alias``.

    Column pruning and filters go to the server. Databases are read one by one
    and added to an export with ``write_catalog``; jobs for different databases
    do not depend on each other.
    """
    def reader(table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**jdbc_options(url, table, options)).load()

    return {r: shaped(reader(t).withColumn("db_id", F.lit(db_id)), r) for r, t in relations.items()}


def jdbc_options(url: str, table: str, options: dict[str, str] | None = None) -> dict[str, str]:
    return {"driver": "org.postgresql.Driver", "fetchsize": "10000", **(options or {}), "url": url, "dbtable": table}


def _check(side: str) -> None:
    if side not in SIDES:
        raise ValueError(f"side is one of {SIDES}")
