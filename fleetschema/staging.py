"""Written tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_RUN_FOLDERS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or an earlier ``setCheckpointDir``), which all executors share.

    There is no default, in local sessions neither: a folder that only one
    machine sees loses the tables of the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return root


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _RUN_FOLDERS:
        _RUN_FOLDERS[app] = f"{shared_root(spark).rstrip('/')}/fleetschema-{app}-{uuid.uuid4().hex[:8]}"
    return _RUN_FOLDERS[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path not used before, below the run folder."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return a reader of the written files."""
    spark = df.sparkSession
    folder = folder or new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def stage_observed(df: DataFrame, label: str, **sums: Column) -> tuple[DataFrame, dict]:
    """``stage`` and aggregates of the written rows, worked out by the job that writes them; of no rows some may be missing."""
    seen = Observation()
    table = stage(df.observe(seen, *[c.alias(name) for name, c in sums.items()]), label)
    return table, seen.get


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:  # named as URIs
            _delete(df.sparkSession, df.sparkSession._jvm.java.net.URI(folder))


def _delete(spark: SparkSession, folder) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete the tables staged by this application; call it when results are written."""
    folder = _RUN_FOLDERS.pop(spark.sparkContext.applicationId, None)
    if folder:
        _delete(spark, folder)
