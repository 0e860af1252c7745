"""The shared folder of sessions that have none set, as in tests and on one machine."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Set for the fleet's queries where a session has Spark's default: the shuffle files of a statement go when it ends, not
# when the driver collects garbage, joins whose partitions are all so small build hash tables instead of sorting by names,
# and written names and statements take less room.
FLEET_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("false", "true"),
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": ("0b", "32m"),
    "spark.sql.parquet.compression.codec": ("snappy", "zstd"),
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with a folder of its own for intermediate tables if it is local and has none set."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fleetschema-"))
    return spark


def for_fleet(spark: SparkSession) -> SparkSession:
    for key, (default, value) in FLEET_SETTINGS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    return spark
