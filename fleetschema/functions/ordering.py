"""Ordered work without one task per group.

``row_number() over (partition by db_id ...)`` sends a whole database to one
task, and the same without a partition clause sends everything to one task. Here
rows are range-partitioned on (group, order) instead, so that a group holding a
third of all rows is cut into many blocks, and only one small row per (group,
block) is combined across blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetschema.staging import stage

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def sorted_blocks(df: DataFrame, order: Sequence[Column], group: Sequence[str] = ()) -> DataFrame:
    """Adds ``_block`` (range partition) and ``_pos`` (place inside it), written to the shared folder.

    (group, order) has to identify a row: rows that tie on all of it stay in one
    block and have no fixed order. The table is written because range bounds are
    sampled, so evaluating the same plan twice need not give the same blocks.
    """
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc() for g in group] + list(order)
    placed = stage(
        df.repartitionByRange(blocks, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "blocks",
    )
    return placed.select(
        *df.columns,
        F.shiftright("_place", _POSITION_BITS).alias("_block"),
        F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def block_starts(placed: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One row per (group, block): first place, row count and rows of the group in earlier blocks.

    A group has at most one row per block, so the window below sees at most
    ``spark.sql.shuffle.partitions`` rows of any group.
    """
    earlier = (
        Window.partitionBy(*(group or [F.lit(0)]))
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = placed.groupBy(*group, "_block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    return stage(
        counted.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("long"))),
        "block-starts",
    )


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "seq") -> DataFrame:
    """Adds ``name`` = 1, 2, ... per group in the stated order. Group columns hold no NULLs."""
    placed = sorted_blocks(df, order, group)
    starts = block_starts(placed, group)
    number = F.col("_pos") - F.col("_first") + F.col("_before") + F.lit(1)
    return placed.join(starts, [*group, "_block"]).select(*df.columns, number.cast("long").alias(name))
