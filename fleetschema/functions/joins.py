"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fleetschema.staging import stage


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; either side may repeat a key without limit.

    The distinct keys, combined before the shuffle, decide which keys are missing.
    Only then are rows picked, by a join with the written list of missing keys:
    while that is below Spark's broadcast threshold the rows are not shuffled at
    all, and beyond it adaptive execution may split a frequent key, which it does
    only for a join that reads its shuffles directly.
    """
    keys = list(keys)
    missing = df.select(keys).distinct().join(other.select(keys).distinct(), keys, "left_anti")
    return df.join(stage(missing, "missing-keys"), keys, "left_semi")
