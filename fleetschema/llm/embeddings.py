"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

Vectors that fall into the same bucket of a table are compared exactly, in
double precision, block by block; a pair that meets in several tables counts in
the first. Buckets that hold many vectors are cut into chunks and each pair of
chunks is a task's own piece of work, so no bucket lands in one task whole and
none is capped. Equal vectors are put together before, and a block sends out
counts and the tree that holds its links together, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, map_batches
from fleetschema.llm.components import connected_components
from fleetschema.staging import stage


@lru_cache(maxsize=8)
def hyperplanes(dimension: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, tables * bits))


def signatures(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """One number for each vector and table, from the sides of the table's hyperplanes."""
    side = vectors @ hyperplanes(vectors.shape[1], tables, bits, seed) > 0
    return (side.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))).astype("<i4")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _bucketed(vectors: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """(id, copies, v) to a row for each table: ..., sigs, t, bucket."""

    def sign(batch: pa.RecordBatch) -> list[pa.Array]:
        lists = batch.column(2)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
        marks: list[bytes] = [b""] * len(lengths)
        for d in np.unique(lengths):
            rows = np.flatnonzero(lengths == d)
            x = flat[starts[rows][:, None] + np.arange(d)].astype(np.float64)
            for i, s in zip(rows, signatures(x, tables, bits, seed)):
                marks[i] = s.tobytes()
        return [*batch.columns, pa.array(marks, pa.binary())]

    signed = map_batches(vectors, extended(vectors, T.StructField("sigs", T.BinaryType())), sign)
    return stage(signed, "signed-vectors")


def _exploded(signed: DataFrame, tables: int) -> DataFrame:
    place = F.hex(F.expr("substring(sigs, 4 * t + 1, 4)"))
    each = signed.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))))
    return each.withColumn("bucket", F.concat_ws("-", F.size("v"), F.col("t"), place))


def link_blocks(signed: DataFrame, tables: int, threshold: float, chunk: int) -> DataFrame:
    """(kind, a, b): links per vector in each block (b is how many) and the links that hold the block together."""
    placed = _exploded(signed.select("id", "sigs", "v"), tables)
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    cuts = sizes.where(F.col("rows") > chunk).select("bucket", F.ceil(F.col("rows") / chunk).cast("int").alias("chunks"))
    # only the large buckets are in this table, so that the join seldom needs a shuffle
    full = _exploded(signed, tables).join(stage(cuts, "large-buckets"), "bucket", "left").fillna(1, "chunks")
    mine = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    full = full.withColumn("c", mine).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    full = full.select(
        "bucket", "t", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "c", "id", "copies", "v", "sigs"
    )
    full = full.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> pa.RecordBatch:
            ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
            c, table = rows["c"].to_numpy(), rows["t"][0].as_py()
            flat = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            v = flat.reshape(len(ids), -1)
            v /= np.linalg.norm(v, axis=1)[:, None]
            sigs = np.frombuffer(b"".join(rows["sigs"].to_pylist()), "<i4").reshape(len(ids), -1)
            one = rows["x"][0].as_py() == rows["y"][0].as_py()
            links = np.zeros(len(ids), np.int64)
            found_a, found_b = [], []
            for k in range(0, len(ids), 1024):  # a strip of the products at a time
                a, b = np.nonzero(v[k : k + 1024] @ v[k:].T >= threshold)
                a, b = a + k, b + k
                keep = (a < b) if one else (a < b) & (c[a] != c[b])
                a, b = a[keep], b[keep]
                if len(a):
                    # in the first table that they share
                    a, b = (z[(np.argmax(sigs[a] == sigs[b], axis=1) == table)] for z in (a, b))
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    found_a.append(a)
                    found_b.append(b)
            a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (found_a, found_b))
            some = np.flatnonzero(links)
            root = _roots(len(ids), a, b)
            tree = some[root[some] != some]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*["count"] * len(some), *["link"] * len(tree)], pa.string()),
                    pa.array(np.concatenate([ids[some], ids[tree]]), pa.int64()),
                    pa.array(np.concatenate([links[some], ids[root[tree]]]), pa.int64()),
                ],
                ["kind", "a", "b"],
            )

        held: list[pa.RecordBatch] = []  # the rows of the block that is being read
        now = None
        for batch in batches:
            marks = list(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))))
            start = 0
            for i, mark in enumerate(marks):
                if mark != now:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield block(pa.Table.from_batches(held))
                    held, start, now = [], i, mark
            held.append(batch.slice(start))
        if held and sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return full.mapInArrow(compare, "kind string, a long, b long")


def plan_tables(n: int, threshold: float, recall: float, bucket: int) -> tuple[int, int]:
    """(tables, bits) for ``n`` vectors.

    So many bits that a bucket holds about ``bucket`` vectors that have nothing in
    common, and so many tables that two vectors at the threshold meet in one of them
    with a chance of ``recall``.
    """
    bits = max(8, math.ceil(math.log2(max(1, n) / bucket)))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - together)), bits


def near_duplicate_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.985,
    bucket: int = 256,
    seed: int = 4,
    chunk: int = 2048,
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Two vectors of equal length link when their cosine, in double precision, is at
    least ``threshold`` and they share a bucket in one of the tables, which pairs at
    the threshold do with a chance of ``recall`` at any size of the input, closer
    ones with a greater one (see ``plan_tables``). ``n_links`` counts other rows, equal vectors included. Vectors that are NULL, empty, zero or
    hold NULL, NaN or infinite parts link with nothing and are their own
    component. Rows with a NULL key link with nothing. A key that is repeated
    counts as so many vectors. An empty table gives no rows.
    """
    name = key
    rows = df.select(col(key).alias("id"), col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = F.coalesce(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = stage(rows.withColumn("ok", usable), "vectors")
    distinct = rows.where("ok").groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    distinct = distinct.select("id", "copies", "v")
    # a key that stands for several vectors would join them: the vector itself tells them apart
    distinct = distinct.withColumn("own", F.monotonically_increasing_id())
    distinct = stage(distinct, "distinct-vectors")
    tables, bits = plan_tables(distinct.count(), threshold, recall, bucket)
    signed = _bucketed(distinct.select(F.col("own").alias("id"), "copies", "v"), tables, bits, seed)
    blocks = stage(link_blocks(signed, tables, threshold, chunk), "vector-links")
    counts = blocks.where("kind = 'count'").groupBy("a").agg(F.sum("b").alias("links"))
    groups = connected_components(blocks.where("kind = 'link'").select("a", "b"), "a", "b")
    known = (
        distinct.join(counts, distinct["own"] == counts["a"], "left")
        .join(groups, distinct["own"] == groups["vertex"], "left")
        .select("id", "v", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "own").alias("g"))
    )
    known = stage(known, "vector-groups")
    least = known.groupBy("g").agg(F.min("id").alias("first"))
    known = known.join(least, "g").select("v", (F.col("links") + F.col("copies") - 1).alias("n_links"), "first")
    good = rows.where("ok").join(known, "v").select("id", "n_links", F.col("first").alias("component_id"))
    bad = rows.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.unionByName(bad).select(
        F.col("id").alias(name), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
