"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, so the sums over all vectors are exact. Each task
reduces its centred rows block by block to one triangle by QR; triangles are
reduced some at a time in rounds of tasks until one is left, whose right singular
vectors (``qd``) are the directions. The covariance is never formed. What leaves
a task is a triangle of dimension x dimension at most, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm import qd
from fleetschema.llm.common import col, extended, free, map_batches
from fleetschema.staging import stage

SCALE, OFFSET = 1024.0, 100_000
#: rows that are reduced at a time, and triangles that one task of a round takes
BLOCK, FAN = 2_048, 16
_LARGEST = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """n vectors with whole-number sums; eigenvalues and unit eigenvectors (columns) of the covariance, the largest first."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def whole(vector: Column) -> Column:
    """True for vectors with at least one entry and only finite ones."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _numbers(lists: pa.ListArray) -> np.ndarray:
    """Rows of whole numbers from lists of one length."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(SCALE * flat)
    if len(x) and np.abs(x).max() > 2.0**52:
        raise ValueError("an entry times 1024 is beyond 2^52, so it has no exact whole number here")
    return (x.astype(np.int64) + OFFSET).reshape(len(lists), -1)


def _multiples(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: Python's numbers where 64 bits would not do."""
    if n * int(np.abs(x).max(initial=1)) >= _LARGEST:
        return x.astype(object) * n - sums.astype(object)
    return x * n - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, each entry rounded once."""
    return (_multiples(x, n, sums) / n).astype(np.float64)


def _squares(m: np.ndarray) -> list[int]:
    if m.dtype == object or m.shape[1] * int(np.abs(m).max(initial=0)) ** 2 >= _LARGEST:
        m = m.astype(object)
    return [int(v) for v in (m * m).sum(axis=1)]


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square, with a diagonal that is not negative."""
    p = rows.shape[1]
    r = np.linalg.qr(np.vstack([rows, np.zeros((max(0, p - len(rows)), p))]), mode="r")
    return r * np.where(np.diagonal(r) < 0, -1.0, 1.0)[:, None]


def _sums(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums by dimension: a row from each task, summed by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _numbers(batch.column(0)).sum(axis=0)
                n, total = n + batch.num_rows, x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()])], ["n", "sums"])

    parts = stage(vectors.mapInArrow(add, "n long, sums array<long>"), "whitening-sums")
    by_place = parts.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)"))).collect()
    sums = np.array([int(v) for _, v in sorted(by_place)], object)
    small = all(abs(v) < _LARGEST for v in sums)
    return int(parts.agg(F.sum("n")).first()[0] or 0), sums.astype(np.int64) if small else sums


def _reduced(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle R with RᵀR equal to that of all centred rows."""
    p = len(sums)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = _centred(_numbers(batch.column(0).slice(at, BLOCK)), n, sums)
                r = _triangle(rows if r is None else np.vstack([r, rows]))
        if r is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()])], ["part", "r"])

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), table["r"].to_pylist()))
        r = _triangle(np.vstack([np.frombuffer(b).reshape(p, p) for _, b in rows]))
        return pa.table({"part": pa.array([rows[0][0] // FAN], pa.int64()), "r": pa.array([r.tobytes()])})

    kind = "part long, r binary"
    parts = stage(vectors.mapInArrow(first, kind), "triangles")
    left = int(parts.agg(F.max("part")).first()[0])
    while left:  # numbers of parts shrink by FAN each round; the first task is number 0 or has no rows
        parts = stage(parts.groupBy(F.floor(F.col("part") / FAN).alias("g")).applyInArrow(merge, kind), "triangles")
        left //= FAN
    return np.frombuffer(parts.first()["r"]).reshape(p, p)


def fit(df: DataFrame, vector: str, components: int = 8) -> Whitening:
    """Directions of the vectors of ``df``, all of which are read.

    Vectors that are NULL, empty or hold an entry that is NULL or not finite are
    left out. Vectors of several lengths are an error. Directions whose eigenvalue
    is zero to working precision are not returned, so equal vectors, one vector or
    none give no component. dimension x dimension numbers are solved on the driver.
    """
    vectors = df.select(col(vector).alias("v")).where(whole(F.col("v")))
    lengths = sorted(r[0] for r in vectors.select(F.size("v").alias("d")).distinct().limit(9).collect())
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {lengths}")
    if not lengths:
        return Whitening(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    n, sums = _sums(vectors)
    every, values, directions = qd.eigenpairs(_reduced(vectors, n, sums), components)
    return Whitening(n, sums, values / n, directions, float(every.sum()) / n)


def whiten(df: DataFrame, vector: str, model: Whitening) -> DataFrame:
    """The rows of ``df`` with a whole vector, and ``whitened`` and ``deviation``.

    whitened: the centred vector along each direction over the root of its
    eigenvalue. deviation: the sum of (n x - S)² over the dimensions, exact
    (decimal). Repeated rows are all returned; added columns take an underscore
    where the input has their name.
    """
    names = []
    for name in ("whitened", "deviation"):
        names.append(free([*df.columns, *names], name))
    at = df.columns.index(vector)
    n, sums = model.n, model.sums
    weights = model.directions / np.sqrt(model.values)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out, far = [], []
        for start in range(0, batch.num_rows, BLOCK):
            x = _numbers(batch.column(at).slice(start, BLOCK))
            out += (_centred(x, n, sums) @ weights).tolist()
            far += map(Decimal, _squares(_multiples(x, n, sums)))
        return [*batch.columns, pa.array(out, pa.list_(pa.float64())), pa.array(far, pa.decimal128(38, 0))]

    new = [T.StructField(names[0], T.ArrayType(T.DoubleType())), T.StructField(names[1], T.DecimalType(38, 0))]
    return map_batches(df.where(whole(col(vector))), extended(df, *new), run)


def identity_error(df: DataFrame, whitened: str, components: int) -> float:
    """The largest entry of the covariance of ``whitened`` minus the identity, centred by its own means."""
    if not components:
        return 0.0
    entries = [col(whitened)[i] for i in range(components)]
    means = df.agg(*[F.avg(x) for x in entries]).first()
    off = [x - F.lit(float(m)) for x, m in zip(entries, means)]
    places = [(i, j) for i in range(components) for j in range(i + 1)]
    got = df.agg(*[F.avg(off[i] * off[j]) for i, j in places]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(places, got))
