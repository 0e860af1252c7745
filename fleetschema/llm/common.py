"""What several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: words of the mixing and SimHash contracts: whatever stands between spaces, tabs and line ends
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def free(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it (names match without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def row_hash(df: DataFrame) -> Column:
    """64 bits of all columns; NULL and the empty string differ."""
    marks = [F.col(quoted(c)).isNull() for c in df.columns]
    return F.xxhash64(*[F.col(quoted(c)) for c in df.columns], *marks)


def extended(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """A new schema: the fields of ``df`` and further ones."""
    return T.StructType([*df.schema.fields, *fields])


def map_batches(df: DataFrame, schema: T.StructType, arrays_of: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` in Arrow batches through ``arrays_of``; columns go by place, so any names will do."""
    plain = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(schema.fields)])
    names = plain.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(arrays_of(batch), names)

    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, plain).toDF(*schema.names)


def by_block(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, all those at a time that agree in the first ``columns`` columns."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        start = 0
        for i, mark in enumerate(zip(*(batch.column(k).to_pylist() for k in range(columns)))):
            if mark != now:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, now = [], i, mark
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
