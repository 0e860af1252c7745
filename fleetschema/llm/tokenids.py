"""Token ids of documents in files of separately compressed documents.

A folder holds three tables. ``blocks``: some hundred documents each, in
ascending order of key; every document is a zstandard frame of its own, made
with one dictionary for all, and the block has the hash of that dictionary and
the index of offsets, so one short document is read by its block and its slice
alone. ``dictionary``: the bytes trained on serialized id arrays. ``parts``: ids
and documents before each range of keys. Spark writes and reads all three, so
they lie in any store it knows and a lost task is repeated whole.

Only the ids are shuffled, in one range shuffle by key; the order of equal keys
goes on by the ids, then by the place in the input, so no run of equal rows is
too large for a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetschema.llm.common import col, map_batches
from fleetschema.llm.encoders import id_width, word_encoder
from fleetschema.staging import stage

#: the dictionary is trained on about this many stretches of ids, spread over all documents, of so many ids each
SAMPLES, STRETCH = 4_096, 1_024
DICTIONARY_BYTES = 65_536
#: compressed bytes and documents after which a block is closed
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4_096
LEVEL = 6

ENCODED = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("first_key", T.LongType()),
        T.StructField("last_key", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("dictionary_sha256", T.StringType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("data", T.BinaryType()),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("key", T.LongType()),
        T.StructField("in_part", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def encode(df: DataFrame, key: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """(key, n_tokens, ids): the ids of each whole text and ``end_id`` behind them, as bytes."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder = word_encoder(tokenizer, keeps_space=False, plain_specials=False)
        end = np.array([end_id], encoder.kind).tobytes()
        ids = []
        for some, bounds in encoder.encode(batch.column(1)):
            ids += [some[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:])]
        return [batch.column(0), pa.array([len(x) // encoder.width for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    return map_batches(df.select(col(key).cast("long").alias("key"), col(text).alias("text")), ENCODED, run)


def train_dictionary(encoded: DataFrame, width: int, samples: int = SAMPLES, stretch: int = STRETCH) -> DataFrame:
    """One row (sha256, dictionary): trained in one task on a bounded number of stretches.

    Stretches of all documents, from start to end, are chosen by their hash, so
    that about ``samples`` of them are; equal stretches of equal keys count once.
    Too few to train on give an empty dictionary.
    """
    step = stretch * width
    pieces = int(encoded.agg(F.sum(F.ceil(F.col("n_tokens") / stretch))).first()[0] or 0)
    bound = min(1.0, samples / max(pieces, 1))
    chosen = T.StructType([T.StructField("h", T.BinaryType()), T.StructField("piece", T.BinaryType())])

    def choose(batch: pa.RecordBatch) -> list[pa.Array]:
        marks, out = [], []
        for key_, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for at in range(0, len(ids), step):
                piece = ids[at : at + step]
                mark = hashlib.blake2b(f"{key_}:{at}:".encode() + piece, digest_size=16).digest()
                if int.from_bytes(mark[:8], "big") < bound * 2.0**64:
                    marks.append(mark)
                    out.append(piece)
        return [pa.array(marks, pa.binary()), pa.array(out, pa.binary())]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        pieces = [p for _, p in rows]
        size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 8)
        try:
            made = zstandard.train_dictionary(size, pieces).as_bytes() if len(pieces) > 7 else b""
        except zstandard.ZstdError:  # says that there is too little to train on
            made = b""
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(made).hexdigest()]), pa.array([made], pa.binary())], ["sha256", "dictionary"]
        )

    found = map_batches(encoded.select("key", "ids"), chosen, choose)
    found = found.groupBy("h").agg(F.first("piece").alias("piece")).repartition(1)
    return found.mapInArrow(train, "sha256 string, dictionary binary")


@lru_cache(maxsize=4)
def _dictionary(made: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(made) if made else None


def _blocks(ordered: DataFrame, made: bytes, sha256: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(made))
        keys: list[int | None] = []
        counts: list[int] = []
        offsets, data = [0], bytearray()

        def close() -> pa.RecordBatch:
            row = (part, block, keys[0], keys[-1], before, sum(counts), width, sha256, keys, counts, offsets, bytes(data))
            kinds = [f.dataType for f in BLOCKS.fields]
            return pa.RecordBatch.from_arrays([pa.array([v], _arrow(k)) for v, k in zip(row, kinds)], BLOCKS.names)

        for batch in batches:
            for key, n, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys.append(key)
                counts.append(n)
                data += press.compress(ids)
                offsets.append(len(data))
                if len(data) >= BLOCK_BYTES or len(keys) >= BLOCK_DOCS:
                    yield close()
                    block, before = block + 1, before + sum(counts)
                    keys, counts, offsets, data = [], [], [0], bytearray()
        if keys:
            yield close()

    return ordered.mapInArrow(run, BLOCKS)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(pa.int64())
    return {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kind.simpleString()]


def write_ids(
    df: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> None:
    """Write the ids of every row's whole text, ``end_id`` behind each, below ``folder``, ascending by key.

    ``tokenizer`` is a file of the tokenizers library that every executor can
    read; it has to drop white space (``encoders``). A NULL text has no ids but the
    end; NULL keys come last; rows that share a key are all written, ordered by
    their ids; further columns are left aside, whatever their names. An empty
    table gives empty tables. The folder must not be there yet.
    """
    spark = df.sparkSession
    width = id_width(_vocabulary(tokenizer))
    encoded = stage(encode(df, key, text, tokenizer, end_id), "token-ids")
    train_dictionary(encoded, width, samples).write.parquet(f"{folder}/dictionary")
    sha256, made = spark.read.parquet(f"{folder}/dictionary").first()
    placed = encoded.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("key").isNull(), F.col("key"), F.xxhash64("ids"), F.col("place")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("key", "n_tokens", "ids")
    # the frames are compressed already
    _blocks(ordered, bytes(made), sha256, width).write.option("compression", "none").parquet(f"{folder}/blocks")
    totals = _read(spark, folder, "blocks").groupBy("part").agg(
        F.sum("tokens").alias("tokens"), F.sum(F.size("keys")).cast("long").alias("documents")
    )
    # one row for each range of the shuffle above
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("tokens", "documents")})
    totals.write.parquet(f"{folder}/parts")


def _vocabulary(tokenizer: str) -> int:
    return word_encoder(tokenizer, keeps_space=False, plain_specials=False).tokenizer.get_vocab_size(with_added_tokens=True)


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = spark.read
    return (df.schema(BLOCKS) if name == "blocks" else df).parquet(f"{folder}/{name}")


def read_ids(spark: SparkSession, folder: str, keys: list[int] | None = None) -> DataFrame:
    """(key, start, n_tokens, ids): what ``write_ids`` wrote, ids as little-endian unsigned 32-bit numbers.

    ``start`` counts the ids of all documents before. With ``keys`` only blocks
    that may hold them are read, and of these only the frames asked for. A
    dictionary that is not the one a block was made with is an error.
    """
    sha256, made = _read(spark, folder, "dictionary").first()
    made, wanted = bytes(made), None if keys is None else frozenset(keys)
    blocks = _read(spark, folder, "blocks")
    if wanted is not None:
        near = F.lit(False)
        for k in sorted(wanted):
            near = near | ((F.col("first_key") <= k) & ((F.col("last_key") >= k) | F.col("last_key").isNull()))
        blocks = blocks.where(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(made))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != sha256:
                    raise ValueError(f"block {row['part']}/{row['block']} needs dictionary {row['dictionary_sha256']}")
                counts, offsets = row["n_tokens"], row["offsets"]
                starts = row["start"] + np.concatenate([[0], np.cumsum(counts)])
                picked = [i for i, k in enumerate(row["keys"]) if wanted is None or k in wanted]
                kind = np.dtype(f"<u{row['width']}")
                for some in (picked[i : i + 512] for i in range(0, len(picked), 512)):
                    frames = [press.decompress(row["data"][offsets[i] : offsets[i + 1]]) for i in some]
                    columns = [
                        pa.array([row["part"]] * len(some), pa.int32()),
                        pa.array([row["keys"][i] for i in some], pa.int64()),
                        pa.array([starts[i] for i in some], pa.int64()),
                        pa.array([counts[i] for i in some], pa.int64()),
                        pa.array([np.frombuffer(x, kind).astype("<u4").tobytes() for x in frames], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, DOCUMENTS.names)

    documents = blocks.mapInArrow(run, DOCUMENTS)
    parts = _read(spark, folder, "parts").select("part", "tokens_before")
    return documents.join(parts, "part").select(
        "key", (F.col("in_part") + F.col("tokens_before")).alias("start"), "n_tokens", "ids"
    )
