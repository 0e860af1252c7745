"""Substring dedup by line or paragraph hashing, and by hashing windows of words over their ends.

Units are normalised (lower case, white space) and digested; digests are grouped
over all documents, combined before the shuffle, and each keeps its earliest
ranked occurrence. All others are taken out of their texts, but for a few words
that stand alone, and the stretches that were cut are given in offsets of the
original text.

A passage whose edges lie inside lines shares no whole line with its copy. So
windows of ``PASSAGE`` words are units too, wherever lines end: every word of a
window that stands in an earlier document is cut. Only windows around repeated
anchors are digested: an anchor is the hash of half as many words that is the
least of its neighbours, so equal windows hold equal anchors and none is missed.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, map_batches
from fleetschema.llm.lines import cut_lines, line_table, mark_of
from fleetschema.staging import stage

#: a stretch of repeated units with fewer words than this is spared: headings, common phrases, a short line that chance repeats
MIN_WORDS = 20
#: words of a window that is cut wherever lines end
PASSAGE = 50

#: base of the hashes of stretches, and its inverse modulo 2**64
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
#: letters of a word that are hashed as they are; words of a text that are hashed at a time
_LETTERS, _PIECE = 64, 10_000


def _joined(words: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with spaces between them, and where in these bytes each begins and ends."""
    data = " ".join(words).encode()
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return data, np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(data)]])


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    powers = np.full(1 << bits, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _extremes(values: np.ndarray, n: int, of: np.ufunc) -> np.ndarray:
    """The least (greatest) of each ``n`` neighbours, by doubling."""
    size = 1
    while size < n:
        step = min(size, n - size)
        values, size = of(values[:-step], values[step:]), size + step
    return values


def anchors(words: list[str], passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors: of the stretches of ``passage // 2`` words in each window those with the least hash."""
    if len(words) < passage:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if max(map(len, words)) > _LETTERS:
        words = [w if len(w) <= _LETTERS else xxhash.xxh3_128_hexdigest(w) for w in words]
    found = [_anchors(words[at : at + _PIECE + passage - 1], passage) for at in range(0, len(words) - passage + 1, _PIECE)]
    places = np.concatenate([p + k * _PIECE for k, (p, _) in enumerate(found)])
    places, of = np.unique(places, return_index=True)
    return places, np.concatenate([h for _, h in found])[of].view(np.int64)


def _anchors(words: list[str], passage: int) -> tuple[np.ndarray, np.ndarray]:
    k = passage // 2
    data, starts, ends = _joined(words)
    bits = max(16, len(data).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)  # polynomials in an odd number, modulo 2**64
    np.cumsum(np.frombuffer(data, np.uint8) * _powers(_ODD, bits)[: len(data)], out=sums[1:])
    last = len(words) - k + 1
    run = (sums[ends[k - 1 :]] - sums[starts[:last]]) * _powers(_INVERSE, bits)[starts[:last]]
    run = (run ^ (run >> np.uint64(32))) * np.uint64(_ODD)
    run ^= run >> np.uint64(29)
    near = passage - k + 1
    least = _extremes(run, near, np.minimum)
    # a stretch is the least of a window if it is the greatest of what is least in the windows that hold it
    edge = np.zeros(near - 1, np.uint64)
    places = np.flatnonzero(_extremes(np.concatenate([edge, least, edge]), near, np.maximum) == run)
    return places, run[places]


def repeated_passages(df: DataFrame, key: str, text: str, passage: int = PASSAGE) -> DataFrame:
    """(key, mark, passages): for each document that has any, the windows (w, first) that an earlier document holds.

    ``w`` is the place of the window's first word, ``first`` the key of the
    earliest document. Of documents with the same text only the first is looked
    at: the others are repeated line by line.
    """
    plain = df.select(col(key).cast("long").alias("key"), mark_of(key, text).alias("mark"), col(text).alias("text"))
    same = F.xxhash64("text", F.crc32(F.col("text").cast("binary"))).alias("same")
    doc = F.struct(F.col("key").isNull().alias("none"), "key", "mark")
    names = plain.where("length(text) > 0").groupBy(same).agg(F.min(doc).alias("d")).select("same", "d.key", "d.mark")
    # documents are compared by one number that rises with their rank
    names = stage(names, "texts").orderBy(F.col("key").isNull(), "key", "mark")
    names = stage(names.withColumn("rank", F.monotonically_increasing_id()), "ranked-texts")

    def mark_anchors(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [anchors(t.as_py().lower().split(), passage) for t in batch.column(1)]
        times = [len(p) for p, _ in found]
        of = pa.array(np.repeat(np.arange(batch.num_rows), times))
        places, hashes = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in (0, 1))
        return [batch.column(0).take(of), pa.array(places, pa.int32()), pa.array(hashes, pa.int64())]

    fields = [T.StructField(n, t) for n, t in (("same", T.LongType()), ("at", T.IntegerType()), ("anchor", T.LongType()))]
    found = stage(map_batches(plain.where("length(text) > 0").select(same, "text"), T.StructType(fields), mark_anchors), "anchors")
    several = found.groupBy("anchor").agg(F.min("same").alias("low"), F.max("same").alias("high")).where("low < high")
    several = stage(several.select("anchor"), "repeated-anchors")
    places = found.join(several, "anchor").groupBy("same").agg(F.collect_set("at").alias("at"))
    places = stage(places.join(names, "same"), "anchor-places")
    places = places.select(F.col("key").alias("__key"), F.col("mark").alias("__mark"), "rank", "at")
    around = plain.join(places.hint("merge"), plain["key"].eqNullSafe(F.col("__key")) & (plain["mark"] == F.col("__mark")))
    around = around.select("key", "rank", "text", "at")

    def digest(batch: pa.RecordBatch) -> list[pa.Array]:
        ws, digests = [], []
        for text_, at in zip(batch.column(2), batch.column(3)):
            data, starts, ends = _joined(text_.as_py().lower().split())
            here = np.unique((at.values.to_numpy()[:, None] - np.arange(passage - passage // 2 + 1)).ravel())
            here = here[(here >= 0) & (here <= len(starts) - passage)]
            spans = zip(starts[here].tolist(), ends[here + passage - 1].tolist())
            digests.append(b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in spans]))
            ws.append(here.astype(np.int32))
        of = pa.array(np.repeat(np.arange(batch.num_rows), [len(w) for w in ws]))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        ws = np.concatenate(ws) if ws else np.empty(0, np.int32)
        return [batch.column(0).take(of), batch.column(1).take(of), pa.array(ws), *(pa.array(halves[:, k].copy()) for k in (0, 1))]

    longs = ("key", "rank", "w", "digest", "digest_")
    fields = [T.StructField(n, T.IntegerType() if n == "w" else T.LongType()) for n in longs]
    windows = stage(map_batches(around, T.StructType(fields), digest), "windows")
    first = windows.groupBy("digest", "digest_").agg(
        F.min("rank").alias("low"), F.max("rank").alias("high"), F.min_by("key", "rank").alias("first")
    )
    first = stage(first.where("low < high").drop("high"), "repeated-windows")
    later = windows.join(first, ["digest", "digest_"]).where("rank > low")
    later = later.groupBy("rank").agg(F.collect_set(F.struct("w", "first")).alias("passages"))
    return later.join(names.hint("merge"), "rank").select("key", "mark", "passages")


def repeated_units(df: DataFrame, key: str, text: str, sep: str) -> DataFrame:
    """(key, mark, lines): for each document that has any, the units of which an earlier one exists."""
    lines = stage(line_table(df, key, text, sep), "units")
    place = F.struct(F.col("key").isNull().alias("none"), "key", "mark", "n")
    first = lines.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("first != last").select("digest", "first")
    later = lines.join(stage(first, "repeated-digests"), "digest").where(place != F.col("first"))
    return later.groupBy("key", "mark").agg(F.collect_set(F.struct("n", F.col("first.key").alias("first"))).alias("lines"))


def dedup_substrings(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sep: str = "\n",
    min_words: int = MIN_WORDS,
    passage: int = PASSAGE,
) -> DataFrame:
    """Every row of ``df`` with repeated units cut from its text, and ``removed``: what was cut where.

    ``sep`` parts units: a line end, or an empty line for paragraphs. Documents rank
    by key (NULL last), units by place. A unit is repeated if an equal one, case and
    white space aside, stands earlier in this or another document; a stretch of
    repeated units is cut if it has ``min_words`` words. Blank units are never
    compared. ``passage`` words in a row that an earlier document holds in a row are
    cut too, wherever units end. NULL and empty texts stay as they are; rows that agree in key and
    text are one document and are cut alike; an empty table gives no rows; the
    added column takes an underscore where the input has its name.
    """
    lines = repeated_units(df, key, text, sep)
    gone = lines.withColumn("passages", F.lit(None).cast("array<struct<w:int,first:bigint>>"))
    more = repeated_passages(df, key, text, passage).withColumn("lines", F.lit(None).cast("array<struct<n:int,first:bigint>>"))
    gone = gone.unionByName(more).groupBy("key", "mark").agg(F.first("lines", True).alias("lines"), F.first("passages", True).alias("passages"))
    return cut_lines(df, stage(gone, "repeated-units"), key, text, sep, min_words, passage=passage)
