"""Benchmark decontamination by Wu-Manber search over words.

The test strings are runs of ``window`` words (a shorter item is one string). For
each length a table over pairs of adjacent words says how far the search may move
on; pairs that end a string lead to a bucket of strings, and a bucket's strings
are compared word by word. The search reads each document once and skips up to
``length - 1`` words at a time.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, free, map_batches
from fleetschema.staging import stage

#: test strings that one broadcast holds at most (some 100 bytes each); more are searched block by block
MAX_STRINGS = 500_000

#: a byte of a word (digits, letters, everything beyond ASCII) stays, A-Z become a-z, all else parts words
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
        ),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_BYTES).split() if text else []


class Search:
    """Wu-Manber tables of strings of words, one set for each length."""

    def __init__(self, strings: list[tuple[tuple[bytes, ...], list[int]]]):
        self.singles: dict[bytes, list[int]] = {}
        self.tables: list[tuple[int, dict, dict]] = []
        by_length: dict[int, list] = {}
        for string, items in strings:
            if len(string) == 1:
                self.singles[string[0]] = items
            else:
                by_length.setdefault(len(string), []).append((string, items))
        for length, group in sorted(by_length.items()):
            shift: dict[tuple[bytes, bytes], int] = {}
            bucket: dict[tuple[bytes, bytes], dict[tuple[bytes, ...], list[int]]] = {}
            for string, items in group:
                for end in range(1, length):
                    pair, room = (string[end - 1], string[end]), length - 1 - end
                    if room < shift.get(pair, length - 1):
                        shift[pair] = room
                bucket.setdefault((string[-2], string[-1]), {})[string] = items
            self.tables.append((length, shift, bucket))

    def __call__(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged [start, stop) spans of words inside occurrences, and the items that occur."""
        found: list[tuple[int, int]] = []
        items: set[int] = set()
        if self.singles:
            for i, w in enumerate(words):
                if w in self.singles:
                    found.append((i, i + 1))
                    items.update(self.singles[w])
        n = len(words)
        for length, shift, bucket in self.tables:
            i = length - 1
            skip, step = shift.get, length - 1
            while i < n:
                pair = (words[i - 1], words[i])
                move = skip(pair, step)
                if move:
                    i += move
                    continue
                whole = tuple(words[i - length + 1 : i + 1])
                if (ids := bucket[pair].get(whole)) is not None:
                    found.append((i - length + 1, i + 1))
                    items.update(ids)
                i += 1
        return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def test_strings(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(string, items): every distinct run of words to search for, with the items that hold it.

    Items without words give none; an item without an id is searched for but not
    named; texts that share an item id count as one item.
    """

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, runs = [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = words_of(t)
            for s in range(max(1, len(w) - window + 1)) if w else ():
                ids.append(i)
                runs.append(b" ".join(w[s : s + window]))
        return [pa.array(ids, pa.int64()), pa.array(runs, pa.binary())]

    runs = benchmark.select(col(item).cast("long").alias("item"), col(text).alias("text"))
    runs = map_batches(runs, T.StructType.fromDDL("item long, string binary"), cut)
    return runs.groupBy("string").agg(F.sort_array(F.collect_set("item")).alias("items"))


_SEARCHES: dict[int, Search] = {}


def _search_of(shared) -> Search:
    """Built once in each Python worker."""
    if shared.id not in _SEARCHES:
        _SEARCHES.clear()
        _SEARCHES[shared.id] = Search([(tuple(s.split(b" ")), ids) for s, ids in shared.value])
    return _SEARCHES[shared.id]


class _Shared:
    """A broadcast with a key by which workers know it."""

    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self):
        return self.broadcast.value


def find_hits(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    max_strings: int = MAX_STRINGS,
    name: str = "hits",
) -> DataFrame:
    """Every row of ``df`` with ``hits``: n_words, merged spans of hit words, ids of the items found.

    Strings go out in broadcasts of at most ``max_strings``; a larger benchmark is
    searched in several passes over the rows, each adding to the hits of the one
    before, and stays exact. NULL or empty text has no words and no hits; an empty
    benchmark finds nothing; rows may repeat; the added column takes an underscore
    where the input has its name.
    """
    spark = df.sparkSession
    strings = stage(test_strings(benchmark, item, item_text, window), "test-strings")
    blocks = max(1, -(-strings.count() // max_strings))
    name = free(df.columns, name)
    at = df.columns.index(text)
    out = df
    for k in range(blocks):
        part = strings.where(F.pmod(F.xxhash64("string"), F.lit(blocks)) == k) if blocks > 1 else strings
        held = [(bytes(r["string"]), list(r["items"])) for r in part.collect()]  # about max_strings rows at most
        shared = _Shared(spark.sparkContext.broadcast(held), uuid.uuid4().hex)
        later = k > 0

        def scan(batch: pa.RecordBatch, shared=shared, later=later) -> list[pa.Array]:
            search = _search_of(shared)
            kind = pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    ("items", pa.list_(pa.int64())),
                ]
            )
            texts, old = batch.column(at), batch.column(batch.num_columns - 1) if later else None
            hits = []
            for i in range(batch.num_rows):  # one text at a time: some are very long
                w = words_of(texts[i].as_py())
                spans, ids = search(w)
                if later:
                    was = old[i].as_py()
                    spans = merged([*spans, *((s["start"], s["stop"]) for s in was["spans"])])
                    ids = ids | set(was["items"])
                hits.append({"n_words": len(w), "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(ids)})
            return [*(batch.columns[:-1] if later else batch.columns), pa.array(hits, kind)]

        out = map_batches(out, extended(df, T.StructField(name, HITS)), scan)
    return out


def n_hit(hits: str) -> Column:
    return F.aggregate(f"{hits}.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` in which no test string occurs, with the columns of ``df``."""
    hits = free(df.columns, "hits")
    found = find_hits(df, benchmark, text, name=hits, **options)
    return found.where(F.size(F.col(hits)["spans"]) == 0).drop(hits)
