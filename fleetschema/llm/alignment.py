"""Alignment of two tokenizers' tokens by merge-path partitioning.

The ends of a text's A tokens and of its B tokens are two sorted lists. Every
distinct end of the merged list gives one link, between the A and the B token
that are open there, and an end of both closes a group. Binary searches on
diagonals cut the merge into pieces of equal work that know nothing of each
other: a text of one piece is merged where it was read, the pieces of longer
texts are dealt over all tasks, and what a piece leaves open at its edges is
stitched to its neighbours.

How many documents hold an id pair is counted over the whole corpus. Documents
are kept in chunks; a chunk sends each of its distinct pairs once, gets its
counts back, and only then meets its documents again, so nothing is broadcast
and no row is made for each pair of a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetschema.llm.common import col
from fleetschema.llm.encoders import byte_characters, word_encoder
from fleetschema.staging import new_folder

#: merged ends of a piece; distinct pairs of documents after which a chunk is closed; texts that are encoded at a time
PIECE, CHUNK_PAIRS, TEXTS = 16_384, 2_000_000, 64
#: words that a worker keeps, bytes of texts that it encodes at a time: two vocabularies and a chunk lie beside them
CACHE_WORDS, TEXT_BYTES = 200_000, 4_000_000

_NUMBERS = [("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long")]
_DOC = "row long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
#: kind 0: a document of a chunk; 1: the distinct pairs of a chunk; 2: a piece of a longer text
_FOUND = f"kind int, chunk long, {_DOC}, pairs binary, times binary, piece int, a_base long, b_base long, a_ids binary, b_ids binary"
_FOUND_KINDS = [pa.int32(), pa.int64(), *[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_FOUND_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


class Tokenizers:
    """Two vocabularies: bytes of each id, ids of texts, and texts of ids for the groups."""

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.words = word_encoder(a, keeps_space=True, plain_specials=True, cache_words=CACHE_WORDS, text_bytes=TEXT_BYTES)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        byte_of = {c: n for n, c in byte_characters().items()}
        tokens = [self.words.tokenizer.id_to_token(i) or "" for i in range(self.words.tokenizer.get_vocab_size())]
        self.a_bytes = _Bytes([bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in tokens])
        ids = range(self.pieces.get_piece_size())
        self.b_bytes = _Bytes([self._bytes_of_piece(i) for i in ids])
        self.n_b = len(self.b_bytes.lengths)
        self.n_a = len(self.a_bytes.lengths)
        self.kind = np.dtype("<u4" if self.n_a * self.n_b <= 1 << 32 else "<u8")
        self.a_text = np.array([f"{i}," for i in range(self.n_a)] + [f"{i}|" for i in range(self.n_a)], object)
        self.b_text = np.array([f"{i}," for i in range(self.n_b)] + [f"{i};" for i in range(self.n_b)], object)

    def _bytes_of_piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The A and the B ids of each text; none where their bytes are not a space and the text."""
        none = np.zeros(0, np.int64)
        at = 0
        for some, bounds in self.words.encode(texts):
            for start in range(0, len(bounds) - 1, TEXTS):
                stop = min(start + TEXTS, len(bounds) - 1)
                plain = texts.slice(at + start, stop - start).fill_null("").to_pylist()
                for k, (text, b) in enumerate(zip(plain, self.pieces.encode(plain, num_threads=1)), start):
                    a, b = some[bounds[k] : bounds[k + 1]].astype(np.int64), np.array(b, np.int64)
                    want = f" {text}".encode()
                    whole = text and self.a_bytes.join(a, len(want)) == want and self.b_bytes.join(b, len(want)) == want
                    yield (a, b) if whole else (none, none)
            at += len(bounds) - 1


class _Bytes:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray, size: int) -> bytes:
        """The bytes of ``ids``, or nothing where they are not ``size`` many."""
        counts = self.lengths[ids]
        ends = np.cumsum(counts)
        if not len(ids) or ends[-1] != size:
            return b""
        return self.flat[np.repeat(self.starts[ids] - (ends - counts), counts) + np.arange(size)].tobytes()


@lru_cache(maxsize=2)
def tokenizers(a: str, b: str) -> Tokenizers:
    return Tokenizers(a, b)


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first ``diagonals`` ends of the merged list are of ``a``; of equal ends that of ``a`` comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        open_ = low < high
        i = np.where(open_, mid, 0)
        j = np.where(open_, diagonals - mid - 1, 0)
        more = open_ & (a[np.minimum(i, len(a) - 1)] <= b[np.clip(j, 0, len(b) - 1)])
        low, high = np.where(more, mid + 1, low), np.where(open_ & ~more, mid, high)
    return low


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """(i, j) before each piece of ``piece`` merged ends and after the last."""
    total = len(a_ends) + len(b_ends)
    at = np.append(np.arange(0, total, piece), total)
    i = merge_path(a_ends, b_ends, at)
    return list(zip(i.tolist(), (at - i).tolist()))


def merge_piece(a_ends: np.ndarray, b_ends: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of a piece: places (i, j) of the linked tokens, and of the ends that close groups.

    ``before``: the A end before the piece, or -1. Places count from the start
    of the piece; a token that ends behind it has the place behind the last one,
    and a closing A end before the piece the place -1.
    """
    at = np.searchsorted(a_ends, b_ends)
    close = a_ends[np.minimum(at, len(a_ends) - 1)] == b_ends if len(a_ends) else np.zeros(len(b_ends), bool)
    close_b = np.flatnonzero(close | (b_ends == before))
    close_a = np.where(b_ends[close_b] == before, -1, at[close_b])
    alone = np.ones(len(b_ends), bool)
    alone[close_b] = False
    i = np.concatenate([np.arange(len(a_ends)), at[alone]])
    j = np.concatenate([np.searchsorted(b_ends, a_ends), np.flatnonzero(alone)])
    return i, j, close_a, close_b


def groups_text(t: Tokenizers, a: np.ndarray, b: np.ndarray, close_a: np.ndarray, close_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2`` of tokens whose groups end at the places ``close_a`` and ``close_b``."""
    if not len(close_a):
        return ""
    a_before, b_before = np.concatenate([[0], close_a + 1]), np.concatenate([[0], close_b + 1])
    a_group = np.repeat(np.arange(len(close_a)), np.diff(a_before))
    b_group = np.repeat(np.arange(len(close_b)), np.diff(b_before))
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[close_a] = t.n_a
    b_last[close_b] = t.n_b
    parts = np.empty(len(a) + len(b), object)
    parts[np.arange(len(a)) + b_before[a_group]] = t.a_text[a + a_last]
    parts[np.arange(len(b)) + a_before[b_group + 1]] = t.b_text[b + b_last]
    return "".join(parts.tolist())[:-1]


def _pairs(t: Tokenizers, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct id pairs of links, sorted, and how often each is there."""
    pairs, times = np.unique((a[i] * t.n_b + b[j]).astype(t.kind), return_counts=True)
    return pairs, times.astype("<u4")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _narrow(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs; their count tells how many."""
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


class Chunks:
    """Documents gathered into chunks: what is written are places among the chunk's distinct pairs."""

    def __init__(self, kind: np.dtype, first: int, step: int):
        self.kind, self.chunk, self.step = kind, first, step
        self.docs: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, doc: tuple, pairs: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.docs.append(doc)
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs) + 16
        if self.held >= CHUNK_PAIRS:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        every = np.concatenate(self.pairs)
        distinct, place, n = np.unique(every, return_inverse=True, return_counts=True)
        rows, at = [], 0
        for doc, pairs, times in zip(self.docs, self.pairs, self.times):
            steps = np.diff(place[at : at + len(pairs)], prepend=0)
            at += len(pairs)
            # the number of pairs stands in the column of pieces
            rows.append((0, self.chunk, *doc, _narrow(steps), _narrow(times), len(pairs), *[None] * 4))
        yield from _batches(rows)
        yield from _batches([(1, self.chunk, *[None] * 7, distinct.tobytes(), n.astype("<u4").tobytes(), *[None] * 5)])
        self.chunk += self.step
        self.docs, self.pairs, self.times, self.held = [], [], [], 0


def _batches(rows: list[tuple], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), size):
        columns = zip(*rows[k : k + size])
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _FOUND_KINDS)], _FOUND_NAMES)


def _first_chunk() -> int:
    return TaskContext.get().partitionId() << 24


def _read_and_merge(df: DataFrame, a: str, b: str, piece: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a, b)
        chunks, row = Chunks(t.kind, _first_chunk(), 1), TaskContext.get().partitionId() << 40
        for batch in batches:
            for key, (x, y) in zip(batch.column(0).to_pylist(), t.encode(batch.column(1))):
                row += 1
                if not len(x):
                    yield from chunks.add((row, key, 0, 0, 0, 0, ""), x.astype(t.kind), x)
                    continue
                x_ends, y_ends = np.cumsum(t.a_bytes.lengths[x]), np.cumsum(t.b_bytes.lengths[y])
                at = cuts(x_ends, y_ends, piece)
                if len(at) == 2:
                    i, j, close_a, close_b = merge_piece(x_ends, y_ends, -1)
                    text = groups_text(t, x, y, close_a, close_b)
                    doc = (row, key, len(x), len(y), len(close_a), len(i), _digest(text))
                    yield from chunks.add(doc, *_pairs(t, x, y, i, j))
                    continue
                rows = []
                for k, ((i0, j0), (i1, j1)) in enumerate(zip(at[:-1], at[1:])):
                    base = (int(x_ends[i0 - 1]) if i0 else 0, int(y_ends[j0 - 1]) if j0 else 0)
                    ids = (x[i0 : i1 + 1].astype("<u4").tobytes(), y[j0 : j1 + 1].astype("<u4").tobytes())
                    # how many of the ids end in the piece stands in the columns of links and groups
                    rows.append((2, None, row, key, len(x), len(y), i1 - i0, j1 - j0, None, None, None, k, *base, *ids))
                yield from _batches(rows)
        yield from chunks.close()

    return df.mapInArrow(run, _FOUND)


_MERGED = (
    "row long, key long, piece int, n_a long, n_b long, n_links long, n_groups long, closed boolean, body string, "
    "head_a binary, head_b binary, tail_a binary, tail_b binary, pairs binary, times binary"
)


def _merge_pieces(pieces: DataFrame, a: str, b: str) -> DataFrame:
    """Each piece by itself: its links, the groups that lie in it, and what it leaves open at either edge."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.bool_(), pa.string(), *[pa.binary()] * 6]
    names = [x.split()[0] for x in _MERGED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a, b)
        for batch in (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64)):
            rows = []
            for p in batch.to_pylist():
                x, y = np.frombuffer(p["a_ids"], "<u4").astype(np.int64), np.frombuffer(p["b_ids"], "<u4").astype(np.int64)
                in_x, in_y = x[: p["n_groups"]], y[: p["n_links"]]
                x_ends = p["a_base"] + np.cumsum(t.a_bytes.lengths[in_x])
                y_ends = p["b_base"] + np.cumsum(t.b_bytes.lengths[in_y])
                i, j, close_a, close_b = merge_piece(x_ends, y_ends, p["a_base"] or -1)
                pairs, times = _pairs(t, x, y, i, j)
                closed = len(close_a) > 0
                first_a, first_b = (int(close_a[0]) + 1, int(close_b[0]) + 1) if closed else (len(in_x), len(in_y))
                last_a, last_b = (int(close_a[-1]) + 1, int(close_b[-1]) + 1) if closed else (len(in_x), len(in_y))
                body = groups_text(
                    t, in_x[first_a:last_a], in_y[first_b:last_b], close_a[1:] - first_a, close_b[1:] - first_b
                )
                edges = [v.astype("<u4").tobytes() for v in (in_x[:first_a], in_y[:first_b], in_x[last_a:], in_y[last_b:])]
                rows.append(
                    (p["row"], p["key"], p["piece"], p["n_a"], p["n_b"], len(i), len(close_a), closed, body, *edges,
                     pairs.tobytes(), times.tobytes())
                )
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    return pieces.mapInArrow(run, _MERGED)


def _stitch(merged: DataFrame, a: str, b: str) -> DataFrame:
    """The pieces of each text put together, and the texts in chunks."""

    def put(table: pa.Table) -> pa.Table:
        t = tokenizers(a, b)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        open_a, open_b, texts = [], [], []
        for r in rows:
            open_a += np.frombuffer(r["head_a"], "<u4").tolist()
            open_b += np.frombuffer(r["head_b"], "<u4").tolist()
            if r["closed"]:
                texts.append(f"{','.join(map(str, open_a))}|{','.join(map(str, open_b))}")
                texts += [r["body"]] if r["body"] else []
                open_a = np.frombuffer(r["tail_a"], "<u4").tolist()
                open_b = np.frombuffer(r["tail_b"], "<u4").tolist()
        pairs = np.concatenate([np.frombuffer(r["pairs"], t.kind) for r in rows])
        times = np.concatenate([np.frombuffer(r["times"], "<u4") for r in rows])
        pairs, place = np.unique(pairs, return_inverse=True)
        times = np.bincount(place, times).astype("<u4")
        total = [sum(r[n] for r in rows) for n in ("n_groups", "n_links")]
        doc = (rows[0]["row"], rows[0]["key"], rows[0]["n_a"], rows[0]["n_b"], *total, _digest(";".join(texts)))
        values = (0, None, *doc, pairs.tobytes(), times.tobytes(), *[None] * 5)
        return pa.table([pa.array([v], kind) for v, kind in zip(values, _FOUND_KINDS)], _FOUND_NAMES)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a, b)
        chunks = Chunks(t.kind, -1 - _first_chunk(), -1)
        for batch in (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64)):
            for r in batch.to_pylist():
                doc = tuple(r[n] for n in _FOUND_NAMES[2:9])
                yield from chunks.add(doc, np.frombuffer(r["pairs"], t.kind), np.frombuffer(r["times"], "<u4"))
        yield from chunks.close()

    return merged.groupBy("row").applyInArrow(put, _FOUND).mapInArrow(gather, _FOUND)


def _written(df: DataFrame, label: str) -> DataFrame:
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _chunk_pairs(found: DataFrame, kind: np.dtype, n_b: int) -> DataFrame:
    """(chunk, pair, a, n): in how many documents of the chunk each of its pairs is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, n in zip(*(c.to_pylist() for c in batch.columns)):
                pairs, n = np.frombuffer(pairs, kind).astype(np.int64), np.frombuffer(n, "<u4").astype(np.int64)
                for at in range(0, len(pairs), 50_000):
                    some = pairs[at : at + 50_000]
                    columns = [np.full(len(some), chunk, np.int64), some, some // n_b, n[at : at + 50_000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "pair", "a", "n"])

    rows = found.where("kind = 1").select("chunk", "pairs", "times")
    return rows.mapInArrow(run, "chunk long, pair long, a long, n long")


def _summed(table: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums over their links; ``counts`` has the chunk's pairs."""
    order = np.argsort(counts["pair"].to_numpy())
    n = counts["n_docs"].to_numpy()[order]
    best = counts["best"].to_numpy()[order]
    n_best, count_sum = [], []
    for steps, times, k in zip(*(table[c].to_pylist() for c in ("pairs", "times", "piece"))):
        place, often = np.cumsum(_wide(steps, k)), _wide(times, k)
        n_best.append(int((often * best[place]).sum()))
        count_sum.append(int((often * n[place]).sum()))
    kept = table.select(["key", *[c for c, _ in _NUMBERS], "groups_sha256"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align_tokenizers(df: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", piece: int = PIECE) -> DataFrame:
    """A row for every row of ``df``: its tokens by A and by B, their groups, links and corpus-wide counts.

    ``a``: a byte-level file of the tokenizers library, read after one space;
    ``b``: a sentencepiece model that adds a space; both readable by every executor.
    key (as a 64-bit number), n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum. A NULL or empty text, and one whose tokens are not its bytes, has
    zeros and an empty digest. Rows that share a key, NULL included, are each
    counted and returned; other columns are left aside, whatever their names; an
    empty table gives no rows. A chunk's documents hold about CHUNK_PAIRS distinct
    pairs in all, or one document more.
    """
    t = tokenizers(a, b)
    rows = df.select(col(key).cast("long").alias("key"), col(text).alias("text"))
    read = _written(_read_and_merge(rows, a, b, piece), "alignment")
    pieces = read.where("kind = 2")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(tasks, "row", "piece")
    found = read.where("kind < 2").unionByName(_written(_stitch(_merge_pieces(dealt, a, b), a, b), "stitched"))
    pairs = _chunk_pairs(found, t.kind, t.n_b)
    total = pairs.groupBy("pair", "a").agg(F.sum("n").alias("n_docs"))
    # an A id has at most as many rows here as B has ids
    total = total.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a"))).drop("a")
    counts = pairs.join(total, "pair").select("chunk", "pair", "n_docs", "best")
    docs = found.where("kind = 0").select("chunk", "key", *[c for c, _ in _NUMBERS], "groups_sha256", "pairs", "times", "piece")
    out = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return docs.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_summed, out)
