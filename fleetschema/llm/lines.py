"""Lines of documents, their digests, and texts with lines cut out."""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, free, map_batches

LINES = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("words", T.IntegerType()),
        T.StructField("digest", T.BinaryType()),
    ]
)
#: of the whole text: a digest of its lines, and how many there are
WHOLE = [T.StructField("whole", T.BinaryType()), T.StructField("total", T.IntegerType())]
REMOVED = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
            T.StructField("lines", T.IntegerType()),
            T.StructField("first", T.LongType()),
        ]
    )
)

#: whether a character is white space, as for ``str.split``; none from the last one on is
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)], np.int8)


def mark_of(key: str, text: str) -> Column:
    """Tells apart rows that share a key: rows that agree in key and text count as one document."""
    return F.xxhash64(col(key), col(text))


def units(text: str, sep: str) -> list[tuple[int, int]]:
    """[start, stop) of each unit between separators, in code points."""
    out, at = [], 0
    for part in text.split(sep):
        out.append((at, at + len(part)))
        at += len(part) + len(sep)
    return out


def normalised(unit: str) -> str:
    return " ".join(unit.lower().split())


def line_table(df: DataFrame, key: str, text: str, sep: str = "\n", whole: bool = False) -> DataFrame:
    """(key, mark, n, words, digest): every unit that is not blank; ``n`` counts those of a text from 0.

    With ``whole`` the first unit of a text also has ``WHOLE``.
    """

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        keys, marks, ns, words, digests, wholes, totals = [], [], [], [], [], [], []
        for i in range(batch.num_rows):
            key_, mark, text_ = (batch.column(k)[i].as_py() for k in range(3))
            n = 0
            for unit in text_.split(sep) if text_ else ():
                if plain := normalised(unit):
                    keys.append(key_)
                    marks.append(mark)
                    ns.append(n)
                    words.append(plain.count(" ") + 1)
                    digests.append(hashlib.blake2b(plain.encode(), digest_size=16).digest())
                    n += 1
            if n:
                wholes += [hashlib.blake2b(b"".join(digests[-n:]), digest_size=16).digest(), *[None] * (n - 1)]
                totals += [n, *[None] * (n - 1)]
        columns = [(keys, pa.int64()), (marks, pa.int64()), (ns, pa.int32()), (words, pa.int32()), (digests, pa.binary())]
        columns += [(wholes, pa.binary()), (totals, pa.int32())] if whole else []
        return [pa.array(v, t) for v, t in columns]

    rows = df.select(col(key).cast("long").alias("key"), mark_of(key, text).alias("mark"), col(text).alias("text"))
    return map_batches(rows, T.StructType([*LINES.fields, *(WHOLE if whole else [])]), cut)


def stretches(text: str, sep: str, first_of: dict[int, int | None], min_words: int) -> tuple[str, list[dict]]:
    """The text without the stretches of listed units that have ``min_words`` words, and these stretches.

    Listed units that follow each other, blank ones between them left aside, are
    one stretch. ``first_of`` has the number of each listed unit.
    """
    spans: list[dict] = []
    kept: list[str] = []
    held: list[tuple[int, int]] = []  # units of the stretch that is being read, blank ones after it included
    open_, n = None, -1

    def settle() -> None:
        nonlocal open_, held
        if open_ and open_.pop("words") >= min_words:
            spans.append(open_)
            held = [u for u in held if u[0] > open_["stop"]]
        kept.extend(text[a:b] for a, b in held)
        open_, held = None, []

    for start, stop in units(text, sep):
        words = len(text[start:stop].split())
        n += words > 0
        if words and n in first_of:
            if open_ is None:
                open_ = {"start": start, "stop": stop, "lines": 0, "first": first_of[n], "words": 0}
            open_["stop"], open_["lines"], open_["words"] = stop, open_["lines"] + 1, open_["words"] + words
            held.append((start, stop))
        elif not words and open_ is not None:
            held.append((start, stop))
        else:
            settle()
            kept.append(text[start:stop])
    settle()
    return sep.join(kept), spans


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each word between white space begins and ends, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = np.ones(len(codes) + 2, np.int8)
    space[1:-1] = _SPACE[np.minimum(codes, len(_SPACE) - 1)]
    edges = np.diff(space)
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def passage_spans(text: str, sep: str, spans: list[dict], ws: np.ndarray, firsts: pa.Array, passage: int) -> tuple[str, list[dict]]:
    """The text without ``spans`` and the windows of ``passage`` words that start at the listed words, and what was cut.

    ``firsts`` has the document of each window. Spans that touch are one.
    ``lines`` counts the units that a span holds or cuts into. Of the white space
    on both sides of a span one side stays, one with a separator if there is one.
    """
    starts, ends = word_spans(text)
    order = np.argsort(ws, kind="stable")
    ws = ws[order]
    cuts = np.flatnonzero(np.diff(ws) > passage) + 1  # windows that neither overlap nor touch
    found = [(s["start"], s["stop"], s["first"], s["stop"]) for s in spans]
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ws)]):
        low, high = ws[a], ws[b - 1] + passage - 1
        found.append((int(starts[low]), int(ends[low + passage - 1]), firsts[int(order[a])].as_py(), int(ends[high])))
    merged: list[dict] = []
    for start, _, first, stop in sorted(found, key=lambda s: s[:2]):
        if merged and not text[merged[-1]["stop"] : start].strip():
            merged[-1]["stop"] = max(merged[-1]["stop"], stop)
        else:
            merged.append({"start": start, "stop": stop, "lines": 0, "first": first})
    lines = [(a, b) for a, b in units(text, sep) if text[a:b].strip()]
    line_starts, line_stops = [a for a, _ in lines], [b for _, b in lines]
    kept, at = "", 0
    for span in merged:
        span["lines"] = bisect_left(line_starts, span["stop"]) - bisect_right(line_stops, span["start"])
        kept = _joined(kept, text[at : span["start"]], sep) if at else text[: span["start"]]
        at = span["stop"]
    return _joined(kept, text[at:], sep), merged


def _joined(left: str, right: str, sep: str) -> str:
    before, after = left[len(left.rstrip()) :], right[: len(right) - len(right.lstrip())]
    space = after if sep in after and sep not in before else before or after
    left, right = left.rstrip(), right.lstrip()
    return left + space + right if left and right else left + right


def cut_lines(
    df: DataFrame,
    gone: DataFrame,
    key: str,
    text: str,
    sep: str = "\n",
    min_words: int = 0,
    name: str = "removed",
    passage: int | None = None,
) -> DataFrame:
    """``df`` with the units listed in ``gone`` taken out of its texts.

    gone: (key, mark, lines), lines an array of (n, first): the unit's number and
    the key of the document that keeps it. ``removed`` gives each stretch that was
    cut as [start, stop) in code points of the original text, how many units it
    holds and the key that keeps its first one. Every row of ``df`` is returned.
    With ``passage`` gone also has passages, an array of (w, first): the first
    words of windows of so many words that go too; lines and passages may be NULL.
    """
    columns, name = df.columns, free(df.columns, name)
    at = columns.index(text)
    lists = ["lines", "passages"] if passage else ["lines"]
    named = gone.select(*[F.col(c).alias(f"__{c}") for c in ["key", "mark", *lists]])
    same = col(key).cast("long").eqNullSafe(F.col("__key")) & (mark_of(key, text) == F.col("__mark"))
    # the list grows with the texts: the same plan at every size
    joined = df.join(named.hint("merge"), same, "left").select(*map(col, columns), *[f"__{c}" for c in lists])

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, lists = batch.column(at), batch.column(len(columns))
        out, removed = [], []
        for i in range(batch.num_rows):
            text_, lost = texts[i].as_py(), lists[i].as_py()
            spans: list[dict] = []
            whole = text_
            if lost and text_:
                text_, spans = stretches(text_, sep, {x["n"]: x["first"] for x in lost}, min_words)
            windows = batch.column(len(columns) + 1)[i].values if passage else None
            if windows and whole:
                ws, firsts = windows.flatten()
                text_, spans = passage_spans(whole, sep, spans, ws.to_numpy(), firsts, passage)
            out.append(text_)
            removed.append(spans)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lines", pa.int32()), ("first", pa.int64())]))
        new = [pa.array(out, pa.string()) if k == at else batch.column(k) for k in range(len(columns))]
        return [*new, pa.array(removed, kind)]

    return map_batches(joined, extended(df, T.StructField(name, REMOVED)), cut)
