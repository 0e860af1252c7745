"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are byte trigrams, once of character classes and once of lower-case letters
(hashed), and how often a word follows itself. The term vectors of a bounded
sample of labelled texts give the latent space by a singular value
decomposition; the sample's latent vectors are broadcast, every document is
compared with all of them in blocks, and the labels of the nearest vote, weighted
by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetschema.llm.common import col, extended, free, map_batches
from fleetschema.staging import stage

#: labelled texts of each label that the model is fitted on, at most; 2 x 2048 x 32 numbers are broadcast
SAMPLE = 2048
DIMENSIONS = 32
NEIGHBOURS = 15
#: a neighbour's weight is its cosine to this power, so that a rare kind of text is not outvoted by remote ones
SHARPNESS = 4
KEEP = 0.3

_CLASSES, _LETTERS = 11, 512


def _class_of(b: int) -> int:
    c = chr(b)
    kinds = (c == " ", c in "\r\n", "a" <= c <= "z", "A" <= c <= "Z", "0" <= c <= "9", c in ".,", c == "|", c in "!?", c in "*#%&$@^~+=<>", b >= 128)
    return kinds.index(True) if any(kinds) else len(kinds)


_CLASS = bytes(map(_class_of, range(256)))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
TERMS = _CLASSES**3 + _LETTERS + 2


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def term_vector(text: str | None) -> np.ndarray:
    """Square roots of term counts, each kind of terms at length 1 or less; no text: all zero."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    raw = b"\n" + text.encode() + b"\n"
    c = np.frombuffer(raw.translate(_CLASS), np.uint8).astype(np.uint16)
    low = np.frombuffer(raw.translate(_LOWER), np.uint8).astype(np.uint16)
    classes = np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=_CLASSES**3)
    letters = np.bincount((low[:-2] * 961 + low[1:-1] * 31 + low[2:]) % _LETTERS, minlength=_LETTERS)
    words = text.split()
    repeated = sum(map(eq, words, words[1:])) / max(1, len(words) - 1)
    out[: _CLASSES**3] = _unit(np.sqrt(classes))
    out[_CLASSES**3 : -2] = 0.5 * _unit(np.sqrt(letters))
    out[-2:] = np.sqrt([repeated, 1 - repeated])
    return out


@dataclass
class Model:
    """The latent space (mean and basis of term vectors) and the labelled vectors in it."""

    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1; a text without any term, or without a neighbour at a positive cosine, gets the prior."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        filled = [i for i, t in enumerate(texts) if t]
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(filled), 256):
            rows = filled[at : at + 256]
            terms = np.stack([term_vector(texts[i]) for i in rows])
            cosines = _unit((terms - self.mean) @ self.basis) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weights = np.take_along_axis(cosines, near, axis=1).clip(0).astype(np.float64) ** SHARPNESS
            total = weights.sum(axis=1)
            voted = (weights * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            out[rows] = np.where(total > 0, voted, self.prior).clip(0, 1)
        return out


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """A model of at most ``sample`` labelled texts of either label, those with the smallest hash of their key.

    Labels are 0 and 1; a key with several takes their mean, others and NULL count
    for nothing. Labelled keys without a document, or with an empty text, are left out. Of rows that
    repeat a key one is taken. Without any label every score is 0.5.
    """
    marked = labels.where(col(label).isin(0, 1) & col(key).isNotNull()).groupBy(col(key).alias("key"))
    marked = marked.agg(F.avg(col(label)).alias("label"))
    named = documents.select(col(key).alias("key"), col(text).alias("text"))
    known = stage(marked.join(named.where("text != ''").select("key"), "key", "left_semi"), "labelled")
    prior = known.agg(F.avg("label")).first()[0]
    place = F.xxhash64(F.col("key").cast("string"))
    sides = [known.where(side).orderBy(place, "key").limit(sample) for side in ("label < 0.5", "label >= 0.5")]
    chosen = stage(sides[0].unionByName(sides[1]), "labelled-sample")

    def vectors(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = [term_vector(batch.column(1)[i].as_py()).astype("<f2").tobytes() for i in range(batch.num_rows)]
        return [pa.array(rows, pa.binary()), batch.column(0)]

    texts = named.where("text != ''").join(chosen, "key").select(F.struct("key", "label").alias("of"), "text")
    schema = T.StructType([T.StructField("v", T.BinaryType()), texts.schema.fields[0]])
    held = map_batches(texts, schema, vectors).groupBy("of.key").agg(F.min(F.struct("v", "of.label")).alias("r"))
    rows = held.select("key", "r.v", "r.label").orderBy("key").collect()  # at most 2 * sample rows of some 4 kB
    if not rows:
        return Model(np.zeros(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5 if prior is None else prior, neighbours)
    x = np.stack([np.frombuffer(r["v"], "<f2").astype(np.float32) for r in rows])
    mean = x.mean(axis=0)
    # right singular vectors by the Gram matrix of the terms
    _, basis = np.linalg.eigh(((x - mean).T @ (x - mean)).astype(np.float64))
    basis = basis[:, ::-1][:, :dimensions].astype(np.float32)
    return Model(mean, basis, _unit((x - mean) @ basis), np.array([r["label"] for r in rows]), float(prior), neighbours)


def score_quality(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Every row of ``df`` with its score, a double from 0 to 1 (higher: label 1 likelier).

    NULL and empty texts get the share of label 1 among the labelled documents.
    Whole texts are read, however long. Rows may repeat, an empty table gives no rows, the added
    column takes an underscore where the input has its name.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)

    def score(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, scores = batch.column(at), []
        for start in range(0, batch.num_rows, 256):  # some texts are very long
            scores.append(shared.value.scores(texts.slice(start, 256).to_pylist()))
        return [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())]

    return map_batches(df, extended(df, T.StructField(free(df.columns, name), T.DoubleType())), score)


def learnable(key: str) -> Column:
    """Rows that may be learned from: the crc32 of the key's text leaves a remainder by 5."""
    return F.coalesce(F.crc32(col(key).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def keep_good(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = KEEP) -> DataFrame:
    """The rows of ``df`` that score at least ``threshold``, with the columns of ``df``."""
    model = fit(df.select(col(key), col(text)), labels.where(learnable(key)), key, text)
    name = free(df.columns, "score")
    return score_quality(df, model, text, name).where(col(name) >= threshold).drop(name)
