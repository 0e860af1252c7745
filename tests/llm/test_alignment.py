"""Alignment of two tokenizers against a token-by-token version of its rule."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fleetschema.llm import alignment, queries
from fleetschema.llm.encoders import byte_characters
from tests.conftest import SF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def token_bytes(texts):
    """Per text the (id, bytes) of A's and of B's tokens, by the libraries on whole texts."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {c: n for n, c in byte_characters().items()}
    out = []
    for text in texts:
        text = text or ""
        x = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        whole = text and b"".join(v for _, v in x) == want and b"".join(v for _, v in y) == want
        out.append((x, y) if whole else ([], []))
    return out


def spans(tokens):
    at, out = 0, []
    for i, v in tokens:
        out.append((i, at, at + len(v)))
        at += len(v)
    return out


def plain(rows):
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row."""
    links, out = [], []
    for x, y in token_bytes([t for _, t in rows]):
        x, y, found, j = spans(x), spans(y), [], 0
        for a, s, e in x:
            while j < len(y) and y[j][2] <= s:
                j += 1
            k = j
            while k < len(y) and y[k][1] < e:
                found.append((a, y[k][0]))
                k += 1
        ends = sorted({e for *_, e in x} & {e for *_, e in y})
        groups = []
        for lo, hi in zip([0, *ends], ends):
            of = [",".join(str(i) for i, s, e in v if lo <= s and e <= hi) for v in (x, y)]
            groups.append("|".join(of))
        text = ";".join(groups)
        links.append(found)
        out.append([len(x), len(y), len(groups), len(found), hashlib.sha256(text.encode()).hexdigest() if x else ""])
    count = Counter(p for found in links for p in set(found))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (key, *o, sum(count[p] == best[p[0]] for p in found), sum(count[p] for p in found))
        for (key, _), o, found in zip(rows, out, links)
    ]


def columns(df):
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_query_equals_plain_alignment(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    got = queries.QUERIES["op12_token_alignment"](spark, SF).withColumnRenamed("doc_id", "key")
    assert columns(got) == sorted(plain(rows), key=str)


ODD = [
    None, "", " ", "  ", "a", " lead", "trail ", "two  spaces\n\n and   three ", "<s>▁x</s> <0x41>", "<|endoftext|> hi",
    "日本語 text ñandú 🎉🎉 \U0001f9d1‍\U0001f4bb", "x\x00y", "tab\there\r\nnew", "﻿bom", "a" * 3000, "é ́", "…—…",
]


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_of_any_size_give_the_same(spark, con, monkeypatch, piece):
    """Every text cut into small pieces, closing ends at their edges included; chunks of few documents."""
    monkeypatch.setattr(alignment, "CHUNK_PAIRS", 300)
    rng = random.Random(piece)
    words = ["the", "naïve", "cat's", "1234", "überraschung", "!!", "\n", " ", "日本", "ing"]
    texts = ODD[:-5] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(25)]
    rows = [(k if k % 7 else None, t) for k, t in enumerate(texts)] + [(3, "the same"), (3, "the same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.align_tokenizers(df, A, B, piece=piece)
    assert columns(got) == sorted(plain(rows), key=str)


def test_odd_texts_and_names(spark):
    rows = [(k, t) for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, chunk int, pair string, `N_a` int")
    assert columns(alignment.align_tokenizers(df, A, B)) == sorted(plain(rows), key=str)


def test_empty_table(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_merge_path_on_every_diagonal():
    rng = np.random.default_rng(4)
    for _ in range(40):
        a = np.sort(rng.choice(60, rng.integers(0, 20), replace=False))
        b = np.sort(rng.choice(60, rng.integers(0, 20), replace=False))
        merged = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
        want = [sum(s == 0 for _, s in merged[:d]) for d in range(len(merged) + 1)]
        if len(a) and len(b):
            assert alignment.merge_path(a, b, np.arange(len(merged) + 1)).tolist() == want


def test_pieces_hold_equal_work():
    a, b = np.arange(3, 30_000, 3), np.arange(1, 30_000, 7)
    at = alignment.cuts(a, b, 1_000)
    work = [i1 - i0 + j1 - j0 for (i0, j0), (i1, j1) in zip(at[:-1], at[1:])]
    assert set(work[:-1]) == {1_000} and sum(work) == len(a) + len(b)
