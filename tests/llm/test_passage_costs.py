"""Anchors of windows, places of words, and the plan that finds repeated windows."""

import random
import re

import numpy as np
import pyarrow as pa

from fleetschema.llm import lines, substring


def test_equal_windows_hold_equal_anchors(monkeypatch):
    rng = random.Random(8)
    long = "ab" * 300
    for k in range(120):
        words = [rng.choice(["a", "b", long, long + "c", "é"]) if k % 3 else str(rng.randrange(50)) for _ in range(rng.randint(0, 180))]
        monkeypatch.setattr(substring, "_PIECE", 10_000)
        places, hashes = substring.anchors(words)
        assert all(((places >= w) & (places <= w + 25)).any() for w in range(len(words) - 49))
        # the same stretches of another text, words before them, have the same hashes, in one piece or many
        monkeypatch.setattr(substring, "_PIECE", 37)
        others = dict(zip(*(x.tolist() for x in substring.anchors(["zz", long, "y"] + words))))
        inner = [(p, h) for p, h in zip(places.tolist(), hashes.tolist()) if all(substring.PASSAGE < x for x in (p, len(words) - p))]
        assert all(others[p + 3] == h for p, h in inner)
        stretches = {tuple(words[p : p + 25]): h for p, h in zip(places.tolist(), hashes.tolist())}
        assert len(set(stretches.values())) == len(stretches)


def test_places_of_words():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", "\U0001f600", " ", "\n", "\x1c", "\x85", " ", "　", "、", "​"]) for _ in range(rng.randint(0, 30)))
        starts, ends = lines.word_spans(text)
        assert list(zip(starts.tolist(), ends.tolist())) == [m.span() for m in re.finditer(r"\S+", text)]
        assert len(starts) == len(text.split())


def test_spans_of_scattered_windows():
    text = "\n".join(" ".join(f"w{k}" for k in range(n, n + 7)) for n in range(0, 210, 7))
    ws, firsts = np.array([120, 3, 7, 13, 60], np.int32), pa.array([5, 1, 2, None, 4], pa.int64())
    cut, spans = lines.passage_spans(text, "\n", [{"start": 0, "stop": 2, "lines": 1, "first": 9}], ws, firsts, 10)
    word = [m.span() for m in re.finditer(r"\S+", text)]
    want = [(word[0][0], word[0][1], 1, 9), (word[3][0], word[22][1], 4, 1), (word[60][0], word[69][1], 2, 4), (word[120][0], word[129][1], 2, 5)]
    assert [tuple(s.values()) for s in spans] == want
    gone = {0, *range(3, 23), *range(60, 70), *range(120, 130)}
    assert cut.split() == [f"w{k}" for k in range(210) if k not in gone]


def test_windows_are_grouped_without_sorting(spark, monkeypatch):
    plans, stage = {}, substring.stage

    def seen(df, label, *rest):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label, *rest)

    monkeypatch.setattr(substring, "stage", seen)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.createDataFrame([(3, f"x {passage}"), (None, f"y {passage}"), (2, f"z {passage} z"), (2, f"u {passage}")], "doc_id long, text string")
    got = substring.repeated_passages(docs, "doc_id", "text").collect()
    assert sorted((r["key"] or 0, len(r["passages"])) for r in got) == [(0, 11), (2, 11), (3, 11)]
    assert {p["first"] for r in got for p in r["passages"]} == {2}
    assert "SortAggregate" not in plans["repeated-windows"]
