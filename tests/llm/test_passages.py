"""Passages whose edges lie inside lines, in substring dedup."""

import random
import re

from fleetschema.llm import substring


def hit_words(docs, passage):
    """For each document the words of windows that an earlier document holds, by plain comparison."""
    seen, out = set(), {}
    for doc_id, text in docs:
        words = (text or "").lower().split()
        windows = [tuple(words[k : k + passage]) for k in range(len(words) - passage + 1)]
        out[doc_id] = {k + j for k, w in enumerate(windows) if w in seen for j in range(passage)}
        seen |= set(windows)
    return out


def test_passages_inside_lines(spark):
    rng = random.Random(4)
    word = lambda: f"W{rng.randrange(400)}"
    passage = [word() for _ in range(60)]
    docs = []
    for k in range(30):
        words = [word() for _ in range(rng.randint(0, 90))]
        if k % 3:
            cut = rng.choice([49, 50, 51, 60])
            words[rng.randint(0, len(words)) : 0] = passage[60 - cut :]
        docs.append((k, "".join(w + rng.choice([" "] * 9 + ["\n", " \t "]) for w in words)))
    docs += [(30, ""), (31, None), (32, "again " * 130), (33, "again " * 49), (34, "Again\n" * 51 + "end")]
    got = {r["doc_id"]: r for r in substring.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    want = hit_words(docs, 50)
    assert sum(map(bool, want.values())) > 9
    for doc_id, text in docs:
        words = [m.span() for m in re.finditer(r"\S+", text or "")]
        gone = {k for k, (a, b) in enumerate(words) if any(s["start"] <= a and b <= s["stop"] for s in got[doc_id]["removed"])}
        # short lines of one document that it repeats itself are cut as lines
        assert gone == want[doc_id] or (doc_id == 34 and gone > want[doc_id])
        assert (got[doc_id]["text"] or "").split() == [text[a:b] for k, (a, b) in enumerate(words) if k not in gone]
        assert all(s["lines"] > 0 and s["first"] < doc_id + (doc_id == 34) for s in got[doc_id]["removed"])


def test_white_space_around_a_passage(spark):
    passage = " ".join(f"w{k}" for k in range(55))
    docs = [(1, f"start {passage} end"), (2, f"one\ntwo {passage}\nthree"), (3, f"{passage} only"), (4, f"a {passage} b")]
    got = {r["doc_id"]: r for r in substring.dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[k]["text"] for k in (1, 2, 3, 4)] == [docs[0][1], "one\ntwo\nthree", "only", "a b"]
    (span,) = got[4]["removed"]
    assert docs[3][1][span["start"] : span["stop"]] == passage and span["first"] == 1 and span["lines"] == 1
