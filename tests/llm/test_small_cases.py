"""Defined results for NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetschema.llm import decontaminate, embeddings, html, linedup, mixing, pii, quality, sharding, simhash, substring

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Every oddity at once; the id, the text, or everything but the id may be missing."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a", 10),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a", 10),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a", 10),
        (3, "", "en", "b", 0),
        (4, None, None, None, None),
        (None, "no id at all here", "fr", "b", 17),
        (None, None, None, None, None),
        (5, long, "en", "c", len(long)),
        (6, long + " more", "en", None, None),
        (7, " \n\t ", "de", "a", -5),
        (8, "ÄÖÜ \U0001f600 café", "de", "b.c", 11),
    ]
    return spark.createDataFrame(rows, DOCS)


CLASHES = ["size", "source_size", "target", "copies", "taken", "hits", "score", "removed", "replaced", "fingerprint",
           "component_id", "shard", "slot", "row_hash", "hash", "node", "weight", "tie", "d0", "__unit", "a.b", "work",
           "key", "mark", "n", "id", "v", "words", "Score"]


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("*", *[F.lit(k).alias(c) for k, c in enumerate(c for c in CLASHES if c != "Score")])


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def operators(spark):
    marked = labels(spark, [(1, 1), (3, 0), (5, 0), (8, 1), (8, 1), (None, 1), (99, 0), (2, None)])
    bench = items(spark, [(1, "alpha beta gamma"), (2, None), (3, ""), (None, "word3 word4"), (4, "alpha")])

    def classify(df):
        return quality.score_quality(df, quality.fit(df.select("doc_id", "text"), marked))

    return {
        "quality": classify,
        "substring": lambda df: substring.dedup_substrings(df, min_words=3),
        "decontaminate": lambda df: decontaminate.find_hits(df, bench),
        "sharding": lambda df: sharding.shard_documents(df, shards=3),
        "linedup": lambda df: linedup.dedup_lines(df, min_lines=1),
        "pii": pii.pseudonymise,
        "mixing": mixing.mix_sources,
    }


NAMES = ["quality", "substring", "decontaminate", "sharding", "linedup", "pii", "mixing"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_all_come_back(spark, odd, name):
    out = operators(spark)[name](odd)
    assert out.columns[:5] == odd.columns
    assert sorted(map(str, out.select("doc_id", "lang", "source", "n_chars").collect())) == sorted(
        map(str, odd.select("doc_id", "lang", "source", "n_chars").collect())
    )


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, odd, name):
    out = operators(spark)[name](odd.limit(0))
    assert out.collect() == [] and out.columns[:5] == odd.columns


@pytest.mark.parametrize("name", NAMES)
def test_clashing_names(spark, odd, clashing, name):
    plain, out = operators(spark)[name](odd), operators(spark)[name](clashing)
    assert out.columns[: len(clashing.columns)] == clashing.columns
    added = plain.columns[5:]
    new = out.columns[len(clashing.columns) :]
    assert len(new) == len(added) and len({c.lower() for c in out.columns}) == len(out.columns)
    left = plain.select(*[F.col(c).cast("string") for c in added]).collect()
    right = out.select(*[F.col(f"`{c}`").cast("string") for c in new]).collect()
    assert sorted(map(tuple, left), key=str) == sorted(map(tuple, right), key=str)


def test_mixing_of_odd_rows(odd):
    rows = mixing.mix_sources(odd).collect()
    assert [r["size"] for r in rows if r["doc_id"] == 4] == [0]
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(r["target"] <= 2 * r["source_size"] for r in rows)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert len({r["taken"] for r in rows if r["doc_id"] == 2}) == 1


def test_hits_of_odd_rows(spark, odd):
    rows = operators(spark)["decontaminate"](odd).select("doc_id", "hits.*").collect()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by_id[4]["n_words"] == 0 and by_id[4]["items"] == []
    assert by_id[1]["items"] == [1, 4] and [tuple(s) for s in by_id[1]["spans"]] == [(0, 3)]
    assert by_id[5]["items"] == [] and len(by_id[5]["spans"]) == 41  # an item without an id hits but has no name
    assert by_id[5]["n_words"] == 40_000


def test_benchmark_without_words_or_rows(spark, odd):
    for rows in ([], [(1, None), (2, ""), (3, " .,;")]):
        hits = decontaminate.find_hits(odd, items(spark, rows)).select("hits.*").collect()
        assert all(h["spans"] == [] and h["items"] == [] for h in hits)
        assert decontaminate.decontaminate(odd, items(spark, rows)).count() == odd.count()


def test_no_labels_and_one_label(spark, odd):
    for rows, score in (([], 0.5), ([(1, 1), (8, 1)], 1.0), ([(1, 0)], 0.0)):
        model = quality.fit(odd.select("doc_id", "text"), labels(spark, rows))
        assert {r["score"] for r in quality.score_quality(odd, model).collect()} == {score}


def test_shards_of_odd_rows(odd):
    rows = sharding.shard_documents(odd, shards=3).collect()
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {r["shard"] for r in rows} <= {0, 1, 2}


def test_more_shards_than_rows(odd):
    rows = sharding.shard_documents(odd, shards=64).collect()
    assert len(rows) == odd.count() and all(0 <= r["shard"] < 64 for r in rows)
    assert {r["shard"] for r in sharding.shard_documents(odd, target_bytes=10**9).collect()} == {0}


def test_simhash_of_odd_rows(odd):
    rows = simhash.near_duplicate_groups(odd).collect()
    assert len(rows) == odd.count()
    group = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"]}
    assert group[1] == group[2] == 1 and group[3] == group[4] == group[7] == 3
    assert {r["component_id"] for r in rows if r["doc_id"] is None and r["text" if "text" in r else "lang"] is None} == {3}
    kept = simhash.drop_near_duplicates(odd).collect()
    ids = sorted(str(r["doc_id"]) for r in kept)
    assert ids == sorted(["1", "3", "None", "5", "8"]) or ids == sorted(["1", "3", "None", "5", "6", "8"])


def test_simhash_with_clashing_names(odd, clashing):
    out = simhash.near_duplicate_groups(clashing)
    assert "fingerprint_" in out.columns and "component_id_" in out.columns
    assert simhash.drop_near_duplicates(clashing).columns == clashing.columns
    assert simhash.near_duplicate_groups(odd.limit(0)).collect() == []
    assert simhash.drop_near_duplicates(odd.limit(0)).collect() == []


def test_near_duplicates_without_any_id(spark):
    rows = [(None, "a b c d e f", k) for k in (1, 1, 2)] + [(None, "quite another text than that", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x int")
    kept = simhash.drop_near_duplicates(docs).collect()
    assert len(kept) == 2 and len({r["text"] for r in kept}) == 2


VECTORS = "vec_id long, embedding array<float>, label int"


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0, 0.0, 2.0]
    rows = [(1, a), (2, [2.0, 0.0, 4.0]), (3, a), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]),
            (8, [nan, 0.0, 1.0]), (9, [inf, 0.0, 1.0]), (None, a), (10, [1.0, 0.0]), (11, [5.0, 0.0]), (3, a), (12, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    got = {}
    for r in embeddings.near_duplicate_vectors(df).collect():
        got.setdefault(r["vec_id"], []).append(tuple(r)[1:])
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] and got[3] == [(3, 1, False)] * 2
    assert got[10] == [(1, 10, True)] and got[11] == [(1, 10, False)]
    assert all(got[k] == [(0, k, True)] for k in (4, 5, 6, 7, 8, 9, 12)) and got[None] == [(0, None, True)]
    assert embeddings.near_duplicate_vectors(df.limit(0)).collect() == []


def test_odd_pages(spark):
    rows = [(1, "http://x.org/a", None), (2, None, "<p>one<p>two"), (3, "http://X.org:80/b", ""), (4, "nonsense", "plain &amp; text"),
            (5, "http://x.org/c", "<article><p>Kept.</article>"), (5, "http://x.org/c", "<article><p>Kept.</article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = html.extract_main_text(df)
    assert out.columns == [*df.columns, "text_"]
    got = {r["page_id"]: r["text_"] for r in out.collect()}
    assert got == {1: "", 2: "one\n\ntwo", 3: "", 4: "plain & text", 5: "Kept."}
    assert html.extract_main_text(df.limit(0)).collect() == [] and out.count() == 6


def test_pseudonyms_of_odd_rows(odd):
    rows = pii.pseudonymise(odd).collect()
    assert {r["text"] for r in rows} == {r["text"] for r in odd.collect()} and all(r["replaced"] == [] for r in rows)


def test_zero_vectors_have_a_score():
    assert (quality.term_vector(None) == 0).all() and (quality.term_vector("") == 0).all()
    assert np.isfinite(quality.term_vector("x")).all()
