"""The pipeline's near-dedup against all pairs of five-word Jaccard 0.8 and more."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetschema.llm import jaccard, simhash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def kept_by_all_pairs(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and 10 * len(x & y) >= 8 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted(i for i in ids if find(i) == i)


@pytest.fixture(scope="module")
def near():
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(5000)}"
    docs = []
    for group in range(25):
        base = [word() for _ in range(rng.choice([3, 40, 120, 300]))]
        for _ in range(5):  # few to many words changed: on either side of 0.8
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 30))):
                text[rng.randrange(len(text))] = word()
            docs.append((len(docs), " ".join(text)))
    return [*docs, (900, ""), (901, None), (902, " \n")]


def test_near_dedup_equals_all_pairs(spark, near):
    df = spark.createDataFrame(near, "doc_id long, text string")
    want = kept_by_all_pairs(near)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == want
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()) != want


def test_rows_without_ids_and_equal_rows(spark):
    rows = [(None, "a b c d e f", k) for k in (1, 1, 2)] + [(3, "a b c d e f", 1)] * 2 + [(None, "quite another text", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = jaccard.drop_similar(df)
    assert kept.columns == df.columns and sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["3", "None"]
    assert jaccard.drop_similar(df.limit(0)).collect() == [] and jaccard.drop_similar(df.where(F.col("row") == 3)).count() == 1


def test_counts_of_common_shingles(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 400)
    sets = []
    for _ in range(40):
        kept = base[rng.random(400) < rng.choice([0.5, 0.9, 0.97])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, rng.integers(0, 60))])))
    sets += [sets[0], np.array([5]), np.arange(10), np.arange(8)]  # 8 of 10: the threshold itself
    monkeypatch.setattr(jaccard, "STRIP", 64)
    got = jaccard.chunk_links(sets, 0.8)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            common = len(np.intersect1d(x, y))
            assert a == b or got[a, b] == (10 * common >= 8 * (len(x) + len(y) - common))
    root = jaccard.roots(len(sets), got)
    assert root[-1] == root[-2] == len(sets) - 2 and root[40] == root[0]


def test_buckets_in_several_chunks(spark, monkeypatch):
    """One group of edited copies in chunks of a few, and texts alike to 0.7 that no chain of links joins."""
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    rng = random.Random(5)
    text = [f"w{k}" for k in range(300)]
    docs = []
    for k in range(60):
        words = list(text)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(300)] = f"e{k}x{rng.randrange(9999)}"
        docs.append((k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == kept_by_all_pairs(docs)


def test_any_names_nulls_and_long_texts(spark):
    long_ = " ".join(f"w{k}" for k in range(60_000))
    rows = [(3, long_, 1, "a"), (2, long_ + " more", 2, "b"), (None, long_, 3, "c"), (5, None, 4, "d"), (4, "", 5, "e"), (7, "short", 6, "f"), (7, "short", 6, "f")]
    schema = "doc_id long, text string, f int, v string"
    for names in (["doc_id", "text", "f", "v"], ["doc_id", "text", "row_hash", "key"], ["doc_id", "text", "__row", "component"], ["doc_id", "text", "found", "Buckets"]):
        df = spark.createDataFrame(rows, schema).toDF(*names)
        got = jaccard.drop_similar(df)
        assert got.columns == names and sorted(r["doc_id"] for r in got.collect()) == [2, 4, 7]


def test_simhash_finds_the_candidates(spark, near, monkeypatch):
    """The stage's candidates are fingerprints that are near by SimHash; without any nothing but equal sets is linked."""
    for a, b in [(4, 5), (13, 14), (90, 90)]:  # four of five shingles, and 0.8 in larger sets
        apart = []
        for k in range(300):
            both = np.random.default_rng(k).integers(0, 1 << 63, a + b, dtype=np.uint64)
            common = round(0.8 * (a + b) / 1.8)
            one, other = both[:a], np.concatenate([both[:common], both[a : a + b - common]])
            one, other = simhash.wide_fingerprint(one), simhash.wide_fingerprint(other)
            apart.append(np.bitwise_count(np.array([simhash.compared_words(one) ^ simhash.compared_words(other)]).view(np.uint64)).sum())
            assert (simhash.bands(one) == simhash.bands(other)).any()
        assert np.mean(apart) < 22 and max(apart) <= jaccard.REACH
    df = spark.createDataFrame(near, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "bands", lambda bits: np.arange(simhash.BANDS))
    monkeypatch.setattr(jaccard, "REACH", -1)
    monkeypatch.setattr(jaccard, "clusters", lambda f, s, t: iter(()))
    rest = sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect())
    first = {}
    for i, text in near:
        first.setdefault(frozenset(shingles(text)), i)
    assert rest == sorted(first.values())


def test_bands_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PRINTS", 5)
    rng = random.Random(9)
    text = [f"w{k}" for k in range(200)]
    docs = []
    for k in range(40):
        words = list(text)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(200)] = f"e{k}x{rng.randrange(9999)}"
        docs.append((k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == kept_by_all_pairs(docs)


def edited_copies(n, edits, seed=21):
    rng = random.Random(seed)
    docs = []
    for k in range(n):
        words = [f"w{k}" for k in range(300)]
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(300)] = f"e{k}x{rng.randrange(9999)}"
        docs.append((k, " ".join(words)))
    return docs


@pytest.mark.parametrize("at", ["chunk_links", "clusters"])
def test_large_groups_cost_what_they_have_rows(spark, monkeypatch, at):
    """240 near copies in chunks of 12: each is read a few times, not once for every chunk."""
    monkeypatch.setattr(jaccard, {"chunk_links": "CHUNK", "clusters": "PRINTS"}[at], 12)
    monkeypatch.setattr(jaccard, "bands", lambda bits: np.zeros(1, np.int64))
    seen, inner = spark.sparkContext.accumulator(0), getattr(jaccard, at)

    def counted(first, *more):
        seen.add(len(first))
        return inner(first, *more)

    monkeypatch.setattr(jaccard, at, counted)
    df = spark.createDataFrame(edited_copies(240, 3), "doc_id long, text string").repartition(5)
    assert [r["doc_id"] for r in jaccard.drop_similar(df).collect()] == [0]
    assert 240 <= seen.value <= 3 * 240


def test_a_set_is_compared_once_not_once_a_band(spark, monkeypatch):
    seen, inner = spark.sparkContext.accumulator(0), jaccard.chunk_links

    def counted(sets, similarity):
        seen.add(len(sets))
        return inner(sets, similarity)

    monkeypatch.setattr(jaccard, "chunk_links", counted)
    docs = edited_copies(60, 14)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == kept_by_all_pairs(docs)
    assert seen.value <= 60


@pytest.mark.parametrize("at", ["CHUNK", "PRINTS"])
def test_what_dealing_leaves_open_is_compared_whole(spark, monkeypatch, at):
    monkeypatch.setattr(jaccard, at, 7)
    monkeypatch.setattr(jaccard, "DEALS", 0)
    docs = edited_copies(60, 14)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == kept_by_all_pairs(docs)


def test_units_with_many_chunks_are_compared_by_clusters(spark, monkeypatch):
    """A row of texts, each near the next, with every tenth step too far for a link."""
    rng = random.Random(2)
    words, docs, at = [f"w{rng.randrange(10**6)}" for _ in range(2000)], [], 0
    for k in range(120):
        docs.append((k, " ".join(words[at : at + 300])))
        at += 40 if k % 10 == 9 else 5
    used, inner = [], jaccard.by_clusters

    def chosen(shared, units):
        found = inner(shared, units)
        used.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "by_clusters", chosen)
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    monkeypatch.setattr(jaccard, "ROUNDS", (0, 2, simhash.BANDS))
    monkeypatch.setattr(jaccard, "bands", lambda bits: simhash.bands(bits)[:5])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == kept_by_all_pairs(docs) == list(range(0, 120, 10))
    assert used[0] > 0


def test_sets_that_cannot_have_a_link_are_not_compared(spark, monkeypatch):
    """200 texts that share 0.7 or so in pairs, far more than a chunk, and a few links among them."""
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    seen, inner = spark.sparkContext.accumulator(0), jaccard.chunk_links

    def counted(sets, similarity):
        seen.add(len(sets))
        return inner(sets, similarity)

    monkeypatch.setattr(jaccard, "chunk_links", counted)
    docs = [(k, " ".join([*(f"w{j}" for j in range(170)), *(f"e{k}x{j}" for j in range(36))])) for k in range(200)]
    docs += [(200 + k, docs[20 * k][1] + " more") for k in range(5)]
    docs += [(300, " ".join(f"w{j}" for j in range(170)))]  # 0.82 of it in common with each: a link to all
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = kept_by_all_pairs(docs)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == want == [0]
    seen.value = 0
    docs.pop()
    docs = [(k, text + f" f{k} g{k} h{k} i{k}" * 3) if k < 200 and k % 20 else (k, text) for k, text in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = kept_by_all_pairs(docs)
    assert sorted(r["doc_id"] for r in jaccard.drop_similar(df).collect()) == want and len(want) == 200
    assert seen.value < 2 * 205
