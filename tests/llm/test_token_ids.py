"""Token ids: exact round trip, against whole texts encoded by the library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetschema.llm import queries, tokenids
from fleetschema.llm.encoders import word_encoder
from fleetschema.staging import new_folder
from tests.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\n", "a  b", "a\n b", "a \n  b ", " x y　", "é ́x\ń", "<|endoftext|> a<|startoftext|>b",
    "I'LL it's 'S 12 3a4 !?…", "İSTANBUL ẞ 한국", "x\x1cy\x85z\x0b\x0cq\r\n r", "\x00 \x00a", "z" * 50_000, "ab! " * 30_000,
]


def whole(texts, path=PATH, plain=False):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts(n=200):
    rng = random.Random(11)
    parts = ["a", "Bc", "'s", "12", "!", " ", "  ", "\n", "\t", " ", "́", "<|endoftext|>", " ", "\x1c", "\x85", "ﬁ"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("name, keeps_space, plain", [("word_bpe_49k.json", False, False), ("byte_bpe_50k.json", True, True)])
def test_pieces_give_the_ids_of_whole_texts(con, name, keeps_space, plain):
    texts = odd_texts() + [t or "" for (t,) in con.execute("SELECT text FROM documents").fetchall()]
    encoder = word_encoder(public_tokenizers.path(name), keeps_space, plain, cache_words=2_000, text_bytes=100_000)
    got = [some[a:b].tolist() for some, at in encoder.encode(pa.array(texts)) for a, b in zip(at[:-1], at[1:])]
    assert got == whole([" " + t for t in texts] if keeps_space else texts, public_tokenizers.path(name), plain)


def expected(rows):
    out, start = {}, 0
    for (key, _), ids in zip(rows, whole([t or "" for _, t in rows])):
        ids = [*ids, 1]
        out[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_query_equals_plain_encoding(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    got = queries.QUERIES["op11_token_ids"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len(rows)


def archive(spark, rows, schema="doc_id long, text string", **options):
    folder = new_folder(spark, "test-archive")
    tokenids.write_ids(spark.createDataFrame(rows, schema), folder, PATH, 1, **options)
    return folder


def test_single_documents_and_dictionary(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 200)))) for k in range(3000)]
    folder = archive(spark, rows)
    sha256, made = spark.read.parquet(f"{folder}/dictionary").first()
    blocks = spark.read.parquet(f"{folder}/blocks").collect()
    assert made and {b["dictionary_sha256"] for b in blocks} == {sha256}
    assert all(len(b["offsets"]) == len(b["keys"]) + 1 and b["offsets"][-1] == len(b["data"]) for b in blocks)
    # the shared dictionary is worth it for short documents
    plain = sum(len(tokenids.zstandard.compress(np.array(x, "<u2").tobytes(), 6)) for x in whole([t for _, t in rows]))
    assert sum(len(b["data"]) for b in blocks) < 0.9 * plain
    want = expected(rows)
    got = tokenids.read_ids(spark, folder, keys=[7, 1234, 99999]).collect()
    assert {r["key"]: (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got} == {k: want[k] for k in (7, 1234)}


def test_blocks_close_and_stay_in_order(spark, monkeypatch):
    rows = [(k, f"word{k} " * (k % 5)) for k in range(300)]
    monkeypatch.setattr(tokenids, "BLOCK_DOCS", 7)
    folder = archive(spark, rows)
    blocks = sorted(spark.read.parquet(f"{folder}/blocks").collect(), key=lambda b: (b["part"], b["block"]))
    assert [k for b in blocks for k in b["keys"]] == list(range(300))
    got = tokenids.read_ids(spark, folder).collect()
    assert {r["key"]: (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got} == expected(rows)


def test_nulls_repeats_and_names(spark):
    rows = [(None, "b", 1), (2, None, 2), (2, None, 2), (1, "", 3), (None, None, 4), (3, "x y", 5)] + [(5, "same text", 6)] * 500
    folder = archive(spark, rows, "doc_id long, text string, ids int")
    got = sorted(tokenids.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows) and [r["key"] for r in got][-2:] == [None, None]
    assert [r["key"] for r in got[:4]] == [1, 2, 2, 3]
    ends = np.cumsum([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1]]


def test_empty_table(spark):
    folder = archive(spark, [])
    assert tokenids.read_ids(spark, folder).collect() == []


def test_another_dictionary_is_refused(spark):
    folder = archive(spark, [(k, f"some text {k}") for k in range(50)])
    other = spark.createDataFrame([("0" * 64, bytearray())], "sha256 string, dictionary binary")
    other.write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        tokenids.read_ids(spark, folder).collect()
