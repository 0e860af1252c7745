"""Words parted into letters and marks before the tokenizer sees them, and what a worker keeps of them."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetschema.llm.encoders import WordEncoder

WORDS = [("word_bpe_49k.json", False, False), ("byte_bpe_50k.json", True, True)]


def encoder(name, keeps_space, plain, cache_words=500_000):
    return WordEncoder(public_tokenizers.path(name), keeps_space, plain, cache_words, 1_000_000)


def ids(made, texts):
    return [some[a:b].tolist() for some, at in made.encode(pa.array(texts)) for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("name, keeps_space, plain", WORDS)
def test_letters_and_marks_of_any_kind(name, keeps_space, plain):
    rng = random.Random(5)
    parts = ["a", "Zq", "é", "ß", "İ", "ñ́", "'s", "'", "'LL", "<", "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "endoftext", "́"]
    parts += [*"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~", "***", "...", "×", "÷", "ª", "7", "\n", "\t", "\r", "\r\n", " ", " ", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(4_000)]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = plain
    want = whole.encode_batch([" " + t for t in texts] if keeps_space else texts, add_special_tokens=False)
    assert ids(encoder(name, keeps_space, plain, 50), texts) == [x.ids for x in want]


def test_lines_and_marks_need_no_call_of_their_own():
    made, seen = encoder(*WORDS[0]), []
    encode = made._ids
    made._ids = lambda words: seen.extend(words) or encode(words)
    ids(made, ["One.\nTwo,\tthree\r\nFOUR*** one&&& Eight.\n\nNine%%%", "it's 12", "It's"])
    assert sorted(seen) == ["", "12", "It's", "it's"]


def test_a_full_worker_keeps_the_words_of_its_last_texts():
    made, seen = encoder(*WORDS[0], cache_words=8), []
    encode = made._unit_ids
    made._unit_ids = lambda units: seen.extend(units.to_pylist()) or encode(units)
    texts = ["common aa bb cc dd", "common ee ff gg hh", "common ee ii"]
    assert [ids(made, [t])[0] for t in texts] == ids(encoder(*WORDS[0]), texts)
    assert seen.count("common") == 1 and seen.count("ee") == 1
