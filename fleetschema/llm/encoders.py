"""Token ids by public tokenizers inside tasks, word by word.

Texts repeat their words, so a worker encodes each distinct one once with the
tokenizer's own library and keeps its ids. Texts are cut in front of spaces, and
only where the tokenizer parts them there whatever stands around, so the ids are
those of the whole text. This holds for tokenizers whose normaliser treats a
character by itself or with the marks behind it, and whose pattern either drops
white space or takes one space with the word behind it and any longer run of
white space but for its last character by itself; texts of the latter kind with
such a run are encoded whole.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: words that a worker keeps before it goes on with those of its last texts, and bytes of texts that it encodes at a time
CACHE_WORDS, TEXT_BYTES = 500_000, 16_000_000
#: bytes of words and ids that it keeps, words encoded at a time
CACHE_BYTES, WORDS = 48_000_000, 2_048

#: a word of Latin letters that a normaliser leaves as they are but for case, and marks behind it (none that a pattern or a special token begins with)
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *(c for c in range(192, 256) if c not in (215, 247))]))
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: fixed values: the patterns under which such letters are one unit and such marks another
_LOWERED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: a space behind any white space
_RUN = r"[\s\x0b\x1c-\x1f\x{85}\pZ] "


class WordEncoder:
    def __init__(self, path: str, keeps_space: bool, plain_specials: bool, cache_words: int, text_bytes: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_specials
        self.keeps_space, self.cache_words, self.text_bytes = keeps_space, cache_words, text_bytes
        self.width = id_width(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.kind = np.dtype(f"<u{self.width}")
        self.kept = {kind: _nothing() for kind in ("words", "units", "marks")}
        self.simple = self._parts_simple_words()

    def _parts_simple_words(self) -> bool:
        """Whether the tokenizer parts a simple word into its letters and its marks, as the pattern of either kind does."""
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        if self.keeps_space:
            return made["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"]
        steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", ())]
        split = [x["pattern"]["Regex"] for x in before.get("pretokenizers", ()) if x["type"] == "Split"]
        return steps == ["NFC", "Replace", "Lowercase"] and split == [_LOWERED]

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time, in order: the ids of all of them, and where each text's begin (and the last end).

        A tokenizer that keeps spaces reads each text with one space before it.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + self.text_bytes, "right")) - 1)
            yield self._some(texts.slice(at, end - at))
            at = end
        pa.default_memory_pool().release_unused()

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole: dict[int, bytes] = {}
        if self.keeps_space:
            spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
            runs = pc.match_substring_regex(spaced, _RUN)
            for i in np.flatnonzero(runs.to_numpy(zero_copy_only=False)):
                whole[int(i)] = self._ids([texts[i].as_py()])[0]
            texts = pc.if_else(runs, pa.scalar("", pa.large_string()), texts)
        else:  # white space is dropped, whichever it is
            for space in "\n\t\r":
                texts = pc.replace_substring(texts, space, " ")
        parts = pc.split_pattern(texts, " ")
        words = parts.flatten().dictionary_encode()
        ids, places = self._known(words.dictionary)
        # the ids of all words one after the other are the data of this array
        spelled = ids.take(places.take(words.indices))
        _, ends, data = spelled.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(spelled) + 1]
        out = np.frombuffer(data, self.kind, ends[-1] // self.width) if data else np.zeros(0, self.kind)
        bounds = ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()] // self.width
        if not whole:
            return out, bounds
        pieces = [np.frombuffer(whole[i], self.kind) if i in whole else out[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def _ids(self, words: list[str]) -> list[bytes]:
        words = [f" {w}" for w in words] if self.keeps_space else words
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [self._packed(x.ids) for x in found]

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _known(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Ids of distinct words, and the place of each word's ids among them."""
        if not self.simple:
            return self._keep("words", words, self._word_ids), pa.array(np.arange(len(words)))
        letters, marks = pc.utf8_rtrim(words, _MARKS), pc.utf8_ltrim(words, _LETTERS)
        n = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (words, letters, marks)]
        simple = (n[1] > 0) & (n[1] + n[2] == n[0])  # letters and then marks are the whole word
        letters, marks = (x.filter(pa.array(simple)) for x in (letters, marks))
        if self.keeps_space:
            letters = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), letters, pa.scalar("", pa.large_string()))
        else:
            letters = pc.utf8_lower(letters)
        halves = []
        for kind, units in (("units", letters.dictionary_encode()), ("marks", marks.dictionary_encode())):
            halves.append(self._keep(kind, units.dictionary, self._unit_ids).take(units.indices))
        others = self._keep("words", words.filter(pa.array(~simple)), self._word_ids)
        places = np.empty(len(words), np.int64)
        places[np.flatnonzero(simple)] = np.arange(simple.sum())
        places[np.flatnonzero(~simple)] = np.arange(simple.sum(), len(words))
        joined = pc.binary_join_element_wise(*halves, pa.scalar(b"", pa.large_binary()))
        return pa.concat_arrays([joined, others]), pa.array(places)

    def _keep(self, kind: str, words: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of distinct words; those not met before are encoded and kept. Too many, and only these words stay."""
        known, ids = self.kept[kind]
        at = pc.index_in(words, value_set=known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        fresh = words.filter(pa.array(new))
        known = pa.concat_arrays([known, fresh])
        ids = pa.concat_arrays([ids, encode(fresh)])
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[new] = np.arange(len(known) - len(fresh), len(known))
        found = ids.take(pa.array(places))
        if len(known) > self.cache_words or known.nbytes + ids.nbytes > CACHE_BYTES:
            known, ids = (words, found) if len(words) <= self.cache_words and words.nbytes + found.nbytes <= CACHE_BYTES else _nothing()
        self.kept[kind] = known, ids
        return found

    def _word_ids(self, words: pa.Array) -> pa.Array:
        some = (words.slice(at, WORDS).to_pylist() for at in range(0, len(words), WORDS))
        return pa.array([x for w in some for x in self._ids(w)], pa.large_binary())

    def _unit_ids(self, units: pa.Array) -> pa.Array:
        """The ids of what the tokenizer does not part before it merges."""
        merge, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for unit in pc.replace_substring(units, " ", _SPELLED[32]).to_pylist() if self.keeps_space else units.to_pylist():
            if not unit.isascii():
                unit = unit.replace(_SPELLED[32], " ").encode().decode("latin-1").translate(_SPELLED)
            ids += [t.id for t in merge(unit)]
            ends.append(len(ids))
        ends = np.array(ends, np.int64) * self.width
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(units), [None, pa.py_buffer(ends), pa.py_buffer(np.array(ids, self.kind))])


def _nothing() -> tuple[pa.Array, pa.Array]:
    return pa.array([], pa.large_string()), pa.array([], pa.large_binary())


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(unseen)}


_SPELLED = byte_characters()


def id_width(ids: int) -> int:
    return 2 if ids <= 1 << 16 else 4


@lru_cache(maxsize=4)
def word_encoder(
    path: str, keeps_space: bool, plain_specials: bool, cache_words: int = CACHE_WORDS, text_bytes: int = TEXT_BYTES
) -> WordEncoder:
    """The worker's encoder of this file; it lives as long as the worker."""
    return WordEncoder(path, keeps_space, plain_specials, cache_words, text_bytes)
