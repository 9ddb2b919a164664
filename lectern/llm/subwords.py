"""Subword ids of public tokenizers, with a cache of words.

The tokenizer named word_bpe drops white space and lower-cases; no id spans ASCII white space, so a text's
ids are those of its words in turn. Words of a worker's earlier batches are not encoded again, and a slice of
texts looks each of its distinct words up once.
"""

from __future__ import annotations

import os
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lectern.llm.caches import keeps

CACHED_WORDS = 300_000
_MARKS = b".,#%&*$|;:!?"
_MARK_BYTES = frozenset(_MARKS[i : i + 1] for i in range(len(_MARKS)))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}

        # Ids that end a run of letters, if the vocabulary tells; then many such runs can be encoded at once.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.array([bool(suffix) and t.endswith(suffix) for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])])
        self.ends = self.ends if suffix else None

    def _encoded(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        texts = [w.decode("utf-8", "replace") for w in pieces]
        letters = [i for i, t in enumerate(texts) if t.isalpha()] if self.ends is not None else []
        out = {}
        lots = [letters[k : k + 512] for k in range(0, len(letters), 512)]
        for some, e in zip(lots, self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in x]) for x in lots], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            at = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(at) == len(some):  # else a run was not one word after all: its lot is encoded below
                raw = ids.tobytes()
                out.update(zip([pieces[i] for i in some], [raw[a:b] for a, b in zip([0, *at[:-1]], at, strict=True)], strict=True))
        rest = [i for i in range(len(pieces)) if pieces[i] not in out]
        found = self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        return out | {pieces[i]: np.array(e.ids, self.dtype).tobytes() for i, e in zip(rest, found, strict=True)}

    def _pieces(self, words: list[bytes]) -> list[bytes]:
        """Per word, of which each is named once: its ids as little-endian integers of self.dtype."""
        known = self.known
        out = list(map(known.get, words))
        new = [i for i, x in enumerate(out) if x is None]
        if new:
            fresh, stems = {}, {}
            if self.ends is not None:  # marks behind a letter or digit are tokens of their own, so that word and marks are looked up apart
                stems = {i: stem for i in new if (w := words[i])[-1:] in _MARK_BYTES and (stem := w.rstrip(_MARKS))[-1:].isalnum()}
            parts = {words[i] for i in new if i not in stems}
            for i, stem in stems.items():
                parts.add(stem)
                parts.add(words[i][len(stem) :])
            fresh = self._encoded(list(parts.difference(known)))
            of = lambda w: fresh.get(w) or known.get(w) or b""
            for i in new:
                stem = stems.get(i)
                out[i] = of(words[i]) if stem is None else of(stem) + of(words[i][len(stem) :])
            if len(known) < CACHED_WORDS:  # the words that come first are the frequent ones: they stay
                known.update(fresh)
                known.update((words[i], out[i]) for i in stems)
        return out

    def lowered(self, texts: pa.Array) -> pa.Array:
        """Texts with A-Z in lower case if the vocabulary is of lower-cased text, but for texts with names of special tokens."""
        texts = texts.fill_null("")
        if self.ends is None:
            return texts
        return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))

    def slice(self, texts: pa.Array) -> Slice:
        """Ids of whole texts (strings without nulls), and their distinct words."""
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary()).to_pylist()
        pieces = self._pieces(words)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        first, n = np.cumsum(size) - size, size[codes]
        upto = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(first[codes] - upto[:-1], n) + np.arange(upto[-1])
        return Slice(np.frombuffer(b"".join(pieces), self.dtype)[at], upto[offsets], words, codes, offsets)


class Slice(NamedTuple):
    """Of some texts: all their ids, where each text's begin and end among them, distinct words (b'' among them for white space at an end), the words' codes, and where each text's begin."""

    ids: np.ndarray
    ends: np.ndarray
    words: list[bytes]
    codes: np.ndarray
    word_ends: np.ndarray

    def texts(self) -> list[np.ndarray]:
        """Each text's ids."""
        return [self.ids[a:b] for a, b in zip(self.ends[:-1].tolist(), self.ends[1:].tolist(), strict=True)]

    def word_counts(self) -> np.ndarray:
        """How many words each text has."""
        filled = np.array([bool(w) for w in self.words], bool)[self.codes] if self.words else np.empty(0, bool)
        upto = np.concatenate([[0], np.cumsum(filled)])
        return np.diff(upto[self.word_ends])


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """The worker's own encoder for the file at path."""
    return WordEncoder(path)


keeps("words", word_encoder.cache_clear)
