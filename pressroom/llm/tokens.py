"""Whole texts to token ids with a public tokenizer, inside tasks.

The tokenizer drops white space and splits at it, so a text's ids are those of its words in turn. Words are hashed for a whole
batch at once, each distinct word goes to the library once per worker (until the memory of words is full), and ids are gathered.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pressroom.llm.words import MEMORIES, span_hashes, split_words, trim

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers, and their ids on average; beyond it the memory starts anew.
REMEMBERED, IDS_A_WORD = 600_000, 8
#: Words that go to the library at once: each comes back as an object of about a kilobyte.
ASKED = 1_000
_PLAIN = re.compile(rb"[a-z]+")
_STOP = np.isin(np.arange(256), [0x2C, 0x2E])
_ALNUM = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class WordEncoder:
    """Ids of the tokenizer file ``path``: BPE on lower-cased words, no white space in any token.

    Known words are rows of arrays, about 30 bytes each: as objects of their own in a dictionary they take several times that.
    """

    path: str
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # of the known words, ascending
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # where the ids of each begin in ``flat``
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    flat: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    tokenizer: object = None

    def forget(self) -> None:
        self.hashes, self.first, self.sizes, self.flat = self.hashes[:0].copy(), self.first[:0].copy(), self.sizes[:0].copy(), self.flat[:0].copy()

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are of no known word."""
        if not len(self.hashes):
            return np.arange(len(hashes))
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[place] != hashes)

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words by their hashes, which ascend and are not known yet."""
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            trim()  # what reading the file took
        got: list[list[int]] = [[] for _ in words]
        others = []
        for i, word in enumerate(words):
            if _PLAIN.fullmatch(word):  # normalising and splitting leave such a word as it is
                got[i] = [t.id for t in self.tokenizer.model.tokenize(word.decode())]
            else:
                others.append(i)
        for a in range(0, len(others), ASKED):
            some = others[a : a + ASKED]
            for i, found in zip(some, self.tokenizer.encode_batch([words[i].decode() for i in some], add_special_tokens=False), strict=True):
                got[i] = found.ids
        sizes = np.fromiter(map(len, got), np.int32, len(got))
        flat = np.fromiter((x for ids in got for x in ids), np.uint32, int(sizes.sum()))
        place = np.searchsorted(self.hashes, hashes)
        self.first = np.insert(self.first, place, len(self.flat) + np.cumsum(sizes) - sizes)
        self.hashes, self.sizes = np.insert(self.hashes, place, hashes), np.insert(self.sizes, place, sizes)
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text; a null text has none."""
        fold = b"<|" not in split_source(column)  # special tokens are spelled in small letters only
        words = split_words(column, fold)
        start, end, of_text = words.start, words.end, words.bounds
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(of_text), np.int64)
        body = end.copy()
        for _ in range(3):  # full stops and commas after a letter or digit are pieces of their own
            body -= _STOP[words.data[body - 1]] & (body - 1 > start)
        tailed = (body < end) & _ALNUM[words.data[body - 1]]
        place = np.arange(len(start)) + np.concatenate([[0], np.cumsum(tailed)[:-1]])
        s, e = np.empty((2, len(start) + int(tailed.sum())), np.int64)
        s[place], e[place] = start, np.where(tailed, body, end)
        s[place[tailed] + 1], e[place[tailed] + 1] = body[tailed], end[tailed]
        distinct, at, inverse = np.unique(span_hashes(words.data, s, e, fold), return_index=True, return_inverse=True)
        new = self.missing(distinct)
        if len(self.hashes) + len(new) > REMEMBERED or len(self.flat) > IDS_A_WORD * REMEMBERED:
            self.forget()
            new = np.arange(len(distinct))
        if len(new):
            spelled = [words.data[s[at[i]] : e[at[i]]].tobytes() for i in new]
            self.learn(distinct[new], [w.lower() if fold else w for w in spelled])
        known = np.searchsorted(self.hashes, distinct)
        lengths = self.sizes[known][inverse]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.first[known][inverse] - ends[:-1], lengths) + np.arange(ends[-1])]
        spans_of_text = np.append(place, len(s))[of_text]
        return ids, ends[spans_of_text]


def split_source(column: pa.Array | pa.ChunkedArray) -> bytes:
    from pressroom.llm.words import text_bytes

    return text_bytes(column)[0].tobytes()


_ENCODERS: dict[str, WordEncoder] = {}
MEMORIES.append(_ENCODERS)


def encoder(path: str) -> WordEncoder:
    """This worker's encoder; it keeps what it has learned from task to task, until another operator ends one."""
    return _ENCODERS.setdefault(path, WordEncoder(path))
