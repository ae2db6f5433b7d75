"""Subword ids of whole texts, each distinct word encoded once per worker.

The tokenizers used here never join characters across ASCII white space, so a
text's ids are its words' ids in order.  A worker keeps the ids of the words
it has met under their 64-bit hashes, in flat arrays.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from .common import Words

#: Words that a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 1_000_000


class WordIds:
    """Ids of words by ``encode`` (list of words to list of id lists)."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], dtype=np.uint16):
        self.encode, self.dtype = encode, dtype
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, self.dtype), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used:self.used + total] = np.fromiter((i for x in ids for i in x), self.dtype, total)
        start = self.used + np.cumsum(sizes) - sizes
        self.used += total
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.at = np.insert(self.at, at, start[order])
        self.size = np.insert(self.size, at, sizes[order])

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each word has."""
        if not len(words.codes):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        keys = words.vocab_hashes()
        if len(self.keys) > REMEMBERED:
            self.clear()
        at, known = self.find(keys)
        if not known.all():
            new = np.flatnonzero(~known)
            self.add(keys[new], self.encode(words.vocab.take(new).to_pylist()))
            at, _ = self.find(keys)
        size, start = self.size[at].astype(np.int64)[words.codes], self.at[at][words.codes]
        ends = np.cumsum(size)
        return self.flat[np.repeat(start - (ends - size), size) + np.arange(ends[-1])], size


#: letters whose lower case and composed form are themselves single letters
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def word_bpe(path: str) -> WordIds:
    """Ids of the lower-casing word vocabulary.  It splits letters from marks,
    so a plain word's ids are those of its lower-cased letters, then its marks;
    all other words go to the tokenizer as they are."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)

    def direct(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast(words, add_special_tokens=False)]
    import pyarrow as pa
    parts = WordIds(direct)

    def encode(words: list[str]) -> list[list[int]]:
        split = []
        for w in words:
            m = PLAIN.fullmatch(w)
            split.append([x for x in (m[1].lower(), m[2]) if x] if m else [w])
        text = pa.array([" ".join(x) for x in split])
        flat, size = parts(Words(text))
        bounds = np.concatenate(([0], np.cumsum(np.add.reduceat(size, np.cumsum([0, *map(len, split)])[:-1])))).tolist()
        flat = flat.tolist()
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return WordIds(encode)


def sentence_pieces(path: str) -> WordIds:
    """Ids of words by a sentencepiece model, each as a word of its own."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return WordIds(lambda words: model.encode(words, num_threads=1))


_KEPT: dict = {}


def remembered(make: Callable[[str], WordIds], path: str) -> WordIds:
    """One per worker process and file: later tasks reuse what it remembers."""
    key = (make.__name__, path)
    if key not in _KEPT:
        _KEPT[key] = make(path)
    return _KEPT[key]
