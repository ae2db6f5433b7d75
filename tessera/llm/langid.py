"""Language identification by segmentation-marginalised unigrams.

A language is a distribution over the pieces of a fixed public vocabulary.  A
word's probability is the sum over all ways to cut it into pieces of the
product of the pieces' probabilities: a forward pass over its characters.  A
text's is the product over its words; the prediction is the language with the
greatest posterior, the prior being the languages' shares of the training
documents.

Training is one expectation step: under equal piece probabilities, forward
and backward sums give each piece's expected number in a word, summed by
language over all training words; counts are kept in 1/1024 so that sums are
exact.  A task lays up words and cuts equal ones once.  Probabilities are smoothed by the distribution over all languages, and
that one by a uniform one.

Words are lower-cased; a character that is no piece costs the same in all
languages.  Words of more than LONGEST characters, and words with a sum below
SAFE, keep the logarithms of their sums, so that no word of any length comes to
0.  Equal words are scored once per worker.

Edge cases: null text and text without a letter give ``und`` and 0; a null
language is never learned; a row with a null doc_id is scored, not learned
from; without training rows every text is ``und``; repeated rows count as often
as they are there; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, hash_strings, lean, mix, slices, small_batches
from .subwords import remembered

LONGEST = 64
GAIN = 100.0  # per character, keeps most sums of words up to LONGEST above SAFE
SAFE = 1e-200
CELLS = 1_000_000  # characters of long words handled at once
BASE = np.uint64(0x9E3779B97F4A7C15)
UNIT = 1024
REMEMBERED = 2_000_000  # numbers that a worker keeps for known words
HELD = 300_000  # words (distinct in their chunk of text) that a training task lays up before it cuts them
AT_ONCE = 20_000  # words of one length that are cut at once


class Vocabulary:
    """Pieces of the vocabulary by a hash of their characters."""

    def __init__(self, path: str):
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())
                  if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i))]
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        h = np.array([self.hash_of([ord(c) for c in p]) for p in pieces], np.uint64)
        order = np.argsort(h)
        self.keys, self.ids = h[order], order
        self.first_bits = np.zeros(1 << 20, bool)  # what most parts of words do not have
        self.first_bits[h >> np.uint64(44)] = True

    @staticmethod
    def hash_of(chars) -> np.uint64:
        h = 0
        for c in chars:
            h = (h * 0x9E3779B97F4A7C15 + c + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(h)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        out = np.full(h.shape, -1)
        maybe = self.first_bits[h >> np.uint64(44)]
        own = h[maybe]
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == own, self.ids[at], -1)
        return out

    def edges(self, chars: np.ndarray):
        """Of words of one length (rows of code points): for each end the
        (start, piece numbers) of the pieces that end there.  A single
        character always has an edge (-1: unknown)."""
        n = chars.shape[1]
        ends: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            h = np.zeros(len(chars), np.uint64)
            for j in range(i, min(n, i + self.longest)):
                h = h * BASE + chars[:, j] + np.uint64(1)
                piece = self.find(h)
                if j == i or (piece >= 0).any():
                    ends[j + 1].append((i, piece))
        return ends


def lengths_of(words: list[str]):
    """(indices, code points) of the words of each length, a word start first."""
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by.setdefault(len(w), []).append(k)
    for n, ks in by.items():
        chars = np.frombuffer("".join(words[k] for k in ks).encode("utf-32-le"), "<u4").reshape(len(ks), n)
        start = np.full((len(ks), 1), 0x2581, np.uint32)
        yield np.array(ks), np.concatenate((start, chars), axis=1).astype(np.uint64)


def forward(ends, probs: np.ndarray, unknown: float, m: int) -> np.ndarray:
    """Sums over all segmentations up to each place (places x words x columns)."""
    alpha = np.zeros((len(ends), m, probs.shape[1]))
    alpha[0] = 1.0
    for j in range(1, len(ends)):
        for i, piece in ends[j]:
            p = np.where(piece[:, None] >= 0, probs[piece], unknown if j - i == 1 else 0.0)
            alpha[j] += alpha[i] * (p * GAIN ** (j - i))
    return alpha


class Padded:
    """Words of similar lengths, padded to one, with sums kept as logarithms.
    ``logs``: of the pieces' probabilities, then of an unknown character's and
    of what is no piece."""

    def __init__(self, vocab: Vocabulary, words: list[str], logs: np.ndarray):
        self.vocab, self.logs, self.size = vocab, logs, np.array([len(w) + 1 for w in words])
        n = int(self.size.max())
        rows = [np.frombuffer(("\u2581" + w).encode("utf-32-le"), "<u4") for w in words]
        # hashes of the first characters; the one of any part is a difference
        self.first = np.zeros((n + 1, len(words)), np.uint64)
        chars = np.full((n, len(words)), 0xFFFFFFFF, np.uint64)
        for k, row in enumerate(rows):
            chars[:len(row), k] = row
        for j in range(n):
            self.first[j + 1] = self.first[j] * BASE + chars[j] + np.uint64(1)
        self.power = np.ones((vocab.longest + 1, 1), np.uint64)
        for k in range(vocab.longest):
            self.power[k + 1] = self.power[k] * BASE

    def pieces(self, h: np.ndarray, single: int) -> np.ndarray:
        """Rows of ``logs`` of parts; those at ``single`` are one character."""
        piece = self.vocab.find(h)
        unknown = len(self.logs) - 2
        own = piece[single]
        piece = np.where(piece >= 0, piece, unknown + 1)
        piece[single] = np.where(own >= 0, own, unknown)
        return piece

    @staticmethod
    def added(x: np.ndarray) -> np.ndarray:
        """Log of the sum of what has these logarithms, over the first axis."""
        top = np.maximum(x.max(axis=0), -1e300)
        with np.errstate(divide="ignore"):
            return top + np.log(np.exp(x - top).sum(axis=0))

    def forward(self) -> Iterator[np.ndarray]:
        """Sums over all segmentations up to each place (words x columns)."""
        last = deque([np.zeros((len(self.size), self.logs.shape[1]))], maxlen=self.vocab.longest)
        yield last[0]
        for j in range(1, len(self.first)):
            k = len(last)
            piece = self.pieces(self.first[j] - self.first[j - k:j] * self.power[k:0:-1], -1)
            last.append(self.added(np.stack(last) + self.logs[piece]))
            yield last[-1]

    def totals(self) -> np.ndarray:
        out = np.zeros((len(self.size), self.logs.shape[1]))
        for j, x in enumerate(self.forward()):
            out[self.size == j] = x[self.size == j]
        return out

    def expected(self):
        """(word, piece, expected number of it), from one column of ``logs``."""
        m, n = len(self.size), len(self.first) - 1
        alpha = np.stack([x[:, 0] for x in self.forward()])
        total = alpha[self.size, np.arange(m)]
        after = deque([np.where(self.size == n, 0.0, -np.inf)], maxlen=self.vocab.longest)
        found, held = [], 0
        for i in range(n - 1, -1, -1):
            k = len(after)
            piece = self.pieces(self.first[i + 1:i + 1 + k] - self.first[i] * self.power[1:k + 1], 0)
            x = np.stack(after) + self.logs[piece, 0]
            share = np.exp(alpha[i] + x - total)
            at, word = np.nonzero((piece < len(self.logs) - 2) & (share > 0))
            found.append((word, piece[at, word], share[at, word]))
            held += len(at)
            if held > CELLS or not i:
                yield tuple(np.concatenate(c) for c in zip(*found))
                found, held = [], 0
            after.appendleft(np.where(self.size == i, 0.0, np.where(self.size < i, -np.inf, self.added(x))))


def padded(vocab: Vocabulary, words: list[str], at: list[int], logs: np.ndarray):
    """(indices, Padded) of the words at these indices, those of similar lengths together."""
    at = sorted(at, key=lambda k: len(words[k]))
    while at:
        most = min(len(at), 4000)
        n = next((i for i in range(1, most) if 2 * len(words[at[i]]) > 3 * len(words[at[0]]) + 2 or (i + 1) * len(words[at[i]]) > CELLS), most)
        own, at = at[:n], at[n:]
        yield np.array(own), Padded(vocab, [words[k] for k in own], logs)


def logs_of(probs: np.ndarray, unknown: float) -> np.ndarray:
    columns = probs.shape[1]
    with np.errstate(divide="ignore"):
        return np.log(np.concatenate((probs, np.full((1, columns), unknown), np.zeros((1, columns)))))


def expected_pieces(vocab: Vocabulary, words: list[str]):
    """(word, piece, expected number of it) under equal probabilities."""
    flat = np.full((len(vocab.pieces), 1), 1.0 / len(vocab.pieces))
    unknown = 1e-3 / len(vocab.pieces)
    again = [k for k, w in enumerate(words) if len(w) > LONGEST]
    short = np.array([k for k, w in enumerate(words) if len(w) <= LONGEST], np.int64)
    # a limit in characters too: what is found in a part is held at once
    parts = ((ks[a:a + step], chars[a:a + step]) for ks, chars in lengths_of([words[k] for k in short.tolist()])
             for step in [min(AT_ONCE, CELLS // (2 * chars.shape[1]))] for a in range(0, len(ks), step))
    for ks, chars in parts:
        owner, ends = short[ks], vocab.edges(chars)
        alpha = forward(ends, flat, unknown, len(ks))[:, :, 0]
        beta, found = np.zeros_like(alpha), []
        beta[-1] = 1.0
        for j in range(len(ends) - 1, 0, -1):
            for i, piece in ends[j]:
                p = np.where(piece >= 0, flat[0, 0], unknown if j - i == 1 else 0.0) * GAIN ** (j - i)
                mass = p * beta[j]
                hit = np.flatnonzero(piece >= 0)
                found.append((hit, piece[hit], (alpha[i] * mass)[hit]))
                beta[i] += mass
        low = (np.minimum(alpha, beta) < SAFE).any(axis=0)
        again += owner[low].tolist()
        hit, piece, x = (np.concatenate(c) for c in zip(*found))
        own = ~low[hit]
        yield owner[hit[own]], piece[own], x[own] / alpha[-1, hit[own]]
    for own, rows in padded(vocab, words, again, logs_of(flat, unknown)):
        for word, piece, x in rows.expected():
            yield own[word], piece, x


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, total, names, held = remembered(Vocabulary, path), {}, [], []

        def add() -> None:
            """The pieces of the words held so far, equal words together."""
            words = pa.chunked_array([w for w, *_ in held]).combine_chunks().dictionary_encode()
            at, start = np.asarray(words.indices), 0
            count = np.zeros((len(words.dictionary), len(names)))
            for own, lang, code, n in held:
                np.add.at(count, (at[start:start + len(own)][code], lang), n)
                start += len(own)
            held.clear()
            for own, piece, x in expected_pieces(vocab, words.dictionary.to_pylist()):
                for l, name in enumerate(names):
                    if name not in total:
                        total[name] = np.zeros(len(vocab.pieces))
                    total[name] += np.bincount(piece, x * count[own, l], len(vocab.pieces))
        for batch in batches:
            langs, texts = batch.column(0).dictionary_encode(), batch.column(1)
            own = langs.dictionary.to_pylist()
            names += [x for x in own if x not in names]
            lang_of = np.array([names.index(x) for x in own], np.int64)[np.asarray(langs.indices)]
            for s, e in slices(texts):
                w = Words(pc.utf8_lower(pc.fill_null(texts.slice(s, e - s), "")))
                if not len(w.codes):
                    continue
                size = len(w.vocab)
                key, n = np.unique(lang_of[s:e][w.doc] * size + w.codes, return_counts=True)
                held.append((w.vocab, *np.divmod(key, size), n))
                if sum(len(x) for x, *_ in held) > HELD:
                    add()
        if held:
            add()
        for name, x in total.items():
            n = np.round(x * UNIT).astype(np.int64)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             names=["lang", "piece", "n"])
    return run


class Scorer:
    """Log probabilities of words in each language, remembered per worker."""

    def __init__(self, path: str, probs: np.ndarray):
        self.vocab, self.probs = remembered(Vocabulary, path), probs
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, probs.shape[1]), np.float32)

    def fresh(self, words: list[str]) -> np.ndarray:
        unknown, out = 1e-3 / len(self.probs), np.zeros((len(words), self.probs.shape[1]))
        again = [k for k, w in enumerate(words) if len(w) > LONGEST]
        short = np.array([k for k, w in enumerate(words) if len(w) <= LONGEST], np.int64)
        for ks, chars in lengths_of([words[k] for k in short.tolist()]):
            owner, n = short[ks], chars.shape[1]
            for a in range(0, len(ks), AT_ONCE):
                own = owner[a:a + AT_ONCE]
                alpha = forward(self.vocab.edges(chars[a:a + AT_ONCE]), self.probs, unknown, len(own))
                low = (alpha < SAFE).any(axis=(0, 2))
                again += own[low].tolist()
                out[own[~low]] = np.log(alpha[-1][~low]) - n * np.log(GAIN)
        if again:
            for own, rows in padded(self.vocab, words, again, logs_of(self.probs, unknown)):
                out[own] = rows.totals()
        return out

    def __call__(self, vocab: pa.Array) -> np.ndarray:
        keys = hash_strings(vocab)
        if self.rows.size > REMEMBERED:
            self.keys, self.rows = self.keys[:0], self.rows[:0]
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        if len(new):
            rows, order = self.fresh(vocab.take(new).to_pylist()), np.argsort(keys[new])
            # only differences between languages count, and those of a long word need the digits
            rows = (rows - rows.max(axis=1, keepdims=True)).astype(np.float32)
            at = np.searchsorted(self.keys, keys[new][order])
            self.keys = np.insert(self.keys, at, keys[new][order])
            self.rows = np.insert(self.rows, at, rows[order], axis=0)
        return self.rows[np.searchsorted(self.keys, keys)]


_SCORERS: dict = {}


def _predict(path: str, model, model_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, probs, prior = model.value
        if _SCORERS.get("id") != model_id:  # one model per worker process
            _SCORERS.update(id=model_id, scorer=Scorer(path, probs) if names else None)
        scorer = _SCORERS["scorer"]
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            letters = np.asarray(pc.match_substring_regex(texts, r"\pL"))
            pred, score = [], []
            for s, e in slices(texts):
                if not names:
                    pred += ["und"] * (e - s)
                    score += [0.0] * (e - s)
                    continue
                w = Words(pc.utf8_lower(texts.slice(s, e - s)))
                total = np.tile(prior, (e - s, 1))
                if len(w.codes):
                    rows, has = scorer(w.vocab), np.flatnonzero(w.counts)
                    total[has] += np.add.reduceat(rows[w.codes].astype(np.float64), w.bounds[has], axis=0)
                best = total.argmax(axis=1)
                p = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                pred += [names[b] if ok else "und" for b, ok in zip(best, letters[s:e])]
                score += np.where(letters[s:e], p, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                                              pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def learned(counts: dict[str, dict[int, int]], documents: dict[str, int], pieces: int,
            smooth: float = 1000.0) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, piece probabilities (pieces x languages) and log prior."""
    names = sorted(counts)
    n = np.zeros((pieces, len(names)))
    for l, name in enumerate(names):
        for piece, c in counts[name].items():
            n[piece, l] = c / UNIT
    every = n.sum(axis=1) + 0.5
    every /= every.sum()
    probs = (n + smooth * every[:, None]) / (n.sum(axis=0) + smooth)
    docs = np.array([documents[x] for x in names], float)
    return names, probs, np.log(docs / docs.sum()) if names else docs


def predict_language(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.  Learns from rows
    with a language whose crc32 of doc_id leaves no 1 when divided by 3."""
    import uuid
    spark = docs.sparkSession
    small_batches(spark)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    train = docs.where("text is not null and lang is not null").where(part != 1).select("lang", "text")
    # bounded by languages x pieces of the vocabulary
    rows = train.mapInArrow(lean(_counts(path)), "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
    documents = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    counts: dict[str, dict[int, int]] = {}
    for r in rows:
        counts.setdefault(r["lang"], {})[r["piece"]] = r["n"]
    model = spark.sparkContext.broadcast(learned(counts, documents, len(Vocabulary(path).pieces)))
    d = docs.select("doc_id", "text", F.coalesce(part == 1, F.lit(False)).alias("held_out"))
    return d.mapInArrow(lean(_predict(path, model, uuid.uuid4().hex)), "doc_id long, held_out boolean, lang_pred string, score double")
