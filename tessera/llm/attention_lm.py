"""Scoring texts with a causal self-attention model in numpy.

Units are subword ids of a fixed public vocabulary and an end.  The model:

    e_t = E[x_t] + position;  q, k, v = e Wq, e Wk, e Wv
    z_t = e_t Wr + (sum over s <= t of softmax(q_t k_s) v_s) Wo + b
    P(next) = P(group | z_t) P(unit | group, z_t)

The HEADS most frequent units stand in groups of SIZE, neighbours in
spelling; all others share one group, in which a unit has its smoothed
frequency.  So a step costs two small softmaxes, not one over the vocabulary,
and probabilities of all units add up to 1.  The softmaxes inside groups are
computed for all states at once, which stand in order of their groups.

Gathering: one pass over the training texts counts words, units and pairs of
neighbouring units; windows are made from the texts again in each round, so
that no copy of them is kept.  The pairs of HEADS units (a table bounded
by the vocabulary) give the weights to start from: a low-rank factorisation of
their association, which makes the untrained model a bigram model.  Training:
ROUNDS rounds; every window of the training texts falls in one of them, by a
hash of its doc_id and place.  The same hash deals a round's windows to shards
of about SHARD windows (MOST_SHARDS at most, which bounds the weights that are
averaged); a shard takes steps on its windows in order of the hash, and the
shards' weights are averaged by an aggregation.  So the model depends on the
rows alone, not on how the table is split into files or partitions.

Scoring: a text is cut into windows of WINDOW units that overlap by OVERLAP.
Windows of many texts are batched; each unit is scored once, in the first
window that has OVERLAP units before it (the first window scores all).

The base score needs the count of every word.  Words that make up a share of
FREQUENT or more of all tokens (1 / FREQUENT words at most) go along with the
tasks, all others are joined by their 64-bit hash.

Edge cases: null and blank text is one end token; a null doc_id is scored and
not learned from; without training rows all units are equally likely;
repeated rows count as often as they are there; an empty table gives an empty
result; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, lean, mix, slices, small_batches, to_long, written
from .subwords import remembered, sentence_pieces

WINDOW, OVERLAP = 32, 6
HEADS, SIZE = 1024, 32
WIDTH, KEY = 24, 8
ROUNDS = 2
SHARD, MOST_SHARDS = 50_000, 1024
BATCH = 128  # windows of a training step
CHUNK = 256  # windows that one step of scoring takes
FREQUENT = 1e-6
END = 2  # the vocabulary's end of text
RATE = 1e-2


class Units:
    """Which units are heads, their groups, and the other units' frequencies."""

    def __init__(self, counts: dict[int, int], pieces: list[str]):
        size = len(pieces)
        self.heads = sorted(sorted(counts, key=lambda i: (-counts[i], i))[:HEADS], key=lambda i: pieces[i])
        self.groups = -(-len(self.heads) // SIZE) + 1  # and the group of the rest
        # input numbers: heads, the rest, the start of a text
        self.number = np.full(size, len(self.heads), np.int64)
        self.number[self.heads] = np.arange(len(self.heads))
        rest = np.array([counts.get(i, 0) + 0.5 for i in range(size)])
        rest[self.heads] = 0
        self.log_rest = np.log(np.maximum(rest, 1e-300) / max(rest.sum(), 1e-300)).astype(np.float32)
        self.of = np.array([*(i // SIZE for i in range(len(self.heads))), self.groups - 1], np.int64)  # group by number


def initial(units: Units, pairs: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights that make a bigram model: ``pairs`` counts (number, next number)."""
    h, r = len(units.heads), np.random.default_rng(seed)
    n = pairs + 1e-9
    prior = (n.sum(axis=0) + 0.5) / (n.sum() + 0.5 * (h + 1))
    p = (pairs + 5 * prior) / (pairs.sum(axis=1, keepdims=True) + 5)
    onto = np.zeros((h + 1, units.groups))
    onto[np.arange(h + 1), units.of] = 1
    pg, prior_g = p @ onto, prior @ onto
    inside = (p / pg[:, units.of])[:, :h]
    inside_prior = (prior / prior_g[units.of])[:h]
    target = np.concatenate((np.log(pg / prior_g), np.log(inside / inside_prior)), axis=1)
    rows = np.sqrt(pairs.sum(axis=1, keepdims=True) / max(pairs.sum(), 1) + 1e-6)
    cols = np.sqrt(np.concatenate((prior_g, prior[:h])))
    u, s, v = np.linalg.svd(rows * target * cols, full_matrices=False)
    k = min(WIDTH, len(s))
    w = {"E": np.zeros((h + 2, WIDTH)), "P": np.zeros((WINDOW, WIDTH)), "b": np.zeros(WIDTH)}
    w["E"][:, :k] = u[:, :k] * np.sqrt(s[:k]) / rows
    out = np.zeros((WIDTH, h + units.groups))
    out[:k] = np.sqrt(s[:k])[:, None] * v[:k] / cols
    w["Uc"], w["bc"] = out[:, :units.groups], np.log(prior_g)
    # group by group; places without a unit have no share
    inner, bias = np.zeros((WIDTH, (units.groups - 1) * SIZE)), np.full((units.groups - 1) * SIZE, -1e9)
    inner[:, :h], bias[:h] = out[:, units.groups:], np.log(inside_prior)
    w["Ug"], w["bg"] = inner.reshape(WIDTH, -1, SIZE).transpose(1, 0, 2), bias.reshape(-1, SIZE)
    # queries, keys, values and the state's own part in one product
    w["Wi"] = np.concatenate((r.normal(0, 0.3 / math.sqrt(WIDTH), (WIDTH, 2 * KEY + WIDTH)), np.eye(WIDTH)), axis=1)
    w["Wo"] = np.zeros((WIDTH, WIDTH))
    return {name: np.ascontiguousarray(x, np.float32) for name, x in sorted(w.items())}


CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
LIMIT = np.float32(60)  # of exponents: float32 ends at e ** 88


def exponentials(x: np.ndarray) -> np.ndarray:
    """e to each number (LIMIT at most), in place."""
    if x.size and x.max() > LIMIT:
        np.minimum(x, LIMIT, out=x)
    return np.exp(x, out=x)


def attend(w: dict, x: np.ndarray):
    """Hidden states of windows of input numbers (windows x WINDOW), with what
    the gradients need: weights before and sums after the mask."""
    # Wi by number and by place: a window's products are sums of these
    parts = np.take(w["E"] @ w["Wi"], x, axis=0)
    parts += w["P"] @ w["Wi"]
    q, k, v, own = np.split(parts, (KEY, 2 * KEY, 2 * KEY + WIDTH), axis=2)
    a = exponentials(q @ k.transpose(0, 2, 1))
    a *= CAUSAL
    total = a @ np.ones((WINDOW, 1), np.float32)
    c = a @ v
    c /= total
    z = (c.reshape(-1, WIDTH) @ w["Wo"]).reshape(c.shape)
    z += own
    z += w["b"]
    return z, (q, k, v, a, total, c)


def tables(w: dict) -> tuple[np.ndarray, np.ndarray]:
    """What each number and each place add to queries, keys, values (times Wo)
    and the state's own part: with fixed weights, sums in place of products."""
    out = []
    for name in ("E", "P"):
        m = w[name] @ w["Wi"]
        m[:, 2 * KEY:2 * KEY + WIDTH] = m[:, 2 * KEY:2 * KEY + WIDTH] @ w["Wo"]
        out.append(m)
    out[1][:, 2 * KEY + WIDTH:] += w["b"]
    return out[0], out[1]


def states(table: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The hidden states of ``attend``, by ``tables``."""
    parts = np.take(table[0], x, axis=0)
    parts += table[1]
    q, k, v, own = np.split(parts, (KEY, 2 * KEY, 2 * KEY + WIDTH), axis=2)
    a = exponentials(q @ k.transpose(0, 2, 1))
    a *= CAUSAL
    z = a @ v
    z /= a @ np.ones((WINDOW, 1), np.float32)
    z += own
    return z


def log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log softmax of each row of x at one place of it."""
    own = np.minimum(x[np.arange(len(x)), at], LIMIT)
    exponentials(x)
    return own - np.log(x @ np.ones(x.shape[1], x.dtype))


def shares(x: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place."""
    exponentials(x)
    x /= x @ np.ones((x.shape[1], 1), x.dtype)
    return x


def by_group(units: Units, g: np.ndarray):
    """Places in order of their groups (the rest's is the last), how many are
    of other groups, and these groups with their first and last place."""
    ends = np.cumsum(np.bincount(g, minlength=units.groups)).tolist()
    own = [(j, a, b) for j, (a, b) in enumerate(zip([0, *ends], ends[:-1])) if b > a]
    return np.argsort(g.astype(np.int16), kind="stable"), ([0] + ends)[-2], own


def inside_groups(w: dict, z: np.ndarray, own: list) -> np.ndarray:
    """Exponents inside the groups of states in order of their groups."""
    x = np.empty((len(z), SIZE), z.dtype)
    for j, a, b in own:
        part = np.matmul(z[a:b], w["Ug"][j], out=x[a:b])
        part += w["bg"][j]
    return x


def log_probs(w: dict, units: Units, z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """ln P of each next number (the rest's units as one) at its state."""
    g = units.of[y]
    order, n, own = by_group(units, g)
    z, y = np.take(z, order, axis=0), y[order]
    x = z @ w["Uc"]
    x += w["bc"]
    share = log_share(x, g[order])
    if n:
        share[:n] += log_share(inside_groups(w, z[:n], own), y[:n] % SIZE)
    lp = np.empty_like(share)
    lp[order] = share
    return lp


def gradients(w: dict, units: Units, x: np.ndarray, y: np.ndarray, ok: np.ndarray) -> dict:
    """Mean gradients of -ln P over the positions ``ok`` of windows."""
    z3, (q, k, v, a, total, c) = attend(w, x)
    a /= total
    flat = lambda m: m.reshape(-1, m.shape[-1])
    ones = np.ones(x.size, z3.dtype)
    sums = lambda m: ones[:len(m)] @ m  # of the columns
    own = np.flatnonzero(ok)
    t = y.ravel()[own]
    g = units.of[t]
    order, n, groups = by_group(units, g)
    own, t, g = own[order], t[order], g[order]
    z = np.take(flat(z3), own, axis=0)
    dw = {name: np.zeros_like(w[name]) for name in ("Ug", "bg")}
    d = z @ w["Uc"]
    d += w["bc"]
    shares(d)[np.arange(len(t)), g] -= 1
    dw["Uc"], dw["bc"] = z.T @ d, sums(d)
    dz = d @ w["Uc"].T
    if n:
        d = shares(inside_groups(w, z[:n], groups))
        d[np.arange(n), t[:n] % SIZE] -= 1
        for j, s, f in groups:
            dz[s:f] += d[s:f] @ w["Ug"][j].T
            dw["Ug"][j] = z[s:f].T @ d[s:f]
            dw["bg"][j] = sums(d[s:f])
    dz3 = np.zeros_like(z3)
    flat(dz3)[own] = dz
    dw["b"], dw["Wo"] = sums(dz), flat(c).T @ flat(dz3)
    dc = (flat(dz3) @ w["Wo"].T).reshape(z3.shape)
    ds = dc @ v.transpose(0, 2, 1)
    c *= dc
    ds -= c @ np.ones((WIDTH, 1), c.dtype)  # the mean of ds under a
    ds *= a
    # queries, keys, values and the state's own part, as in Wi
    d = np.empty((*x.shape, 2 * KEY + 2 * WIDTH), z3.dtype)
    np.matmul(ds, k, out=d[:, :, :KEY])
    np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, KEY:2 * KEY])
    np.matmul(a.transpose(0, 2, 1), dc, out=d[:, :, 2 * KEY:2 * KEY + WIDTH])
    d[:, :, 2 * KEY + WIDTH:] = dz3
    # by number and by place, then through Wi
    of_place = sums(d.reshape(len(x), -1)).reshape(WINDOW, -1)
    at = (x.ravel() * d.shape[2])[:, None] + np.arange(d.shape[2])
    of_number = np.bincount(at.ravel(), d.ravel(), len(w["E"]) * d.shape[2]).astype(d.dtype).reshape(len(w["E"]), -1)
    dw["E"], dw["P"] = of_number @ w["Wi"].T, of_place @ w["Wi"].T
    dw["Wi"] = w["E"].T @ of_number + w["P"].T @ of_place
    return {name: p / max(len(t), 1) for name, p in sorted(dw.items())}


class Steps:
    """Adam from given weights, all of them in one array; ``w`` has its parts."""

    def __init__(self, w: dict):
        self.flat = np.concatenate([w[k].ravel() for k in sorted(w)])
        self.w, at = {}, 0
        for k in sorted(w):
            self.w[k] = self.flat[at:at + w[k].size].reshape(w[k].shape)
            at += w[k].size
        self.m, self.v, self.t = np.zeros_like(self.flat), np.zeros_like(self.flat), 0

    def take(self, grads: dict) -> None:
        self.t += 1
        rate = RATE * math.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
        g = np.concatenate([grads[k].ravel() for k in sorted(grads)])
        more = g - self.m
        more *= np.float32(0.1)
        self.m += more
        g *= g
        g -= self.v
        g *= np.float32(0.01)
        self.v += g
        np.sqrt(self.v, out=g)
        g += np.float32(1e-6)
        np.multiply(self.m, np.float32(rate), out=more)
        more /= g
        self.flat -= more


def unit_rows(words: Words, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids, each text closed by END, and their bounds."""
    ends = np.concatenate(([0], np.cumsum(size)))[words.bounds]
    n = len(ends) - 1
    flat = np.full(len(ids) + n, END, np.int64)
    at = np.ones(len(flat), bool)
    at[ends[1:] + np.arange(n)] = False
    flat[at] = ids
    return flat, ends + np.arange(n + 1)


def windows(bounds: np.ndarray):
    """Start and text of every window, and whether it is its text's first."""
    n = np.diff(bounds)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // (WINDOW - OVERLAP)))
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return bounds[text] + k * (WINDOW - OVERLAP), text, k == 0


def window_rows(numbers: np.ndarray, bounds: np.ndarray, start: np.ndarray, text: np.ndarray, begin: int):
    """Inputs, next numbers and positions inside the text of windows."""
    at = start[:, None] + np.arange(WINDOW)
    inside = at < bounds[text + 1][:, None]
    at = np.minimum(at, len(numbers) - 1)
    y = np.where(inside, numbers[at], 0)
    before = numbers[np.maximum(at - 1, 0)]
    x = np.where(at == bounds[text][:, None], begin, before)
    return np.where(inside, x, 0), y, inside, at


ROWS = "kind byte, key long, n long, ids binary"  # what gathering gives
BEGIN = 1 << 20  # before the first unit, as an id
BEGIN_16, NONE_16 = 65535, 65534  # in dealt windows: the start, and places beyond the text


def unpacked(ids: list[bytes]) -> np.ndarray:
    """Windows as they are dealt (16-bit ids): WINDOW + 1 ids a row."""
    return np.frombuffer(b"".join(ids), np.uint16).reshape(-1, WINDOW + 1)


def _gather(path: str, lower: bool = False, counted: bool = True, turns: tuple = tuple(range(ROUNDS))):
    """From (text, hash of doc_id): counts of words (0, hash), units (1, id),
    pairs of units (2, both), texts (3) and windows (5) if ``counted``, and the windows of the rounds
    ``turns`` (4, round, a hash of doc_id and place in place of n): WINDOW + 1 ids."""
    def rows_of(kind: int, keys: np.ndarray, n: np.ndarray, ids: np.ndarray | None = None) -> pa.RecordBatch:
        offsets = np.arange(len(keys) + 1, dtype=np.int32) * (0 if ids is None else 2 * (WINDOW + 1))
        flat = b"" if ids is None else ids.tobytes()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(n),
                                           pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])],
                                          names=["kind", "key", "n", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = remembered(sentence_pieces, path)
        held: dict[int, list] = {0: [], 1: [], 2: [], 3: [], 5: []}

        def merged():
            """What the texts so far have: equal keys together."""
            for kind, parts in held.items():
                if parts:
                    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                    yield rows_of(kind, keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64))
                parts.clear()
        for batch in batches:
            texts, docs = batch.column(0), np.asarray(batch.column(1)).view(np.uint64)
            for s, e in slices(texts):
                w = Words(texts.slice(s, e - s), lower)
                flat, bounds = unit_rows(w, *ids_of(w))
                prev = np.concatenate(([0], flat[:-1]))
                prev[bounds[:-1]] = BEGIN
                start, text, _ = windows(bounds)
                if counted:
                    held[0].append((w.vocab_hashes().view(np.int64), np.bincount(w.codes, minlength=len(w.vocab))))
                    n = np.bincount(flat)
                    units = np.flatnonzero(n)
                    held[1].append((units, n[units]))
                    held[2].append(np.unique(prev << 21 | flat, return_counts=True))
                    held[3].append((np.zeros(1, np.int64), np.array([e - s])))
                    held[5].append((np.zeros(1, np.int64), np.array([len(start)])))
                    if sum(len(k) for parts in held.values() for k, _ in parts) > 2_000_000:
                        yield from merged()
                if not turns:
                    continue
                # a hash of its text's doc_id and its place deals a window to a round and a shard
                deal = mix(docs[s:e][text] + mix(start - bounds[text]))
                turn = (deal % np.uint64(ROUNDS)).astype(np.int64)
                own = np.isin(turn, turns)
                start, text, deal, turn = start[own], text[own], deal[own], turn[own]
                _, y, inside, _ = window_rows(flat, bounds, start, text, BEGIN)
                before = prev[start]
                before = np.where(before == BEGIN, BEGIN_16, before)
                ids = np.concatenate((before[:, None], np.where(inside, y, NONE_16)), axis=1).astype(np.uint16)
                yield rows_of(4, turn, deal.view(np.int64), ids)
        yield from merged()
    return run


def _train(model):
    """A partition's steps on its windows: its weights times the windows seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, w = model.value
        steps, held, seen = Steps(w), np.zeros((0, WINDOW + 1), np.uint16), 0
        number = np.zeros(1 << 16, np.int64)
        number[:len(units.number)], number[BEGIN_16] = units.number, len(units.heads) + 1

        def step(ids: np.ndarray) -> int:
            x, y = ids[:, :-1], ids[:, 1:]
            inside = y != NONE_16
            steps.take(gradients(steps.w, units, np.where(inside, number[x], 0), number[y], inside))
            return len(ids)
        for batch in batches:
            held = np.concatenate((held, unpacked(batch.column(0).to_pylist())))
            whole = len(held) - len(held) % BATCH
            for s in range(0, whole, BATCH):
                seen += step(held[s:s + BATCH])
            held = held[whole:]
        if len(held):
            seen += step(held)
        if seen:
            flat = steps.flat.astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen),
                                              pa.array(np.full(len(flat), seen, np.int64))], names=["at", "x", "seen"])
    return run


def score_texts(w: dict, units: Units, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """ln P of each text; every unit is scored in one window."""
    numbers = units.number[flat]
    total = np.zeros(len(bounds) - 1)
    start, text, first = windows(bounds)
    table = tables(w)
    for a in range(0, len(start), CHUNK):
        s, t, f = start[a:a + CHUNK], text[a:a + CHUNK], first[a:a + CHUNK]
        x, y, ok, at = window_rows(numbers, bounds, s, t, len(units.heads) + 1)
        scored = ok & (f[:, None] | (np.arange(WINDOW) >= OVERLAP))
        # attention in batches that fit a cache, the softmaxes over more rows at once
        z = np.concatenate([states(table, x[b:b + 64])[scored[b:b + 64]] for b in range(0, len(x), 64)])
        y = y[scored]
        lp = log_probs(w, units, z, y)
        rare = y == len(units.heads)
        lp[rare] += units.log_rest[flat[at[scored][rare]]]
        total += np.bincount(np.broadcast_to(t[:, None], ok.shape)[scored], lp, len(total))
    return total


def _score(path: str, model, lower: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = remembered(sentence_pieces, path)
        units, w, (often, counts), tokens, types, texts_seen = model.value
        below = tokens + 0.5 * (types + 1)
        base_of = np.log10((counts + 0.5) / below)
        end_base = math.log10((texts_seen + 0.5) / below)
        for batch in batches:
            texts = batch.column("text")
            for s, e in slices(texts):
                own = Words(texts.slice(s, e - s), lower)
                flat, bounds = unit_rows(own, *ids_of(own))
                score = score_texts(w, units, flat, bounds) / math.log(10)
                vocab = own.vocab_hashes()
                place = np.minimum(np.searchsorted(often, vocab), max(len(often) - 1, 0))
                found = often[place] == vocab if len(often) else np.zeros(len(vocab), bool)
                known, n = found[own.codes], e - s
                known_n = np.bincount(own.doc[known], minlength=n)
                base = np.bincount(own.doc[known], base_of[place[own.codes[known]]], n) + end_base
                # the other words of each text, equal ones together
                doc, rest = own.doc[~known], vocab[own.codes[~known]]
                order = np.lexsort((rest, doc))
                doc, rest = doc[order], rest[order]
                new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (rest[1:] != rest[:-1])))) if len(doc) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate((new, [len(doc)])))
                cuts = np.searchsorted(doc[new], np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                    [to_long(rest[new]), pa.array(times.astype(np.int32))], names=["h", "tf"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s, n), batch.column("held_out").slice(s, n), pa.array(own.counts + 1),
                     pa.array(known_n.astype(np.int64) + (texts_seen > 0)), pa.array(base), pa.array(score), lists],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "score", "rest"])
    return run


def trained(train: DataFrame, counts: DataFrame, path: str, lower: bool = False):
    """Units and weights from the counts and the texts (text, hash of doc_id)."""
    spark = train.sparkSession
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if len(pieces) > NONE_16:
        raise ValueError(f"a vocabulary of {len(pieces)} units does not fit 16 bits")
    # bounded by the vocabulary
    by_unit = {r["key"]: r["n"] for r in counts.where("kind = 1").collect()}
    units = Units(by_unit, pieces)
    h = len(units.heads)
    start = [(i, n) for n, i in enumerate(units.heads)]
    number = spark.createDataFrame(start or [(-1, -1)], "id long, number long")
    a = number.select(F.col("id").alias("a"), F.col("number").alias("na"))
    b = number.select(F.col("id").alias("b"), F.col("number").alias("nb"))
    pairs = counts.where("kind = 2").select(F.expr("shiftright(key, 21)").alias("a"), F.expr("key & 2097151").alias("b"), "n")
    rest = F.lit(h)
    pairs = (pairs.join(F.broadcast(a), "a", "left").join(F.broadcast(b), "b", "left")
             .groupBy(F.when(F.col("a") == BEGIN, h + 1).otherwise(F.coalesce("na", rest)).alias("na"), F.coalesce("nb", rest).alias("nb"))
             .agg(F.sum("n").alias("n")))
    table = np.zeros((h + 2, h + 1))  # HEADS squared at most
    found = pairs.toPandas()
    table[found["na"].to_numpy(int), found["nb"].to_numpy(int)] = found["n"]
    w = initial(units, table)
    n_windows = (counts.where("kind = 5").first() or {"n": 0})["n"]
    shards = min(MOST_SHARDS, max(1, round(n_windows / ROUNDS / SHARD)))
    for turn in range(ROUNDS):
        model = spark.sparkContext.broadcast((units, w))
        own = train.mapInArrow(lean(_gather(path, lower, False, (turn,))), ROWS).select("ids", "n")
        # equal windows are alike, so equal hashes need no further order than their ids
        own = own.repartition(shards, "n").sortWithinPartitions("n", "ids")
        sums = (own.mapInArrow(lean(_train(model)), "at int, x double, seen long").groupBy("at")
                .agg(F.sum("x").alias("x"), F.sum("seen").alias("seen")).orderBy("at").toPandas())  # one row per weight
        if len(sums):
            flat, at = (sums["x"] / sums["seen"]).to_numpy(), 0
            for k in sorted(w):
                w[k] = flat[at:at + w[k].size].reshape(w[k].shape).astype(np.float32)
                at += w[k].size
    return units, w


def scored(docs: DataFrame, path: str, lower: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row.  Learns from rows whose crc32 of doc_id leaves no 1 when
    divided by 5.  ``lower``: A-Z are lower-cased first, all else is left as it is."""
    spark = docs.sparkSession
    small_batches(spark)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    train = docs.where(part != 1).select(text, F.xxhash64("doc_id").alias("doc"))
    gathered = train.mapInArrow(lean(_gather(path, lower, True, ())), ROWS)
    counts = written(gathered.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    units, w = trained(train, counts, path, lower)
    words = counts.where("kind = 0")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("types")).first()
    texts_seen = (counts.where("kind = 3").first() or {"n": 0})["n"]
    tokens, types = total["n"] + texts_seen, total["types"] + (1 if texts_seen else 0)
    # at most 1 / FREQUENT words
    often = words.where(F.col("n") >= max(1.0, FREQUENT * tokens)).select("key", "n").toPandas()
    keys = often["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = spark.sparkContext.broadcast((units, w, (keys[order], often["n"].to_numpy(np.float64)[order]), tokens, types, texts_seen))
    d = docs.select("doc_id", text, F.coalesce(part == 1, F.lit(False)).alias("held_out"))
    rows = d.mapInArrow(lean(_score(path, model, lower)), "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
                                             "rest array<struct<h: bigint, tf: int>>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scores")
    rest = rows.select("row", F.explode("rest").alias("r")).select("row", F.col("r.h").alias("key"), "r.tf")
    rest = rest.join(words.select("key", "n"), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rest = rest.groupBy("row").agg(F.sum(F.col("tf") * F.log10((F.col("n") + 0.5) / (tokens + 0.5 * (types + 1)))).alias("more"),
                                   F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("more_known"))
    zero = F.lit(0)
    return rows.drop("rest").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
