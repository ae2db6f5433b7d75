import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece

from helpers import lower, words
from tessera.llm import attention_lm as lm
from tessera.llm.common import Words, read_table
from tessera.llm.queries import op3_attention_lm
from tessera.llm.subwords import sentence_pieces

PATH = P.path("piece_bpe_32k.model")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small():
    r = np.random.default_rng(0)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    counts = {int(i): int(n) for i, n in zip(r.choice(32000, 1500, replace=False), r.integers(1, 500, 1500))}
    units = lm.Units(counts, [sp.id_to_piece(i) for i in range(32000)])
    h = len(units.heads)
    w = lm.initial(units, r.poisson(0.3, (h + 2, h + 1)).astype(float))
    for k in w:
        w[k] = w[k] + r.normal(0, 0.05, w[k].shape).astype(np.float32)
    return units, w


def test_probabilities_of_all_units_sum_to_one(small):
    units, w = small
    z = np.random.default_rng(1).normal(0, 1, (3, lm.WIDTH)).astype(np.float32)
    for state in z:
        ids = np.arange(32000)
        y = units.number[ids]
        lp = lm.log_probs(w, units, np.repeat(state[None], len(ids), axis=0), y)
        lp[y == len(units.heads)] += units.log_rest[ids[y == len(units.heads)]]
        assert np.exp(lp).sum() == pytest.approx(1, abs=1e-3)


def test_gradients(small):
    units, w = small
    w = {k: v.astype(np.float64) for k, v in w.items()}
    r = np.random.default_rng(2)
    x, y = r.integers(0, lm.HEADS + 2, (4, lm.WINDOW)), r.integers(0, lm.HEADS + 1, (4, lm.WINDOW))
    ok = r.random(x.shape) < 0.8

    def loss(w):
        z, _ = lm.attend(w, x)
        return -lm.log_probs(w, units, z[ok], y[ok]).mean()
    grads = lm.gradients(w, units, x, y, ok)
    for k in w:
        for _ in range(3):
            at = np.unravel_index(np.abs(grads[k] * (r.random(w[k].shape) < 0.5)).argmax(), w[k].shape)
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][at] += 1e-4
            down[k][at] -= 1e-4
            assert grads[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=2e-2, abs=1e-6), k


def test_windows_score_each_unit_once_and_causally(small):
    units, w = small
    r = np.random.default_rng(3)
    texts = [r.integers(3, 32000, n) for n in (0, 1, 5, lm.WINDOW - 1, lm.WINDOW, 200, 61)]
    flat = np.concatenate([np.append(t, lm.END) for t in texts])
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    got = lm.score_texts(w, units, flat, bounds)
    for i, t in enumerate(texts):
        ids = np.append(t, lm.END)
        total, numbers = 0.0, units.number[ids]
        x = np.concatenate(([len(units.heads) + 1], numbers[:-1]))
        for k in range(len(ids)):  # each unit by itself, from the window that scores it
            j = 0 if k < lm.WINDOW else (k - lm.OVERLAP) // (lm.WINDOW - lm.OVERLAP)
            a = j * (lm.WINDOW - lm.OVERLAP)
            own = np.zeros((1, lm.WINDOW), int)
            own[0, :k - a + 1] = x[a:k + 1]  # nothing after it
            z, _ = lm.attend(w, own)
            total += lm.log_probs(w, units, z[:, k - a], numbers[k:k + 1])[0]
            if numbers[k] == len(units.heads):
                total += units.log_rest[ids[k]]
        assert got[i] == pytest.approx(total, rel=1e-4)


def test_units_of_texts():
    ids_of = sentence_pieces(PATH)
    w = Words(pa.array(["the cat", None, "", "a\nb"]))
    flat, bounds = lm.unit_rows(w, *ids_of(w))
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for i, t in enumerate((["the", "cat"], [], [], ["a", "b"])):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == [x for word in t for x in sp.encode(word)] + [lm.END]


def test_every_window_is_learned_from_in_one_round():
    ids_of = sentence_pieces(PATH)
    texts = ["the cat " * k for k in range(40)] + ["the cat sat on"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)), pa.int64())], names=["text", "doc"])
    rows = [r for out in lm._gather(PATH)([batch]) for r in out.to_pylist() if r["kind"] == 4]
    for r in rows:
        ids = lm.unpacked([r["ids"]])[0].tolist()
        r["ids"] = [{lm.BEGIN_16: lm.BEGIN, lm.NONE_16: -1}.get(i, i) for i in ids]
    words = Words(pa.array(texts))
    flat, bounds = lm.unit_rows(words, *ids_of(words))
    want, step = Counter(), lm.WINDOW - lm.OVERLAP
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        for s in range(a, max(a + 1, b - lm.OVERLAP), step):
            own = flat[s:min(b, s + lm.WINDOW)].tolist()
            want[tuple([lm.BEGIN if s == a else int(flat[s - 1]), *own] + [-1] * (lm.WINDOW - len(own)))] += 1
    assert Counter(tuple(r["ids"]) for r in rows) == want
    assert {r["key"] for r in rows} == set(range(lm.ROUNDS))
    # equal texts of several documents are dealt apart
    alike = Counter(tuple(r["ids"]) for r in rows).most_common(1)[0][0]
    assert {r["key"] for r in rows if tuple(r["ids"]) == alike} == set(range(lm.ROUNDS))


def base_scores(rows):
    train = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(x for t in train for x in words(t))
    n, v = sum(c.values()) + len(train), len(c) + bool(train)
    f = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return n, [(len(words(t)) + 1, sum(c[x] > 0 for x in words(t)) + bool(train), sum(f(c[x]) for x in words(t)) + f(len(train))) for _, t in rows]


@pytest.mark.parametrize("frequent", [1e-5, 1e-3])
def test_base_scores_and_held_out(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = read_table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in lm.scored(docs, PATH).collect()}
    n, want = base_scores(rows)
    assert len(got) == len(rows)
    units = Words(pa.array([t for _, t in rows]))
    flat, bounds = lm.unit_rows(units, *sentence_pieces(PATH)(units))
    train, held = [], []
    for k, ((i, t), (tokens, known, base)) in enumerate(zip(rows, want)):
        g = got[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, tokens, known, n)
        assert g.base_score == pytest.approx(base) and g.score < 0
        (held if g.held_out else train).append((flat[bounds[k]:bounds[k + 1]], g.score))
    # better on held-out texts than the units' frequencies
    c = Counter(int(u) for ids, _ in train for u in ids)
    total = sum(c.values())
    unigram = sum(math.log10((c[int(u)] + 0.5) / (total + 16000)) for ids, _ in held for u in ids)
    assert sum(s for _, s in held) > 0.85 * unigram


def test_edges(spark):
    schema = "doc_id long, text string, h string, score int"
    rows = [(i, f"the cat {i} sat", "x", 1) for i in range(12)] + [(None, "the dog", "x", 1), (20, None, None, 1), (21, "", "x", 1), (5, "the cat 5 sat", "x", 1)]
    got = [tuple(r) for r in lm.scored(spark.createDataFrame(rows, schema), PATH).select("doc_id", "n_tokens", "n_known", "base_score").collect()]
    n, want = base_scores([r[:2] for r in rows])
    key = lambda x: (x[0] is None, x[0] or 0)
    want = [(r[0], *w) for r, w in zip(rows, want)]
    for g, x in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:3] == x[:3] and g[3] == pytest.approx(x[3])
    alone = lm.scored(spark.createDataFrame([(None, "a b", "x", 1)], schema), PATH).collect()  # nothing to learn from
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in alone] == [(3, 0, 0)] and np.isfinite(alone[0].score)
    assert lm.scored(spark.createDataFrame([], schema), PATH).count() == 0


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """One model from the same rows, however they are split, with several shards."""
    monkeypatch.setattr(lm, "SHARD", 700)
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    seen = []
    for n in (1, 3, 16):
        rows = lm.scored(docs.repartition(n, "text"), PATH).select("doc_id", "score").collect()
        seen.append({r.doc_id: r.score for r in rows})
    assert len(seen[0]) == docs.count()
    for other in seen[1:]:
        assert other == pytest.approx(seen[0], rel=1e-4, abs=1e-3)


def test_blocks_equal_a_plain_softmax(small):
    units, w = small
    r = np.random.default_rng(4)
    z = r.normal(0, 1, (500, lm.WIDTH)).astype(np.float32)
    y = r.choice([0, 5, 31, 32, 700, lm.HEADS - 1, lm.HEADS], 500)  # a few crowded groups, most empty
    got = lm.log_probs(w, units, z, y)
    for state, t, lp in zip(z, y, got):
        top = state @ w["Uc"] + w["bc"]
        want = top[units.of[t]] - np.log(np.exp(top).sum())
        if t < lm.HEADS:
            inner = state @ w["Ug"][t // lm.SIZE] + w["bg"][t // lm.SIZE]
            want += inner[t % lm.SIZE] - np.log(np.exp(inner).sum())
        assert lp == pytest.approx(want, abs=1e-4)


def test_few_units(small):
    """Fewer units than a group holds: places without a unit have no share and no gradient."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    units = lm.Units({5: 9, 6: 4, 2: 3}, [sp.id_to_piece(i) for i in range(32000)])
    w = lm.initial(units, np.ones((5, 4)))
    ids = np.arange(32000)
    lp = lm.log_probs(w, units, np.zeros((len(ids), lm.WIDTH), np.float32), units.number[ids])
    rest = units.number[ids] == 3
    lp[rest] += units.log_rest[ids[rest]]
    assert np.exp(lp).sum() == pytest.approx(1, abs=1e-3)
    x = np.array([[4, 0, 1, 2] + [0] * (lm.WINDOW - 4)])
    grads = lm.gradients(w, units, x, np.array([[0, 1, 2, 3] + [0] * (lm.WINDOW - 4)]), np.arange(lm.WINDOW)[None] < 4)
    assert not grads["Ug"][:, :, 3:].any() and all(np.isfinite(g).all() for g in grads.values())


def test_query_lower_cases_ascii_letters(spark, tmp_path):
    """The contract's tokens: A-Z lower-cased, other capitals and characters left alone."""
    texts = ["The CAT sat", "the cat SAT", "É é Éa\x1cB\x85C\xa0D", "THE\x0bDog\x0cdog", None, "", "\u212a K k İ"] + ["Odd oDD oDd"] * 8
    rows = list(enumerate(texts)) + [(3, "The the"), (None, "CAT")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_attention_lm(spark, str(tmp_path)).collect()
    n, want = base_scores([(i, lower(t)) for i, t in rows])
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got_rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in got), key=key)
    assert got_rows == sorted(((i, h, *x[:2], n, round(x[2], 9)) for (i, _), h, x in zip(rows, held, want)), key=key)
    # texts that differ in A-Z alone have one score
    score = {r.doc_id: r.score for r in got}
    assert score[0] == pytest.approx(score[1], rel=1e-5)


def test_states_by_tables_equal_attention(small):
    units, w = small
    x = np.random.default_rng(5).integers(0, lm.HEADS + 2, (7, lm.WINDOW))
    assert lm.states(lm.tables(w), x) == pytest.approx(lm.attend(w, x)[0], abs=1e-4)


def test_each_distinct_word_is_hashed_once(monkeypatch):
    """Counting needs the words' hashes twice, for their ids and as their keys."""
    import xxhash
    made, h = [], xxhash.xxh3_64_intdigest
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda s: made.append(s) or h(s))
    batch = pa.RecordBatch.from_arrays([pa.array(["the cat", "a cat", None]), pa.array([1, 2, 3], pa.int64())], names=["text", "doc"])
    rows = [r for out in lm._gather(PATH)([batch]) for r in out.to_pylist() if r["kind"] == 0]
    assert sorted(made) == [b"a", b"cat", b"the"]
    assert sorted(r["n"] for r in rows) == [1, 1, 2]
