import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers import words
from tessera.llm import fingerprints as fp


def similarity(a, b):
    a, b = Counter(words(a)), Counter(words(b))
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate_is_generalised_jaccard():
    r = random.Random(0)
    vocab = [f"w{i}" for i in range(60)]
    for share in (0.2, 0.5, 0.9):
        est, true = [], []
        for k in range(60):
            a = [r.choice(vocab) + str(k) for _ in range(200)]
            b = [x if r.random() < share else r.choice(vocab) + str(k) for x in a]
            x = fp.fingerprints(pa.array([" ".join(a), " ".join(b)]))
            est.append((x[0] == x[1]).mean())
            true.append(similarity(" ".join(a), " ".join(b)))
        assert np.mean(est) == pytest.approx(np.mean(true), abs=0.02)


def brute(rows):
    """The same draws, word by word."""
    order = sorted(rows, key=lambda x: -x[0])
    out = {}
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        out[i] = (len(t), hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("size", [1 << 30, 3000])
def test_next_and_edited(spark, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE_BYTES", size)
    r = random.Random(size)
    rows = [(i * 3 - 50, r.choice([None, "", "é" * 7, " ".join(r.choice(["ab", "ça", "日本", "x"]) for _ in range(r.randint(1, 90)))]))
            for i in range(300)]
    rows += [(5000, "same text here"), (4999, "same text here")]
    r.shuffle(rows)
    got = {x.doc_id: x for x in fp.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert {i: (x.n_chars, x.edited_sha256) for i, x in got.items()} == want and len(got) == len(rows)
    assert got[5000].fingerprint == got[4999].fingerprint and got[5000].near_next == 1.0
    by_text = {}
    for i, t in rows:
        by_text.setdefault(tuple(words(t)), set()).add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    # likeness by the fingerprints themselves
    cut = lambda s: [s[k:k + 4] for k in range(0, len(s), 4)]
    for x in got.values():
        same = np.mean([a == b for a, b in zip(cut(x.fingerprint), cut(x.edited_fingerprint))])
        assert x.near_edited == pytest.approx(same)


def test_edges(spark):
    schema = "doc_id long, text string, range int"
    one = fp.fingerprint_pairs(spark.createDataFrame([(1, "a b c", 0)], schema)).collect()
    assert [(x.doc_id, x.near_next) for x in one] == [(1, 1.0)]
    rows = [(None, "a", 1), (None, None, 1), (3, "b c", 1), (3, "b c", 1)]
    got = fp.fingerprint_pairs(spark.createDataFrame(rows, schema)).collect()
    assert sorted((x.doc_id or -1, x.n_chars) for x in got) == [(-1, 0), (-1, 1), (3, 3), (3, 3)]
    assert fp.fingerprint_pairs(spark.createDataFrame([], schema)).count() == 0
