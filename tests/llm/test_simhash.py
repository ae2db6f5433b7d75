import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import lower, words

from tessera.llm.simhash import crowded_links, fingerprints, joined_links, simhash_groups, variants


def fingerprint(text):
    w = words(lower(text))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """{fingerprint: least doc_id reachable} by all pairs."""
    least = {}
    for i, t in rows:
        f = fingerprint(t)
        least[f] = min((x for x in (least.get(f), i) if x is not None), default=None)
    fps, root = list(least), {f: f for f in least}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for n, a in enumerate(fps):
        for b in fps[n + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    out = {}
    for f in fps:
        r = find(f)
        out[r] = min((x for x in (out.get(r), least[f]) if x is not None), default=None)
    return {f: out[find(f)] for f in fps}


def near_texts(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n // 30):
        w = [f"w{r.randrange(10 ** 6)}" for _ in range(r.choice([3, 60, 400]))]
        for _ in range(30):
            out.append(" ".join(w))
            w[r.randrange(len(w))] = f"w{r.randrange(10 ** 6)}"
    return out


def check(spark, rows, **kw):
    want = brute(rows)
    got = simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"), **kw).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted((tuple(r) for r in got), key=key) == sorted(
        ((i, f"{fingerprint(t):016x}", want[fingerprint(t)]) for i, t in rows), key=key)
    return want


@pytest.mark.parametrize("limit", [16_384, 2])
def test_equals_brute_force(spark, limit):
    rows = list(enumerate(near_texts(3, 300))) + [(1000 + i, "the same text of many copies") for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "a b"), (2006, "x " * 3000), (2007, "X x x x"),
             (None, rows[40][1]), (None, "nobody else's words here"), (2008, "Ünï çode wörds tö hash"), (2008, "a second text of one id")]
    random.Random(1).shuffle(rows)
    want = check(spark, rows, limit=limit)
    assert len(set(want.values())) < len(want)  # some different fingerprints are linked


def test_edges(spark):
    assert simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(2, "a b c d", 1, "x"), (1, "A b c D", 2, None)], "doc_id long, text string, fp int, variant string")
    out = simhash_groups(df)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(1, 1), (2, 1)}


def test_long_text_matches_plain_loop():
    r = random.Random(0)
    text = " ".join(r.choice(["aa", "b", "Cc", "d" * 40]) for _ in range(30_000))
    assert fingerprints(pa.array([text, None, "a", text[:50]])).tolist() == [fingerprint(t) for t in (text, None, "a", text[:50])]


def test_all_links_of_two_bits_meet(spark):
    """Every kind of pair, spread over the halves in all ways, by either index."""
    r = random.Random(8)
    base = r.getrandbits(64)
    fps = {base} | {base ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(150)} | {base ^ 1 << b for b in (0, 31, 32, 63)}
    fps |= {base ^ (r.getrandbits(16) << 8) for _ in range(100)} | {r.getrandbits(64) for _ in range(50)}
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    links = {(a, b) for i, a in enumerate(signed) for j, b in enumerate(signed) if i < j and (fps[i] ^ fps[j]).bit_count() <= 2}
    v = variants(spark.createDataFrame([(f,) for f in signed], "fp long"))
    met = v.alias("a").join(v.alias("b"), "variant").where("a.fp <> b.fp").selectExpr("a.fp a", "b.fp b").distinct().collect()
    met = {tuple(x) for x in met}
    assert all(p in met for p in links)

    def groups(pairs):
        root = {f: f for f in signed}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f
        for a, b in pairs:
            root[find(a)] = find(b)
        by = {}
        for f in signed:
            by.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, by.values()))
    crowded = [tuple(x) for x in crowded_links(v.select("variant", "fp")).collect()]
    both = links | {(b, a) for a, b in links}
    assert all(p in both for p in crowded)
    assert groups(crowded) == groups(links)
    x, y = joined_links(np.array(fps, np.uint64))
    assert groups([(signed[i], signed[j]) for i, j in zip(x, y)]) == groups(links)
