import hashlib
import random
from fractions import Fraction

import pytest

from helpers import words
from tessera.llm.mixing import budgets, mix_documents, mixed


def water(budget, nodes):
    """{name: alloc} for nodes {name: (weight, capacity)}, by repeated sharing."""
    alloc, open_, left = {k: 0 for k in nodes}, {k: v for k, v in nodes.items() if v[0] > 0}, budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c * total <= w * left}
        if not full:
            alloc |= {k: w * left // total for k, (w, _) in open_.items()}
            # the rest, a token each, in order of capacity by weight, then name
            order = sorted(open_, key=lambda k: (open_[k][1] / open_[k][0], k is not None, k or ""))
            for k in order[:left - sum(alloc[k] for k in open_)]:
                alloc[k] += 1
            return alloc
        k = min(full, key=lambda k: Fraction(full[k], open_[k][0]))
        alloc[k] = full[k]
        left -= full[k]
        del open_[k]
    return alloc


def brute(rows, percent, epochs, weights, seed):
    docs = [(i, t, f"d{i_dom(s)}", l, s, len(words(t)) + 1) for i, t, l, s in rows]
    supply = {}
    for *_, d, l, s, n in docs:
        supply[d, l, s] = supply.get((d, l, s), 0) + n
    w = lambda level, k: weights.get(level, {}).get(k, 1)
    weighty = lambda k, depth: all(w(level, k[i]) > 0 for i, level in list(enumerate(("domain", "lang", "source")))[depth:])
    cap = lambda pick, depth: sum(v for k, v in supply.items() if pick(k) and weighty(k, depth)) * epochs
    top = water(sum(supply.values()) * percent // 100, {d: (w("domain", d), cap(lambda k: k[0] == d, 1)) for d in {k[0] for k in supply}})
    out = []
    for d, b in top.items():
        langs = water(b, {l: (w("lang", l), cap(lambda k: k[:2] == (d, l), 2)) for l in {k[1] for k in supply if k[0] == d}})
        for l, b2 in langs.items():
            for s, a in water(b2, {s: (w("source", s), cap(lambda k: k == (d, l, s), 3)) for s in {k[2] for k in supply if k[:2] == (d, l)}}).items():
                full, left = divmod(a, supply[d, l, s])

                def place(x):
                    key = str(x[0]) if x[0] is not None else hashlib.md5((x[1] or "").encode()).hexdigest()
                    return int(hashlib.md5(f"{seed}:{full}:{key}".encode()).hexdigest()[:13], 16)
                sofar, own = 0, sorted((x for x in docs if x[2:5] == (d, l, s)), key=place)
                for x in own:
                    taken = left > 0 and 2 * sofar + x[5] <= 2 * left
                    sofar += x[5]
                    out += [(x[0], d, l, s, x[5], e) for e in range(full + taken)]
    return out


def i_dom(source):
    import zlib
    return zlib.crc32((source or "").encode()) % 3


@pytest.mark.parametrize("percent,epochs,per_cell", [(80, 2, 20_000), (30, 1, 10), (150, 3, 25), (400, 2, 10)])
def test_equals_brute_force(spark, percent, epochs, per_cell):
    r = random.Random(percent)
    rows = []
    for i in range(500):
        source = "s0" if r.random() < 0.35 else r.choice(["s1", "s2", "s3", "s4", "s5", None])
        rows.append((i, r.choice([None, "", " ".join(["w"] * r.randint(1, 80))]) if r.random() < 0.1 else " ".join(["w"] * r.randint(1, 60)),
                     r.choice(["en", "en", "de", "fr", None]), source))
    weights = {"domain": {"d0": 5, "d1": 1}, "lang": {"en": 3, "fr": 0}, "source": {"s1": 4}}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [tuple(x) for x in mixed(df, percent, epochs, weights, 3, per_cell=per_cell).selectExpr(
        "row.doc_id", "domain", "lang", "source", "n_tokens", "epoch").collect()]
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(got, key=key) == sorted(brute(rows, percent, epochs, weights, 3), key=key)


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b", "en", "s", 1), (None, None, None, None, 2), (1, "c", "en", "s", 3), (1, "c", "en", "s", 3)],
                               "doc_id long, text string, lang string, source string, epoch int")
    left = mix_documents(df, percent=100, max_epochs=1)
    assert left.columns == df.columns and left.count() == 4
    assert mix_documents(df.limit(0)).count() == 0


def settle(supply, budget, epochs, weights):
    """What leaves can take, token by token: each goes to the domain, language
    and source that is furthest behind its weight and can still place one."""
    w = lambda level, k: weights.get(level, {}).get(k, 1)
    got = {k: 0 for k in supply}
    room = lambda k: supply[k] * epochs - got[k] if all(w(x, n) > 0 for x, n in zip(("domain", "lang", "source"), k)) else 0
    for _ in range(budget):
        key = ()
        for depth, level in enumerate(("domain", "lang", "source")):
            names = {k[depth] for k in supply if k[:depth] == key and any(room(j) > 0 for j in supply if j[:depth + 1] == key + (k[depth],))}
            if not names:
                return got
            share = lambda n: Fraction(sum(v for k, v in got.items() if k[:depth + 1] == key + (n,)), w(level, n))
            key += (min(names, key=lambda n: (share(n), n)),)
        got[key] += 1
    return got


@pytest.mark.parametrize("weights", [{"source": {"x": 0}}, {"lang": {"a": 0}}, {"domain": {"d1": 0}}, {"domain": {"d0": 3}, "lang": {"b": 0}, "source": {"z": 0, "y": 5}},
                                     {"lang": {"a": 0, "b": 0, "c": 0}}])
def test_zero_weights_lose_no_budget(spark, weights):
    """The whole budget is placed wherever any leaf with a weight has room."""
    supply = {("d0", "a", "x"): 100, ("d0", "a", "y"): 10, ("d0", "b", "z"): 100, ("d1", "a", "x"): 40, ("d1", "c", "y"): 7}
    for percent in (5, 41, 60, 100):
        total = sum(supply.values()) * percent // 100
        leaves = spark.createDataFrame([(*k, v) for k, v in supply.items()], "domain string, lang string, source string, _supply long")
        got = {(r.domain, r.lang, r.source): r._alloc for r in budgets(leaves, percent, 1, weights).collect()}
        want = settle(supply, total, 1, weights)
        assert sum(got.values()) == sum(want.values())
        assert all(abs(got[k] - want[k]) <= 3 for k in want), (got, want)  # whole tokens per level
