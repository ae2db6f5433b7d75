import random
from collections import Counter

import numpy as np
import pytest

from helpers import words
from tessera.llm import quality as q


def stats(text):
    w, t = words(text), text or ""
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines), len(lines) - len(set(lines)), len(covered))


def texts(seed=0, n=400):
    r = random.Random(seed)
    vocab = ["the", "of", "réti", "onan", "herent", "thsh", "x", "andhainan"]
    out = [None, "", " \n\t", "a", "one two three four five six seven eight nine", "a b c d e a b c d e a", "x " * 50, "a\n\nb\n \na\nb\x0bc",
           "#$% <|> a*b " * 30]
    for _ in range(n):
        w = [r.choice(vocab) + "".join(r.choice("abcdefg") for _ in range(r.randint(0, 6))) for _ in range(r.randint(5, 400))]
        if r.random() < 0.1:
            w += w[:r.randint(4, 12)]
        if r.random() < 0.1:
            w = [x + "$$$" for x in w]
        out.append("".join(x + r.choice([" ", " ", " ", " ", ".\n"]) for x in w))
    return out


def brute_verdicts(rows, coverage=0.75, steps=3, min_group=50, quantile=0.9999999):
    """The same estimate with numpy: groups, two starts, binned concentration steps."""
    p, unit = q.P, q.UNIT
    st = [stats(t) for _, t, _, _ in rows]
    bad = [s[0] < 10 or 100 * s[5] > 20 * s[0] for s in st]
    n, ch = np.array([max(s[0], 1) for s in st]), np.array([max(s[1], 1) for s in st])
    f = np.stack([np.log(n), np.log(ch / n), np.sqrt(np.array([s[2] for s in st]) / ch),
                  np.sqrt([s[4] / max(s[3], 1) for s in st]), np.sqrt(np.array([s[5] for s in st]) / n)], axis=1)
    x = np.floor(f * unit + 0.5)
    ridge = np.diag([(v * unit) ** 2 for v in q.FLOORS])

    def factor(cov):
        l = np.zeros((p, p))
        for j in range(p):
            l[j, j] = np.sqrt(max(cov[j, j] - (l[j, :j] ** 2).sum(), 1.0))
            for i in range(j + 1, p):
                l[i, j] = (cov[i, j] - (l[i, :j] * l[j, :j]).sum()) / l[j, j]
        return l
    distance = lambda pts, m, l: (np.linalg.solve(l, (pts - m).T) ** 2).sum(axis=0)

    def fit(pts):
        starts = [(pts.mean(axis=0), factor(np.cov(pts.T, bias=True) + ridge))]
        a, m, b = np.percentile(pts, [25, 50, 75], axis=0)
        starts.append((m, factor(np.diag(((b - a) / 1.349) ** 2) + ridge)))
        best = []
        for m, l in starts:
            for _ in range(steps):
                bins = np.floor(np.log2(1 + distance(pts, m, l)) * 16)
                take = np.zeros(len(pts), bool)
                for v in np.unique(bins):
                    if take.sum() < coverage * len(pts):
                        take |= bins == v
                m, l = pts[take].mean(axis=0), factor(np.cov(pts[take].T, bias=True) + ridge)
            best.append((np.log(np.diag(l)).sum(), len(best), m, l))
        return min(best, key=lambda z: z[:2])[2:]
    good = np.array([not b for b in bad])
    groups = {}
    for i, (_, _, lang, source) in enumerate(rows):
        groups.setdefault((lang, source), []).append(i)
    pooled = fit(x[good]) if good.any() else None
    scale = coverage / q.chi2_cdf(q.chi2_quantile(coverage, p), p + 2)
    kept, d2 = [False] * len(rows), [None] * len(rows)
    for ids in groups.values():
        own = [i for i in ids if good[i]]
        est = fit(x[own]) if len(own) >= min_group else pooled
        for i in ids:
            d2[i] = distance(x[i:i + 1], *est)[0] / scale
            kept[i] = not bad[i] and d2[i] <= q.chi2_quantile(quantile, p)
    return st, bad, kept, d2


def test_verdicts_equal_brute_force(spark):
    r = random.Random(1)
    rows = [(i, t, r.choice(["en", "en", "en", None, "de"]), r.choice(["a", "a", "b"])) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in q.quality(df).collect()}
    st, bad, kept, d2 = brute_verdicts(rows)
    for i in range(len(rows)):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_lines, g.n_dup_lines, g.n_repeat_words) == st[i], rows[i]
        assert g.base_failed == bad[i] and g.d2 == pytest.approx(d2[i], rel=1e-6, abs=1e-9) and g.kept == kept[i]
    assert any(not k and not b for k, b in zip(kept, bad)) and sum(kept) > 250


def test_repeats_and_symbols_go_in_a_uniform_group(spark):
    r = random.Random(5)
    line = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4))
    rows = [(i, "\n".join(line() for _ in range(12)), "en", "s") for i in range(80)]
    own = [line() for _ in range(10)]
    odd = {100: [own[k] for k in (0, 1, 2, 3, 4, 5, 0, 2, 4, 1, 3, 5)], 101: [*own, own[0] + " #######################", line()], 102: [line() for _ in range(12 * 20)]}
    rows += [(i, "\n".join(x), "en", "s") for i, x in odd.items()]
    # a passage of few words repeated: below the base rule's fifth, far above the group's none
    w = " ".join(line() for _ in range(12)).split()
    rows.append((103, " ".join([*w, *w[8:13]]), "en", "s"))
    got = {x.doc_id: x for x in q.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].base_failed for i in range(100, 104))
    assert {i for i, x in got.items() if not x.kept} == {100, 101, 102, 103}


def test_native_and_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h i j k", None, None, 1), (2, None, "en", "s", 2), (2, None, "en", "s", 2)],
                               "doc_id long, text string, lang string, source string, d2 int")
    left = q.keep_good(df)
    assert left.columns == df.columns and [tuple(x) for x in left.collect()] == [(None, "a b c d e f g h i j k", None, None, 1)]
    assert "Python" not in left._jdf.queryExecution().toString() and "Arrow" not in left._jdf.queryExecution().toString()
    assert q.quality(df.limit(0)).count() == 0


def test_chi_square():
    assert q.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert q.chi2_cdf(9.2364, 5) == pytest.approx(0.9, abs=1e-4)
