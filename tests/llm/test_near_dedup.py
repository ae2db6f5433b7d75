import random

import numpy as np
import pytest
from helpers import near_components, shingles

from tessera.llm.near_dedup import band_values, keep_first, least_for, near_groups, rows_for, superminhash
from tessera.llm.common import mix


def texts(seed=1, groups=12, size=9, length=90):
    """Chains of near copies: each differs from the one before in a word or two."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    out = []
    for _ in range(groups):
        w = [word() for _ in range(length)]
        for _ in range(size):
            out.append(" ".join(w))
            for _ in range(r.randint(0, 3)):
                w[r.randrange(length)] = word()
    return out


def test_components_equal_brute_force(spark):
    rows = list(enumerate(texts())) + [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE two"), (905, "one"),
                                       (906, "x " * 3000), (907, "X " * 2990), (908, "a b c"), (909, "a b c")]
    rows += [(1000 + i, rows[0][1].upper()) for i in range(30)]
    random.Random(3).shuffle(rows)
    got = {r.doc_id: r for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = near_components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in rows)
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_groups(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f", "x"), (5, "a b c d e f", "y"), (3, "a b c d e F", None), (3, "a b c d e F", None)],
                               "doc_id long, text string, bands string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_groups(df).collect())
    assert got == [(-1, -1, True), (3, 3, True), (3, 3, True), (5, 3, False)]
    left = keep_first(df)
    assert left.columns == df.columns and sorted(r.doc_id or -1 for r in left.collect()) == [-1, 3]


def test_signature_estimates_similarity():
    r = np.random.default_rng(0)
    a = mix(r.integers(0, 1 << 62, 400).astype(np.uint64))
    b = np.concatenate((a[:300], mix(r.integers(0, 1 << 62, 100).astype(np.uint64))))
    est = []
    for salt in range(30):
        x, y = mix(a + np.uint64(salt)), mix(b + np.uint64(salt))
        s = superminhash(np.repeat([0, 1], 400), np.concatenate((x, y)), 2)
        est.append((s[0] == s[1]).mean())
    assert np.mean(est) == pytest.approx(300 / 500, abs=0.03)
    # a set of one element fills every place with its own permutation
    one = superminhash(np.zeros(1, int), a[:1], 1)[0]
    assert sorted(int(v) >> 32 for v in one) == list(range(len(one)))


def test_sets_of_few_and_many_elements_match_plain_loop():
    """Early stopping changes nothing: all steps of all elements give the same."""
    r = np.random.default_rng(5)
    for n in (1, 7, 60, 900):
        h = mix(r.integers(0, 1 << 62, n).astype(np.uint64))
        m = 16
        want = [2 ** 64 - 1] * m
        for x in h:
            p = list(range(m))
            for step in range(m):
                u = int(mix(np.array([(int(x) + step * 0x9E3779B97F4A7C15 + 1) % 2 ** 64], np.uint64))[0])
                k = step + (((u & 0xFFFFFFFF) * (m - step)) >> 32)
                p[step], p[k] = p[k], p[step]
                want[p[step]] = min(want[p[step]], (u >> 32) + (step << 32))
        assert superminhash(np.zeros(n, int), h, 1, m)[0].tolist() == want


def test_links_beside_the_pivots(spark):
    """One large group of copies of a text with few or many edits: many links
    are between members that neither pivot is linked with."""
    r = random.Random(9)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 4, 6, 8, 10])):
            w[r.randrange(150)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.component_id for x in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = near_components(rows)
    assert got == want and 1 < len(set(want.values())) < 400


def by_id(rows, threshold):
    """Brute force where rows that share a doc_id are one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


@pytest.mark.parametrize("threshold", [60, 80, 85])
def test_thresholds_and_ids_with_several_texts(spark, threshold):
    r = random.Random(threshold)
    rows = []
    for i, t in enumerate(texts(seed=threshold, groups=10, size=8, length=60)):
        rows.append((r.randrange(70) if r.random() < 0.3 else 100 + i, t))
    w = [f"p{i}" for i in range(120)]
    rows += [(5, " ".join(w)), (5, " ".join(w[::-1])), (7, " ".join(w + ["x"])), (9, " ".join(w[::-1] + ["y"])), (5, " ".join(w))]
    r.shuffle(rows)
    want = by_id(rows, threshold)
    out = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()
    assert {x.doc_id: x.component_id for x in out} == want and len({x.doc_id: x for x in out}) == len(want)
    assert want[7] == want[9] == want[5]
    left = keep_first(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()
    assert sorted(x.doc_id for x in left) == sorted(set(want.values()))


def test_recall_of_signatures():
    """Pairs just at the threshold: the share of places that agree stays above
    what the comparison asks for, and they share a band."""
    g = np.random.default_rng(3)
    for threshold in (60, 80, 85):
        rows, least = rows_for(threshold), least_for(threshold)
        missed = 0
        for _ in range(150):
            common = threshold
            h = mix(g.integers(0, 1 << 62, 100).astype(np.uint64))
            a, b = h[:common + (100 - common) // 2], np.concatenate((h[:common], h[common + (100 - common) // 2:]))
            sim = common / 100
            sig = superminhash(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), 2)
            m = band_values(sig).view(f"u{2 * rows}")
            agree = (band_values(sig).view(np.uint16)[0] == band_values(sig).view(np.uint16)[1]).mean()
            assert abs(sim - threshold / 100) < 1e-9
            missed += agree < least or not (m[0] == m[1]).any()
        assert missed == 0
    with pytest.raises(ValueError):
        rows_for(5)


def half_alike(n, seed=11, length=120):
    """Pairs that share buckets and are not near: half of their shingles are equal."""
    r, out = random.Random(seed), []
    for i in range(n):
        own = [f"{i}w{r.randrange(10 ** 6)}" for _ in range(length)]
        out += [" ".join(own), " ".join(own[:2 * length // 3] + [f"{i}v{r.randrange(10 ** 6)}" for _ in range(length // 3)])]
    return list(enumerate(out))


def test_texts_go_only_where_a_link_is_likely(spark, monkeypatch):
    """Pairs whose signatures allow no link met with their texts before."""
    from tessera.llm import near_dedup
    rows, seen, written = half_alike(60), {}, near_dedup.written

    def noted(df, name):
        out = written(df, name)
        seen[name] = max(seen.get(name, 0), out.count())
        return out
    monkeypatch.setattr(near_dedup, "written", noted)
    near = [(1000, rows[0][1]), (1001, rows[0][1] + " more"), (1002, rows[2][1] + " more")]
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows + near, "doc_id long, text string")).collect()}
    assert got == near_components(rows + near)
    assert seen["pairs"] > 40  # of pairs that share a bucket
    assert seen["texts"] <= 4


def test_second_meeting_finds_the_links_of_the_rest(spark):
    """Members of a bucket that no pivot reaches: one chain beside many others."""
    from tessera.llm.near_dedup import BANDS, least_for, rest_links, shingle_sets
    import pyarrow as pa
    r = random.Random(5)
    own = [f"w{r.randrange(10 ** 6)}" for _ in range(200)]
    docs = [(i, " ".join(own + [f"x{i}"])) for i in range(6)] + half_alike(10)[6:]
    sets = shingle_sets(pa.array([t for _, t in docs]))
    sig = superminhash(np.repeat(np.arange(len(docs)), [len(s) for s in sets]), np.concatenate(sets), len(docs))
    bands = [(i, row.tolist()) for (i, _), row in zip(docs, band_values(sig))]
    first = {i: next(b for b in range(BANDS) if row[b] == bands[0][1][b]) if i < 6 else 0 for i, row in bands}
    members = [(1, i, len(s), first[i], i) for (i, _), s in zip(docs, sets)]
    m = spark.createDataFrame(members, "bucket long, v long, n long, band int, comp long")
    got = rest_links(m, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bands, "v long, bands array<long>"),
                     85, 4, block=4).collect()
    assert least_for(85) < 1
    root = {i: i for i in range(6)}
    for _ in range(6):
        for a, b in got:
            root[a] = root[b] = min(root[a], root[b])
    assert set(root.values()) == {0}


def test_texts_stay_in_place_where_few_documents_go(spark):
    """The join with the ids that go knew only the size of all ids before."""
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(3000)] + [(5000, "A1 b1 c1 d1 e1")]
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6000")
    try:
        left = keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert left.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
