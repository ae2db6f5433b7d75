import hashlib
import random
from collections import Counter

import numpy as np
from helpers import without_repeats

from tessera.llm import substring_dedup as sd
from tessera.llm.substring_dedup import remove_repeats, repeats


def corpus(seed=2):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdéf") for _ in range(r.randint(1, 5)))
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (34, 35, 36, 40, 60, 120)]
    texts = []
    for i in range(150):
        w = prose(r.randint(0, 90))
        for _ in range(r.randint(0, 2)):
            p = list(r.choice(passages))
            if r.random() < 0.3:
                p[r.randrange(len(p))] = word()
            if r.random() < 0.3:
                p = p[r.randrange(5):]
            at = r.randint(0, len(w))
            w[at:at] = p
        texts.append(r.choice([" ", "\n", " \t"]).join(w))
    one = prose(50)
    texts += [None, "", " \n ", "x " * 200, "a b " * 60, "a b c " * 40 + "x " * 36, " ".join(one), "\t".join(one) + "\x0b",
              " ".join(one[:34]), " ".join(prose(40)), " ".join(prose(5000) + passages[3])]
    return texts


def check(spark, texts):
    got = {r.doc_id: r for r in repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == len(texts)
    for i, (w, kept) in enumerate(without_repeats(texts)):
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(w) - len(kept)), i
        assert got[i].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_equal_brute_force(spark):
    check(spark, corpus())


def test_longest_prefixes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 3)
    check(spark, corpus(4))


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, text, "a", 1), (7, text, None, 2), (7, "other " + text[3:], "c", 3), (8, None, "d", 4),
                                (9, "keep  me", "e", 8), (9, "keep  me", "e", 8)], "doc_id long, text string, d string, n_chars long")
    assert sorted((r.n_words, r.n_removed) for r in repeats(df).collect()) == [(0, 0), (2, 0), (2, 0), (60, 59), (60, 60), (60, 60)]
    left = remove_repeats(df)
    assert left.columns == df.columns
    rows = sorted((r.doc_id or -1, r.text or "", r.n_chars) for r in left.collect())
    assert rows == [(7, "other", 5), (8, "", 4), (9, "keep  me", 8), (9, "keep  me", 8)]
    assert repeats(df.limit(0)).count() == 0


def test_multiplicity_and_nodes_mark_repeats():
    r = np.random.default_rng(1)
    ctx = r.integers(1, 1 << 32, (4, 2 * sd.SIDE), dtype=np.uint32)
    ctx[1, sd.SIDE - 3:] = ctx[0, sd.SIDE - 3:]  # three words to the left and all to the right
    ctx[2, sd.SIDE:] = ctx[0, sd.SIDE:]
    gram = np.array([5, 5, 5, 6], np.int64)
    lo, hi = np.zeros(4, np.int64), np.full(4, sd.SIDE)
    hi[3] = 4
    got = sd.repeated_offsets(gram, lo, hi, ctx, np.array([False, False, False, True]))
    # offset 0 has no words to the left, so all three leaves share it; 1 to 3 are shared by two
    assert got.tolist() == [0b1111, 0b1111, 0b1, 0b11111]


def test_prefixes_are_lengthened_until_groups_fit(spark, monkeypatch):
    """A passage among different neighbours: prefixes get as long as it goes on, and no longer."""
    monkeypatch.setattr(sd, "GROUP", 5)
    r = random.Random(7)
    word = lambda: str(r.randrange(1 << 40))
    passage = [word() for _ in range(44)]
    docs = [[word() for _ in range(20)] + passage + [word() for _ in range(20)] for _ in range(30)]
    got = {}
    real = sd._depths

    def depths(d, spans):
        out = real(d, spans)
        got["depths"] = Counter(x.depth for x in out.collect())
        got["groups"] = out.groupBy("gram").count().collect()
        return out
    monkeypatch.setattr(sd, "_depths", depths)
    check(spark, [" ".join(d) for d in docs])
    assert max(x["count"] for x in got["groups"]) > 5
    assert len([d for d in got["depths"] if 0 < d]) > 1  # several lengths
    heavy = [" ".join(passage)] * 40 + [" ".join(d) for d in docs[:6]]
    check(spark, heavy)
