"""The pipeline against plain Python, stage by stage, each on its own input."""

import random

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline as cp
from helpers import near_components, without_repeats
from tessera.llm.common import written
from test_mixing import brute as brute_mix
from test_quality import brute_verdicts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(seed=11, n=260):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgé") for _ in range(r.randint(1, 8)))
    prose = lambda k: [word() for _ in range(k)]
    passages = [prose(50) for _ in range(3)]
    rows = []
    for i in range(n):
        w = prose(r.randint(3, 160))
        if rows and r.random() < 0.3:
            w = (rows[r.randrange(len(rows))][1] or "a b").split()
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = word()
        elif r.random() < 0.2:
            w = w + r.choice(passages) + prose(5)
        elif r.random() < 0.05:
            w = [x + "&&&" for x in w]
        text = None if r.random() < 0.02 else " ".join(w)
        rows.append((i, text, r.choice(["en", "en", "de", None]), r.choice(["s0", "s0", "s1", "s2"]), len(text or "")))
    return rows


def test_stages_and_run(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs, key = cp.read_table(spark, str(tmp_path), "documents"), lambda x: tuple((v is None, v) for v in x)
    stage = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "substring_dedup", "mixing", "packing"]

    def step(name, docs):
        out = written(stage[name](spark, docs, str(tmp_path)), name)
        return out, sorted((tuple(r) for r in out.collect()), key=key)
    docs, got = step("quality", docs)
    kept = brute_verdicts([r[:4] for r in rows])[2]
    assert docs.columns == COLUMNS and got == [r for r, k in zip(rows, kept) if k] and 0 < len(got) < len(rows)

    root = near_components([r[:2] for r in got])
    docs, now = step("near_dedup", docs)
    assert docs.columns == COLUMNS and now == [r for r in got if root[r[0]] == r[0]] and len(now) < len(got)

    want = [(i, t if len(k) == len(w) else " ".join(k), l, s, n if len(k) == len(w) else len(" ".join(k)))
            for (i, t, l, s, n), (w, k) in zip(now, without_repeats([r[1] for r in now])) if k or not w]
    docs, got = step("substring_dedup", docs)
    assert docs.columns == COLUMNS and got == want and got != now

    mix = cp.MIX
    taken = [i for i, *_ in brute_mix([r[:4] for r in got], mix["percent"], mix["max_epochs"], mix["weights"], mix["seed"])]
    by = {r[0]: r for r in got}
    docs, got = step("mixing", docs)
    assert docs.columns == COLUMNS and got == sorted((by[i] for i in taken), key=key)

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs, packed = step("packing", docs)
    assert sorted((r[0], r[3]) for r in packed) == sorted((i, len(t.encode(x or "", add_special_tokens=False).ids) + 1) for i, x, *_ in got)

    whole = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in cp.run(spark, str(tmp_path)).collect())
    assert whole == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in docs.collect())
