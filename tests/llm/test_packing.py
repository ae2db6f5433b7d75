import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm.common import Words
from tessera.llm.packing import packed, plan
from tessera.llm.subwords import word_bpe

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def odd_texts():
    r = random.Random(0)
    parts = ["The", "école", "STRAßE,", "don't", "it's", "x1y22", "½", "été", "日本語", "안녕하세요", "가", "😀😀", "a b",
             "Ünï", "İstanbul", "ΣΑΣ", "ﬁn", "<|endoftext|>", "<|startoftext|>x", "a<|endoftext|>B<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "&amp;", "...", "!?", "the!!", "a" * 300, "́", "Ŀ", "ª", "µ", " z"]
    texts = [None, "", " ", "\n\t"] + parts
    return texts + [r.choice([" ", "\n", "  "]).join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(60)]


def test_ids_equal_the_tokenizers(tokenizer):
    texts = odd_texts()
    ids_of = word_bpe(PATH)
    for _ in range(2):  # from an empty and from a full memory
        w = Words(pa.array(texts, pa.string()))
        ids, size = ids_of(w)
        ends = np.concatenate(([0], np.cumsum(size)))[w.bounds]
        for i, t in enumerate(texts):
            assert ids[ends[i]:ends[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def brute_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            best = min(fits)
            rooms.remove(best)
            rooms.append(best - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 50, 300])
    lengths = [min(capacity, int(r.expovariate(1 / (capacity / 4))) + 1) for _ in range(r.randint(0, 800))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = plan(counts, capacity)
    spans, total = {}, 0
    for n in counts:
        ranks = sorted((a, a + k) for m, a, k, *_ in runs if m == n)
        assert [a for a, _ in ranks] == [0, *[b for _, b in ranks[:-1]]] and ranks[-1][1] == counts[n]
    for n, _, ranks, first, seqs, at in runs:
        for k in range(ranks):
            spans.setdefault(first + k % seqs, []).append((at + k // seqs * n, n))
            total += 1
    assert total == len(lengths)
    for s in spans.values():
        s.sort()
        assert [a for a, _ in s] == list(np.cumsum([0, *[n for _, n in s[:-1]]])) and s[-1][0] + s[-1][1] <= capacity
    assert len(spans) == brute_best_fit(lengths, capacity)


def test_packed(spark, tokenizer):
    texts = odd_texts() + ["word " * 300, "same same"] + ["copy of one"] * 40
    rows = list(enumerate(texts)) + [(None, "null id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("length", "length")
    got = packed(df, PATH, 64).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k // 64, k, len(ids[k:k + 64]), zlib.crc32(np.array(ids[k:k + 64], "<u4").tobytes())) for k in range(0, len(ids), 64)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        s.sort()
        assert [a for a, _ in s] == list(np.cumsum([0, *[n for _, n in s[:-1]]])) and sum(n for _, n in s) <= 64
    assert len(by) == brute_best_fit([w[3] for w in want], 64)
    assert packed(df.limit(0), PATH).count() == 0
