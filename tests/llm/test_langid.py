import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest


from tessera.llm import langid
from tessera.llm.common import read_table

PATH = P.path("piece_bpe_32k.model")
SF_SMALL = "/root/testdata/sf0.001"


def segmentations(word, pieces):
    """All ways to cut a word; single unknown characters are allowed."""
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces or k == 1:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]


def test_forward_sums_all_segmentations():
    vocab = langid.Vocabulary(PATH)
    number = {p: i for i, p in enumerate(vocab.pieces)}
    r = np.random.default_rng(0)
    probs = r.random((len(number), 3)) / 1e4
    words = ["the", "a", "straße", "日本語x", "inter", "zz", "ab" * 4, "\U0001F600q"]
    got = langid.Scorer(PATH, probs).fresh(words)
    unknown = 1e-3 / len(number)
    for w, g in zip(words, got):
        total = sum(np.prod([probs[number[p]] if p in number else np.full(3, unknown) for p in s], axis=0) for s in segmentations("▁" + w, number))
        assert g == pytest.approx(np.log(total), rel=1e-4)


def test_expected_pieces():
    vocab = langid.Vocabulary(PATH)
    number = {p: i for i, p in enumerate(vocab.pieces)}
    words = ["these", "él", "\U0001F600\U0001F600"]
    got = {}
    for own, piece, x in langid.expected_pieces(vocab, words):
        for a, b, c in zip(own, piece, x):
            got[a, b] = got.get((a, b), 0) + c
    want = {}
    for k, w in enumerate(words):
        ways = [(math.prod(1 / len(number) if p in number else 1e-3 / len(number) for p in s), s) for s in segmentations("▁" + w, number)]
        total = sum(x for x, _ in ways)
        for x, s in ways:
            for p in s:
                if p in number:
                    want[k, number[p]] = want.get((k, number[p]), 0) + x / total
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


UNKNOWN = "\u0f40"  # a character outside the vocabulary


@pytest.mark.parametrize("n", [58, 60, 64, 65, 200, 10_000])
def test_unknown_characters_in_a_row(n):
    vocab = langid.Vocabulary(PATH)
    start, pieces = vocab.pieces.index("\u2581"), len(vocab.pieces)
    assert UNKNOWN not in vocab.pieces
    probs = np.full((pieces, 2), 1e-5)
    probs[start] = 0.1, 0.2
    got = langid.Scorer(PATH, probs).fresh([UNKNOWN * n, "the", UNKNOWN * n + "the"])
    assert np.isfinite(got).all() and got[0] == pytest.approx(np.log([0.1, 0.2]) + n * math.log(1e-3 / pieces))
    found = list(langid.expected_pieces(vocab, [UNKNOWN * n]))
    numbers = {int(p): float(x) for _, ps, xs in found for p, x in zip(ps, xs)}
    assert numbers == {start: pytest.approx(1)}


def test_logarithms_agree_with_products(monkeypatch):
    vocab = langid.Vocabulary(PATH)
    words = ["internationalisation", "the" * 21, "stra\u00dfe", "a", "zz" + UNKNOWN * 5 + "inter", "ab" * 30]
    scorer = langid.Scorer(PATH, np.random.default_rng(0).random((len(vocab.pieces), 3)) / 1e4)

    def both():
        n = np.zeros((len(words), len(vocab.pieces)))
        for own, piece, x in langid.expected_pieces(vocab, words):
            np.add.at(n, (own, piece), x)
        return scorer.fresh(words), n
    want = both()
    monkeypatch.setattr(langid, "LONGEST", 0)
    for g, w in zip(both(), want):
        assert g == pytest.approx(w, rel=1e-8, abs=1e-12)


def test_unknown_runs_in_training_and_held_out_rows(spark):
    rows = [(i, "the thing " * 5 + UNKNOWN * k, "en") for i, k in enumerate([0, 60, 64, 500, 10_000] * 4)]
    rows += [(100 + i, "das ding \u00fcnd " * 5 + UNKNOWN * k, "de") for i, k in enumerate([0, 60, 64, 500, 10_000] * 4)]
    got = langid.predict_language(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), PATH).collect()
    lang = {i: l for i, _, l in rows}
    assert len(got) == len(rows) and all(r.lang_pred == lang[r.doc_id] and 0.5 < r.score <= 1 for r in got)


def test_held_out_accuracy(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.predict_language(docs, PATH).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, "the thing " * 5, "en", "x") for i in range(8)] + [(i, "das ding ünd " * 5, "de", "x") for i in range(20, 28)]
    rows += [(50, None, "en", None), (51, "", "en", None), (52, "123 ... 45", "en", None), (None, "the thing", "fr", None),
             (53, "the thing", None, None), (54, "the" * 5000, None, None), (54, "the" * 5000, None, None)]
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict_language(spark.createDataFrame(rows, schema), PATH).collect()]
    by = {}
    for i, l, s in got:
        by.setdefault(i, set()).add((l, s))
    assert by[50] == by[51] == by[52] == {("und", 0.0)} and {l for l, _ in by[None]} == {"en"}
    assert {l for l, _ in by[53]} == {l for l, _ in by[54]} == {"en"} and len(got) == len(rows)
    none = spark.createDataFrame([(1, "abc", None, None)], schema)
    assert [(r.lang_pred, r.score) for r in langid.predict_language(none, PATH).collect()] == [("und", 0.0)]
    assert langid.predict_language(none.limit(0), PATH).count() == 0


def test_training_cuts_equal_words_of_a_task_once(monkeypatch):
    """The same counts however many words are held, and one cutting of what batches share."""
    import pyarrow as pa
    rows = [("en", "the cat sat"), ("de", "the katze saß"), ("en", None), ("fr", "the the chat"), ("de", " ")] * 4
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    cut, plain = [], langid.expected_pieces

    def watched(vocab, words):
        cut.extend(words)
        return plain(vocab, words)
    monkeypatch.setattr(langid, "expected_pieces", watched)

    def counts(held):
        monkeypatch.setattr(langid, "HELD", held)
        cut.clear()
        out = [r for b in langid._counts(PATH)([batch.slice(a, 5) for a in range(0, 20, 5)]) for r in b.to_pylist()]
        return {(r["lang"], r["piece"]): r["n"] for r in out}, list(cut)
    (once, words), (each, many) = counts(10 ** 6), counts(0)
    assert sorted(words) == ["cat", "chat", "katze", "sat", "saß", "the"] and len(many) > len(words)
    assert once.keys() == each.keys() and all(abs(once[k] - each[k]) <= 1 for k in once)
    assert sum(n for (lang, _), n in once.items() if lang == "fr") > 0


def test_pieces_are_found_by_their_whole_hash():
    vocab = langid.Vocabulary(PATH)
    h = np.array([vocab.hash_of([ord(c) for c in p]) for p in vocab.pieces], np.uint64)
    assert vocab.find(h).tolist() == list(range(len(h)))
    assert (vocab.find(h.reshape(2, -1) if len(h) % 2 == 0 else h[None]).ravel() == np.arange(len(h))).all()
    assert not np.isin(vocab.find(h ^ np.uint64(1)), np.arange(len(h))).any() or np.isin(h ^ np.uint64(1), h).any()
