"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words, weighted by how often they occur.  For
each of SAMPLES places a word draws, from hashes of the word and the place, two
gamma(2, 1) values r, c and a uniform b.  With weight S it counts as
t = floor(ln S / r + b) steps, and its value is ln a = ln c - r (t + 1 - b).
The place keeps the word and step of the least value.  Two texts keep the
same pair with a probability equal to their generalised Jaccard similarity (sum
of the lesser over sum of the greater weights), so the share of equal places
estimates it.

A fingerprint is 4 hex digits of each place's pair; different pairs agree in
them once in 65,536.  Texts without words have a fingerprint of zeros.

``fingerprint_pairs`` also gives the likeness to the next document (descending
doc_id; after the last the first) and to an edited text whose last third comes
from it.  Documents are shuffled once into ranges of doc_id, whose bounds are
ids that occur; a bound's document also goes to the range before, where it is
the next of the last one.  So each task streams through its ranges in order.

Edge cases: null text is empty; two texts without words are alike (1.0), one
without and one with words are not (0.0); null doc_id comes after all others;
equal doc_ids follow each other in order of their text's hash; a single
document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, hash_strings, lean, mix, slices, small_batches

SAMPLES = 64
RANGE_BYTES = 4 << 20
#: Beyond so many ranges they grow instead (a task streams, it does not hold a range).
MOST_RANGES = 4096


def draws(words: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, b and ln c + r (b - 1) of each word hash for one place."""
    def unit(k: int, half: int):  # (0, 1), 32 bits of a hash
        h = mix(words + np.uint64((place * 3 + k) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        return ((h >> np.uint64(32 * half)).astype(np.uint32) + 0.5) * 2.0 ** -32, ((h >> np.uint64(32 - 32 * half)).astype(np.uint32) + 0.5) * 2.0 ** -32
    u1, u2 = unit(0, 1)
    u3, u4 = unit(1, 1)
    b, _ = unit(2, 1)
    r = -np.log(u1 * u2)
    return r, b, np.log(-np.log(u3 * u4)) + r * (b - 1)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """SAMPLES 16-bit values of each text (texts x places)."""
    w = Words(texts)
    out = np.zeros((len(texts), SAMPLES), np.uint16)
    if not len(w.codes):
        return out
    size = len(w.vocab)
    keys, tf = np.unique(w.doc * size + w.codes, return_counts=True)  # distinct words of each text
    doc, code = np.divmod(keys, size)
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    count = np.diff(np.concatenate((starts, [len(doc)])))
    logs, h = np.log(tf), hash_strings(w.vocab)
    many = np.flatnonzero(tf > 1)
    for place in range(SAMPLES):
        r, b, base = draws(h, place)
        value = base[code]
        step = np.floor(logs[many] / r[code[many]] + b[code[many]])
        value[many] -= r[code[many]] * step
        least = np.repeat(np.minimum.reduceat(value, starts), count)
        hit = np.flatnonzero(value == least)
        hit = hit[np.concatenate(([True], doc[hit][1:] != doc[hit][:-1]))]  # one of each text
        steps = np.zeros(len(tf), np.int64)
        steps[many] = step.astype(np.int64)
        out[doc[hit], place] = mix(h[code[hit]] + mix(steps[hit].astype(np.uint64) + np.uint64(place + 1))).astype(np.uint16)
    out[doc[starts]] |= np.uint16(1)  # never all zeros with words
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, nxt: str) -> str:
    """``text`` with its last third replaced by as much of ``nxt``'s beginning."""
    third = len(text) // 3
    return text[:len(text) - third] + nxt[:third]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last row so far, whose next is not known yet
    for batch in batches:
        t = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        batch = t.to_batches()[0]
        texts = batch.column("text").fill_null("")
        rng, marker = np.asarray(batch.column("range")), np.asarray(batch.column("marker"))
        for s, e in slices(texts.slice(0, len(texts) - 1)):
            own = texts.slice(s, e - s + 1)  # and the next one's text
            strings = own.to_pylist()
            changed = [edited(a, b) for a, b in zip(strings[:-1], strings[1:])]
            fp = fingerprints(own)
            fe = fingerprints(pa.array(changed, pa.string()))
            here = pa.array((rng[s:e] == rng[s + 1:e + 1]) & ~marker[s:e])
            digits = lambda x: pa.array([v.astype(">u2").tobytes().hex() for v in x], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(s, e - s), pa.array([len(x) for x in strings[:-1]], pa.int64()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed]), digits(fp[:-1]), digits(fe),
                 pa.array(likeness(fp[:-1], fe)), pa.array(likeness(fp[:-1], fp[1:]))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).filter(here)
        held = batch.slice(len(texts) - 1, 1)


def range_of(key: Column, bounds: list[int], block: int = 64) -> Column:
    """The last of the descending ``bounds`` that is not under ``key``."""
    some, every = F.lit(bounds[::block]), F.lit(bounds)
    part = F.size(F.filter(some, lambda x: x >= key)) - 1
    return part * block + F.size(F.filter(F.slice(every, part * block + 1, block), lambda x: x >= key)) - 1


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited form, and their likeness."""
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-2 ** 63)).alias("key"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, 1 + total // RANGE_BYTES)
    # bounds are ids of the table; one number per range reaches the driver
    shares = [i / ranges for i in range(1, ranges + 1)]
    found = d.agg(F.percentile_approx("key", F.lit(shares), 20 * ranges + 1000)).first()[0] or [0]
    bounds = sorted(set(found), reverse=True)
    own = range_of(F.col("key"), bounds)
    # a bound's document ends the range before; the first one ends the last range
    before = F.pmod(own - 1, F.lit(len(bounds)))
    rows = F.when(F.element_at(F.lit(bounds), own + 1) == F.col("key"), F.array(
        F.struct(own.alias("range"), F.lit(False).alias("marker")), F.struct(before.alias("range"), F.lit(True).alias("marker"))
    )).otherwise(F.array(F.struct(own.alias("range"), F.lit(False).alias("marker"))))
    d = d.withColumn("_r", F.explode(rows)).select("doc_id", "text", "key", "_r.range", "_r.marker")
    d = d.repartition("range").sortWithinPartitions("range", "marker", F.desc("key"), F.xxhash64("text"))
    return d.select("doc_id", "text", "range", "marker").mapInArrow(
        lean(_pairs), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")
