"""Near-duplicate groups by SimHash and deletion-variant signatures.

A fingerprint has 64 bits: bit i is set if it is set in over half the XXH64
values (seed 42) of the text's 3-word shingles, repeats included.  Fingerprints
that differ in at most two bits are linked.

Cut into two halves, two linked fingerprints have a half that differs by at most
one bit.  So every half is indexed under its 32 one-wildcard variants (one bit
left out): halves that differ by at most one bit share a variant.  Equal
fingerprints are merged first; members that meet under a variant are verified on
all 64 bits, inside the task, and only links that join something leave it.

A variant with more than ``limit`` different fingerprints is not compared all
with all.  Its members are indexed again, by what is left of the other half: the
496 variants with two bits left out where the first halves are equal, the 32
with one left out where they differ at the wildcard.  Sharing such a key is a
link, so every key gives links to its least member: exact, and linear in the
size of the group.

Edge cases: null or blank text: fingerprint zero, linked like any other; fewer
than three words: the whole sequence as one shingle; a null doc_id has the
smallest doc_id its fingerprint reaches (null if there is none); rows that share
a doc_id are rows of their own; an empty table gives an empty result; further
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, lean, slices, small_batches, written
from .components import components

SHINGLE, HALF, REACH = 3, 32, 2
LIMIT = 16_384


def shingle_hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, XXH64) of every shingle occurrence."""
    import xxhash
    n = len(w.codes)
    last = w.bounds[1:][w.doc] - np.arange(n)  # words from here to the text's end
    whole = np.flatnonzero(last >= SHINGLE)
    parts = [w.vocab.take(pa.array(w.codes[whole + k])) for k in range(SHINGLE)]
    grams = pc.binary_join_element_wise(*parts, " ")
    doc = w.doc[whole]
    few = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    short = [" ".join(w.vocab.take(pa.array(w.codes[w.bounds[d]:w.bounds[d + 1]])).to_pylist()) for d in few.tolist()]
    h = xxhash.xxh64_intdigest
    values = np.fromiter((h(g, 42) for a in (grams.cast(pa.binary()).to_pylist(), [s.encode() for s in short]) for g in a),
                         dtype=np.uint64, count=len(doc) + len(few))
    return np.concatenate((doc, few)), values


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text (unsigned)."""
    doc, h = shingle_hashes(Words(texts, lower=True))
    order = np.argsort(doc, kind="stable")
    doc, h = doc[order], h[order]
    total = np.bincount(doc, minlength=len(texts))
    ones = np.zeros((len(texts), 64), np.int64)
    for a in range(0, len(h), 1 << 18):  # bits of so many shingles at a time
        d, bits = doc[a:a + (1 << 18)], h[a:a + (1 << 18)].astype(">u8").view(np.uint8).reshape(-1, 8)
        first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        ones[d[first]] += np.add.reduceat(np.unpackbits(bits, axis=1), first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            fp = fingerprints(batch.column(1).slice(a, b - a))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def variants(classes: DataFrame) -> DataFrame:
    """``fp`` under its 64 one-wildcard variants: ``variant`` holds the half's
    number, the wildcard's place, and the half without that bit."""
    half = "if(i < 32, shiftrightunsigned(fp, 32), fp & 4294967295L)"
    return classes.select("fp", F.expr(f"explode(transform(sequence(0, 63), i -> "
                                       f"shiftleft(cast(i as bigint), 32) | ({half} & ~shiftleft(1L, i % 32))))").alias("variant"))


def joined_links(fp: np.ndarray) -> tuple[list[int], list[int]]:
    """Links between some different fingerprints: as many as join their groups."""
    root, left, right = list(range(len(fp))), [], []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    step, group = max(1, (1 << 20) // len(fp)), np.arange(len(fp))
    for s in range(0, len(fp), step):
        near = np.bitwise_count(fp[s:s + step, None] ^ fp[None, :]) <= REACH
        near &= group[s:s + step, None] != group[None, :]
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            a, b = find(s + i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(s + i)
                right.append(j)
        if near.any():
            group = np.array([find(i) for i in range(len(fp))])
    return left, right


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of variant; the group that a batch ends in is carried on."""
    held_v, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def groups(v, f):
        a, b = [], []
        cut = np.flatnonzero(np.r_[True, v[1:] != v[:-1]]) if len(v) else np.zeros(0, np.int64)
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(v)]):
            if e - s == 2:
                if np.bitwise_count(f[s:e].view(np.uint64)[0] ^ f[s:e].view(np.uint64)[1]) <= REACH:
                    a.append(f[s])
                    b.append(f[s + 1])
            elif e - s > 2:
                x, y = joined_links(f[s:e].view(np.uint64))
                a.extend(f[s:e][x])
                b.extend(f[s:e][y])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    for batch in batches:
        v = np.concatenate((held_v, np.asarray(batch.column("variant"))))
        f = np.concatenate((held_f, np.asarray(batch.column("fp"))))
        if not len(v):
            continue
        done = int(np.searchsorted(v, v[-1])) if v[0] != v[-1] else 0
        held_v, held_f = v[done:], f[done:]
        if done:
            yield groups(v[:done], f[:done])
    yield groups(held_v, held_f)


def crowded_links(members: DataFrame) -> DataFrame:
    """Links (a, b) under variants with very many members, by a second index."""
    first = "int(shiftrightunsigned(variant, 32))"
    other = f"if({first} < 32, fp & 4294967295L, shiftrightunsigned(fp, 32))"
    bit = f"(if({first} < 32, shiftrightunsigned(fp, 32), fp & 4294967295L) >> ({first} % 32)) & 1"
    # equal halves meet under every wildcard place: under the first one only
    two = (f"if({first} % 32 = 0, flatten(transform(sequence(1, 31), i -> transform(sequence(0, i - 1), j -> "
           f"named_struct('out', shiftleft(1L, i) | shiftleft(1L, j), 'own', {bit})))), "
           "cast(array() as array<struct<out: bigint, own: bigint>>))")
    one = "transform(sequence(0, 31), i -> named_struct('out', shiftleft(1L, i), 'own', 2L))"
    keys = members.select("variant", "fp", F.expr(f"explode(concat({two}, {one}))").alias("k"))
    keys = keys.select("variant", "fp", "k.out", "k.own", F.expr(f"({other}) & ~k.out").alias("rest"))
    names = ["variant", "out", "own", "rest"]
    least = keys.groupBy(*names).agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").drop("z")
    return keys.join(least, names).where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def simhash_groups(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs``."""
    small_batches(docs.sparkSession)
    fps = written(docs.select("doc_id", "text").mapInArrow(lean(_fingerprint), "doc_id long, fp long"), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    rows = variants(classes)
    shared = rows.groupBy("variant").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # written, so that the engine can split a hot variant in the join of two plain shuffles
    shared = written(shared, "shared")
    members = written(rows.join(shared, "variant"), "members")
    small = members.where(F.col("size") <= limit).select("variant", "fp")
    links = small.repartition("variant").sortWithinPartitions("variant", "fp").mapInArrow(lean(_verify), "a long, b long")
    crowded = members.where(F.col("size") > limit)
    if not crowded.isEmpty():
        links = links.union(crowded_links(crowded.select("variant", "fp")))
    comps = components(links.distinct())
    roots = written(classes.join(comps, classes["fp"] == comps["v"], "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    out = fps.join(roots.join(least, "root").select("fp", "component_id"), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
