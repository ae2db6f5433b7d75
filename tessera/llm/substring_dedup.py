"""Removal of repeated passages by prefix-partitioned suffix trees.

A window of WINDOW consecutive words that starts in two places is repeated;
every word that some repeated window covers is removed, in all its places.

Only suffixes that can matter are sorted.  In each window the 18-word gram
with the least hash is its anchor: equal windows have equal anchors at equal
offsets, so a window whose anchor gram occurs once is not repeated.

1. One pass lists the anchors: gram, document, the run of windows that the
   anchor serves, and a hash of the words these windows span.  An aggregation
   finds the grams that occur twice or more, a join the anchors that have them.
2. Equal spans are one leaf with a multiplicity, counted map-side, so a passage
   in a third of all documents is a few rows from here on.
3. The gram is the prefix that splits suffixes into groups.  A prefix with more
   than GROUP leaves is lengthened word by word until its groups fit in memory;
   all lengths are counted in one aggregation.  A window that ends inside the
   lengthened prefix has no words below it and is a leaf by itself: its leaves'
   multiplicities are summed map-side.
4. Each group's leaves meet with the words around the anchor.  The suffixes that
   follow the gram are sorted; runs whose longest common prefix reaches a depth
   are the subtree's internal nodes.  A node deep enough that, with the same
   words to the left, it spans WINDOW words marks a repeat if it has two leaves
   or one of multiplicity two.
5. The marks of a leaf go to all its places.

Joins of places with grams are salted for the grams with more than one in
HEAVY of all anchors; there are fewer than HEAVY of them, so they are broadcast.

Words and grams are compared as 32- and 64-bit hashes: windows of the same
gram and neighbours that differ in one word are taken as equal with a
probability of 2**-32.

The texts are shuffled by document, once for leaves and removal, and once more
where some prefix is too large.

Edge cases: null text is empty; texts shorter than a window lose nothing;
rows repeated whole are occurrences of their own, so they lose all words that
windows cover; null or repeated doc_id is allowed (each row is judged on its
own text); an empty table gives an empty result; ``remove_repeats`` returns the
input's columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, gram_hashes, lean, mix, slices, small_batches, to_long, written

WINDOW = 35
GRAM = 18
SIDE = WINDOW - GRAM  # words of a window beside its anchor gram
GROUP = 10_000  # leaves that a task holds at once
HEAVY = 10_000
SALTS = 64


def anchors_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's gram hashes: the anchors' positions, and the first and
    last window start that each serves."""
    if len(grams) <= SIDE:
        none = np.zeros(0, np.int64)
        return none, none, none
    view = np.lib.stride_tricks.sliding_window_view(grams, SIDE + 1)
    at = view.argmin(axis=1) + np.arange(len(view))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return at[first], first, last


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("d").field("text")


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, rids, texts = np.asarray(batch.column("k")), np.asarray(batch.column("rid")), batch.column("text")
        for s, e in slices(texts):
            w = Words(texts.slice(s, e - s))
            h = w.hashes()
            grams, windows, out = gram_hashes(h, GRAM), gram_hashes(h, WINDOW), []
            for i, (a, b) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist())):
                if b - a >= WINDOW:
                    at, first, last = anchors_of(grams[a:b - GRAM + 1])
                    # the first and the last window overlap: together they are the span
                    span = mix(mix(windows[a + first] + (last - first).astype(np.uint64)) + windows[a + last])
                    # a word repeated without end: neighbouring equal windows are one row
                    own = np.flatnonzero(np.concatenate(([True], (span[1:] != span[:-1]) | (last[1:] != first[1:]) | (last[:-1] != first[:-1]))))
                    run = np.diff(np.concatenate((own, [len(at)])))
                    out.append((grams[a + at[own]], span[own], np.full(len(own), keys[s + i]), np.full(len(own), rids[s + i]),
                                first[own], (last - first)[own], run))
            if out:
                g, span, k, rid, first, n, run = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([to_long(g), to_long(span), pa.array(k), pa.array(rid), pa.array(first.astype(np.int32)),
                                                  pa.array(n.astype(np.int8)), pa.array(run.astype(np.int32))],
                                                 names=["gram", "span", "k", "rid", "first", "n", "run"])


def _leaves(batch: pa.RecordBatch):
    """(word hashes, gram hashes, anchors, window ranges, the list's rows) of
    the rows that stand for leaves."""
    texts, lists, rid = _texts(batch), batch.column("leaves"), np.asarray(batch.column("rid"))
    for s, e in slices(texts):
        w = Words(texts.slice(s, e - s))
        h = w.hashes()
        for i in range(s, e):
            leaves = lists[i].values
            leaves = leaves.filter(pa.array(np.asarray(leaves.field("rid")) == rid[i]))
            if not len(leaves):
                continue
            own = h[w.bounds[i - s]:w.bounds[i - s + 1]]
            grams = gram_hashes(own, GRAM)
            at, first, last = anchors_of(grams)
            wanted = np.asarray(leaves.field("first"))
            here = np.isin(wanted, first)  # but for another text of this doc_id with the same 32-bit hash
            if here.any():
                by = np.searchsorted(first, wanted[here])
                yield own, grams, at[by], first[by], last[by], leaves.filter(pa.array(here))


def _around(own: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SIDE words to the left and to the right of the grams at ``at`` as 32-bit
    hashes (0 beyond the text's ends)."""
    offsets = np.concatenate((np.arange(-SIDE, 0), np.arange(GRAM, GRAM + SIDE)))
    short = np.concatenate((np.zeros(SIDE, np.uint32), mix(own).astype(np.uint32), np.zeros(SIDE, np.uint32)))
    return short[(at + SIDE)[:, None] + offsets]


def prefixes(gram: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """Column j: a hash of the gram and the j words to its right."""
    out = [gram]
    for j in range(SIDE):
        out.append(mix(out[-1] + ctx[:, SIDE + j].astype(np.uint64) + np.uint64(1)))
    return np.stack(out, axis=1)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes of each leaf, by number of words beyond the gram."""
    for batch in batches:
        for own, grams, at, _, _, leaves in _leaves(batch):
            keys = prefixes(grams[at], _around(own, at))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * (SIDE + 1)), to_long(keys.ravel()))
            yield pa.RecordBatch.from_arrays([to_long(grams[at]), leaves.field("span"), lists], names=["gram", "span", "path"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves with the words around them, under their group's prefix.  Windows
    that end inside the prefix are left out."""
    for batch in batches:
        out = []
        for own, grams, at, first, last, leaves in _leaves(batch):
            ctx, depth = _around(own, at), np.asarray(leaves.field("depth"))
            key = prefixes(grams[at], ctx)[np.arange(len(at)), np.minimum(depth, SIDE)]
            lo, hi = at - last, np.minimum(at - first, SIDE - depth)
            has = lo <= hi
            out.append([x[has] for x in (key, grams[at], np.asarray(leaves.field("span")), np.asarray(leaves.field("c")), lo, hi, ctx)])
        if out:
            key, g, span, c, lo, hi, ctx = (np.concatenate(x) for x in zip(*out))
            width = ctx.shape[1] * 4
            data = pa.Array.from_buffers(pa.binary(), len(ctx), [None, pa.py_buffer((np.arange(len(ctx) + 1) * width).astype(np.int32)),
                                                                 pa.py_buffer(np.ascontiguousarray(ctx))])
            yield pa.RecordBatch.from_arrays([to_long(key), to_long(g), pa.array(span), pa.array(c), pa.array(lo.astype(np.int8)),
                                              pa.array(hi.astype(np.int8)), data],
                                             names=["key", "gram", "span", "c", "lo", "hi", "ctx"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that end inside their group's prefix."""
    for batch in batches:
        out = []
        for own, grams, at, first, last, leaves in _leaves(batch):
            depth = np.asarray(leaves.field("depth"))
            least, hi = np.maximum(at - last, SIDE - depth + 1), at - first
            n = np.maximum(hi - least + 1, 0)
            row = np.repeat(np.arange(len(at)), n)
            if len(row):
                o = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + least[row]
                out.append((gram_hashes(own, WINDOW)[at[row] - o], grams[at[row]], np.asarray(leaves.field("span"))[row],
                            np.asarray(leaves.field("c"))[row], (at - last)[row], 1 << o))
        if out:
            win, g, span, c, lo, mask = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([to_long(win), to_long(g), pa.array(span), pa.array(c), pa.array(lo.astype(np.int8)),
                                              pa.array(mask)], names=["win", "gram", "span", "c", "lo", "mask"])


def repeated_offsets(gram: np.ndarray, lo: np.ndarray, hi: np.ndarray, ctx: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Bit o of a leaf's result: the window that starts o words before its
    anchor is repeated, by another leaf of its node or by the leaf's own
    multiplicity (``many``).  Leaves of a gram, or longer prefix, are all here."""
    n = len(gram)
    left, right = ctx[:, :SIDE], ctx[:, SIDE:]
    order = np.lexsort(tuple(right[:, c] for c in reversed(range(SIDE))) + (gram,))
    gram, lo, hi, left, right, many = gram[order], lo[order], hi[order], left[order], right[order], many[order]
    # longest common prefix of neighbours, -1 between subtrees
    same = np.concatenate((right[1:] == right[:-1], np.zeros((n - 1, 1), bool)), axis=1)
    lcp = np.where(gram[1:] == gram[:-1], same.argmin(axis=1), -1)
    mask, back = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    for o in range(SIDE + 1):
        if o:  # one more word to the left
            back = mix(back + left[:, SIDE - o].astype(np.uint64) + np.uint64(1))
        node = np.concatenate(([0], np.cumsum(lcp < SIDE - o)))  # the internal node at this depth
        here = np.flatnonzero((lo <= o) & (o <= hi))
        key = mix(mix(node[here].astype(np.uint64)) + back[here])
        by = np.argsort(key)
        twice = key[by][1:] == key[by][:-1]
        hit = many[here].copy()
        hit[by[1:]] |= twice
        hit[by[:-1]] |= twice
        mask[here[hit]] |= 1 << o
    out = np.empty(n, np.int64)
    out[order] = mask
    return out


def _trees(batches: Iterator[pa.RecordBatch], least: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Rows come in order of key; whole groups are handled together."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        t = table.combine_chunks()
        ctx = np.frombuffer(b"".join(t["ctx"].to_pylist()), np.uint32).reshape(t.num_rows, 2 * SIDE)
        mask = repeated_offsets(t["key"].to_numpy(), t["lo"].to_numpy(), t["hi"].to_numpy(), ctx, t["c"].to_numpy() > 1)
        hit = pa.array(mask != 0)
        cols = [pa.array(t[c].to_numpy()).filter(hit) for c in ("gram", "span", "lo")]
        return pa.RecordBatch.from_arrays([*cols, pa.array(mask).filter(hit)], names=["gram", "span", "lo", "mask"])
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            t = pa.Table.from_batches(held)
            keys = t["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if cut:
                yield solve(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                rows -= cut
    if rows:
        yield solve(pa.Table.from_batches(held))


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, rid, found = _texts(batch), np.asarray(batch.column("rid")), batch.column("found")
        out, total, gone = [], [], []
        for s, e in slices(texts):
            for i, text in zip(range(s, e), texts.slice(s, e - s).to_pylist()):
                words = (text or "").encode().split()  # bytes: ASCII white space alone
                total.append(len(words))
                f = found[i].values
                if f is not None and len(f):
                    own = np.asarray(f.field("rid")) == rid[i]
                    pos, mask = np.asarray(f.field("pos"))[own].astype(np.int64), np.asarray(f.field("mask"))[own]
                    run = np.asarray(f.field("run"))[own].astype(np.int64)
                    edge = np.zeros(len(words) + 1, np.int64)
                    for o in range(SIDE + 1):
                        hit = (mask >> o) & 1 == 1
                        np.add.at(edge, pos[hit] - o, 1)
                        np.add.at(edge, pos[hit] - o + run[hit] - 1 + WINDOW, -1)
                    words = [w for w, c in zip(words, np.cumsum(edge).tolist()) if not c]
                gone.append(total[-1] - len(words))
                out.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(out, pa.string()), pa.array(total, pa.int64()),
                                          pa.array(gone, pa.int64())], names=["d", "kept_text", "n_words", "n_removed"])


def _salt(df: DataFrame, heavy: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``salt``: one of SALTS values for heavy grams, 0 for the others."""
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(*by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    return df.join(F.broadcast(heavy), "gram", "left").withColumn("salt", salt).drop("_heavy")


def _every_salt(df: DataFrame, heavy: DataFrame) -> DataFrame:
    salts = F.sequence(F.lit(0), F.when(F.col("_heavy"), F.lit(SALTS - 1)).otherwise(F.lit(0)))
    return df.join(F.broadcast(heavy), "gram", "left").withColumn("salt", F.explode(salts)).drop("_heavy")


def _join_large(df: DataFrame, large: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``large``: keys of over GROUP
    rows each, so few that all of them can be there once a salt."""
    every = large.select(key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).join(every, [key, "salt"]).drop("salt")


def _listed(docs: DataFrame, spans: DataFrame, name: str) -> DataFrame:
    """The documents in which the first place of a leaf is, with these leaves."""
    leaf = F.struct("at.rid", "at.first", "span", F.least("c", F.lit(2)).cast("byte").alias("c"), F.col("depth").cast("byte").alias("depth"))
    lists = spans.groupBy(F.col("at.k").alias("k")).agg(F.collect_list(leaf).alias("leaves"), F.max("depth").alias("deepest"))
    return docs.join(written(lists, name), "k")


def _depths(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans`` with ``depth``: the words by which the leaf's prefix is longer
    than its gram.  A depth beyond SIDE leaves no window to a tree."""
    large = written(spans.groupBy("gram").agg(F.count(F.lit(1)).alias("g")).where(F.col("g") > GROUP).select("gram"), "large")
    if large.isEmpty():
        return spans.withColumn("depth", F.lit(0))
    split = _join_large(spans.withColumn("depth", F.lit(0)), large, "gram", ["span"])
    paths = written(_listed(docs, split, "split").mapInArrow(lean(_paths), "gram long, span long, path array<long>"), "paths")
    steps = paths.select("gram", "span", F.posexplode("path").alias("depth", "key"))
    over = written(steps.groupBy("key").agg(F.count(F.lit(1)).alias("g")).where(F.col("g") > GROUP).select("key"), "prefixes")
    depth = _join_large(steps, over, "key", ["span"]).groupBy("gram", "span").agg((F.max("depth") + 1).alias("depth"))
    return written(spans.join(depth, ["gram", "span"], "left").withColumn("depth", F.coalesce("depth", F.lit(0))), "depths")


def repeats_removed(docs: DataFrame) -> DataFrame:
    """(d, kept_text, n_words, n_removed) of every row; d is the row itself."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("k"), F.hash("text").alias("rid"))
    anchors = written(docs.select("k", "rid", F.col("d.text").alias("text")).mapInArrow(
        lean(_anchors), "gram long, span long, k long, rid int, first int, n byte, run int"), "anchors")
    shared = written(anchors.groupBy("gram").agg(F.sum("run").alias("c"), F.count(F.lit(1)).alias("rows")).where("c > 1"), "grams")
    least = anchors.count() // HEAVY  # fewer than HEAVY grams have more rows than this
    heavy = written(shared.where((F.col("rows") > least) & (F.col("rows") > GROUP)).select("gram", F.lit(True).alias("_heavy")), "heavy")
    cand = written(_salt(anchors, heavy, ["k", "rid", "first"]).join(_every_salt(shared.select("gram"), heavy), ["gram", "salt"]), "candidates")
    spans = written(cand.groupBy("gram", "span").agg(F.sum("run").alias("c"), F.min(F.struct("k", "rid", "first")).alias("at")), "spans")
    near = _listed(docs, _depths(docs, spans), "leaves")
    trees = (near.mapInArrow(lean(_contexts), "key long, gram long, span long, c byte, lo byte, hi byte, ctx binary")
             .repartition("key").sortWithinPartitions("key").mapInArrow(lean(_trees), "gram long, span long, lo byte, mask long"))
    # windows inside lengthened prefixes: counted map-side, and looked up under a salt, as one may have very many leaves
    wins = near.where("deepest > 0").mapInArrow(lean(_windows), "win long, gram long, span long, c byte, lo byte, mask long")
    twice = wins.groupBy("win").agg(F.sum("c").alias("n")).where("n > 1").select("win")
    twice = twice.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    inner = wins.withColumn("salt", F.pmod(F.xxhash64("span"), F.lit(SALTS)).cast("int")).join(twice, ["win", "salt"])
    marks = trees.unionByName(inner.select("gram", "span", "lo", "mask"))
    marks = marks.groupBy("gram", "span").agg(F.max("lo").alias("lo"), F.bit_or("mask").alias("mask"))
    # bit o is the window that starts o words before pos, the anchor, and run - 1 windows follow it
    found = cand.join(_every_salt(marks, heavy), ["gram", "span", "salt"]).select(
        "k", "rid", (F.col("first") + F.col("n") + F.col("lo")).alias("pos"), "mask", "run")
    found = found.groupBy("k").agg(F.collect_list(F.struct("rid", "pos", "mask", "run")).alias("found"))
    schema = docs.select("d").schema.add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    return docs.join(found, "k", "left").select("k", "d", "rid", "found").mapInArrow(lean(_keep), schema)


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the kept text of every row."""
    return repeats_removed(docs.select("doc_id", "text")).select(
        "d.doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words that are kept as text; n_chars follows where
    there is such a column.  A text without repeats stays as it is, and a
    document that loses all its words goes."""
    out = repeats_removed(docs).where("n_removed = 0 or n_words > n_removed")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("d.text"))
    cols = {c: F.col("d").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("bigint")).otherwise(F.col("d.n_chars"))
    return out.select(*[v.alias(c) for c, v in cols.items()])
