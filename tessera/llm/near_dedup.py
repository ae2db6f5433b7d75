"""Near-duplicate groups by SuperMinHash.

Sets: the distinct 5-word shingles of a text, A-Z lower-cased (fewer words:
the whole sequence as one shingle).  Documents are linked if the Jaccard
similarity of their sets is at least ``threshold`` percent; a component is all
that links reach.

1. One Arrow pass makes, per document, the set's size, a 128-bit key of the set
   and its SuperMinHash signature.  In SuperMinHash an element's ranks form a
   random permutation over the signature's places: step j gives it one value in
   [j, j+1) at the j-th place of its permutation.  A text stops at the first
   step whose values cannot lower any place, usually after one or two.
2. Documents with equal sets form a class; its smallest id stands for it.
3. Signatures are banded.  In each bucket two members (the pivots) are paired
   with the others, never all with all.  Pairs whose signatures allow a link are
   confirmed on full sets, and components are merged.
4. In what is left, every member outside a bucket's largest component meets
   every member of another component: blocks of them are compared by signature
   in vectorised steps.  Members whose signature allows a link in their block
   meet there again with their texts, and links are confirmed on full sets.
   Only members and links leave a task.  So no link between candidates is lost,
   and no list of pairs is made, whatever the size of a bucket.

Signatures that agree in fewer places than ``least_for`` says allow no link; a
pair at the threshold falls short of it once in 1e8.  So texts go only to where
a link is likely.

Bands have 4, 2 or 1 of the 112 places, by the threshold, so that a pair at it
shares no bucket with a probability below 1e-6 (28 bands of 4 at 0.85: 1e-9).
Shingles are compared as 64-bit hashes.

Edge cases: null or blank text: empty set, linked with nothing; a null doc_id
is linked with nothing, its component is null and it is kept; rows that share a
doc_id count as one document; an empty table gives an empty result; further
columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder, scratch_path
from .common import Words, gram_hashes, lean, mix, slices, small_batches, to_long, written
from .components import components

SHINGLE = 5
BANDS, ROWS = 28, 4
PLACES = BANDS * ROWS


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, lower=True)
    h = w.hashes()
    grams, out = gram_hashes(h, SHINGLE), []
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        n = b - a
        if n >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        else:  # salted by its length
            out.append(mix(gram_hashes(h[a:b], n) + np.uint64(n + 1)) if n else np.zeros(0, np.uint64))
    return out


def superminhash(doc: np.ndarray, h: np.ndarray, n_docs: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n_docs x places) of sets given as (doc, element hash) rows
    in order of doc.  A value is step * 2**32 + rank."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    sig = np.full(n_docs * places, np.iinfo(np.uint64).max, np.uint64)
    perm = None
    rows = np.arange(len(h))
    for step in range(places):
        u = mix(h + np.uint64((step * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF))
        k = step + (((u & low) * np.uint64(places - step)) >> half).astype(np.int64)
        if step == 0:
            place, first = k, k
        else:
            if perm is None:  # the elements of texts that are not done
                perm = np.tile(np.arange(places, dtype=np.uint8), (len(h), 1))
                perm[rows, first] = 0
                perm[rows, 0] = first
            place = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, step]
            perm[rows, step] = place
        np.minimum.at(sig, doc * places + place, (u >> half) + np.uint64(step << 32))
        open_docs = (sig.reshape(n_docs, places) >= np.uint64((step + 1) << 32)).any(axis=1)
        active = open_docs[doc]
        if not active.any():
            break
        if not active.all():
            doc, h, first = doc[active], h[active], first[active]
            perm = perm[active] if perm is not None else None
            rows = np.arange(len(h))
    return sig.reshape(n_docs, places)


def band_values(sig: np.ndarray) -> np.ndarray:
    """Four places as one long each: 16 bits of every place's value."""
    return np.ascontiguousarray(mix(sig.ravel()).astype(np.uint16).reshape(sig.shape)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b in slices(texts):
            sets = shingle_sets(texts.slice(a, b - a))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            doc = np.repeat(np.arange(len(sets)), sizes)
            bands = band_values(superminhash(doc, flat, len(sets)))
            ends = np.concatenate(([0], np.cumsum(sizes)))

            def total(x):  # wrapping sums per text
                c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
                return to_long(c[ends[1:]] - c[ends[:-1]])
            offsets = pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(sizes), total(mix(flat)), total(mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5))),
                 pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))],
                names=["doc_id", "n_shingles", "k1", "k2", "bands"])


def _confirm(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivots = None, []  # a doc_id with several rows gives several
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("a", "salt", "role", "v")}
            texts = batch.column("text")
            left, right = [], []
            for s, e in slices(texts):
                for i, own in zip(range(s, e), shingle_sets(texts.slice(s, e - s))):
                    here = (cols["a"][i], cols["salt"][i])
                    if cols["role"][i] == 0:
                        pivots = pivots + [own] if key == here else [own]
                        key = here
                    elif key == here and len(own) and any(len(p) and similar(p, own, threshold) for p in pivots):
                        left.append(cols["a"][i])
                        right.append(cols["v"][i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def confirm(pairs: DataFrame, texts: DataFrame, threshold: int, salts: int = 256) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full sets.  The
    partners of a are dealt to ``salts`` groups, and its text goes along once
    for each; a group streams past it."""
    p = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    rows = p.select("a", "salt", F.explode(F.array(F.struct(F.lit(0).alias("role"), F.col("a").alias("v")),
                                                   F.struct(F.lit(1).alias("role"), F.col("b").alias("v")))).alias("e"))
    rows = written(rows.select("a", "salt", "e.*").distinct(), "wanted")
    rows = rows.join(texts, "v").select("a", "salt", "role", "v", "text")
    return (rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
            .mapInArrow(lean(_confirm(threshold)), "a long, b long"))


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets are at least ``threshold`` percent alike."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    common = int((a[at] == b).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def rows_for(threshold: int) -> int:
    """Places of a band: as many as find a pair at the threshold but once in a million."""
    for rows in (4, 2, 1):
        if (1 - (threshold / 100) ** rows) ** (PLACES // rows) <= 1e-6:
            return rows
    raise ValueError(f"{PLACES} places cannot find pairs at a similarity of {threshold} %")


def least_for(threshold: int) -> float:
    """Share of places that a pair at the threshold falls short of once in 1e8
    (places agree independently at worst: these signatures vary less)."""
    s, below = threshold / 100, 0.0
    for k in range(PLACES + 1):
        below += math.comb(PLACES, k) * s ** k * (1 - s) ** (PLACES - k)
        if below > 1e-8:
            return k / PLACES
    return 1.0


MEMBER = ("bucket", "block", "role", "v", "n", "comp", "band")


def _runs(batch: pa.RecordBatch, per_band: int):
    """A batch's columns (m: one value per band) by block and role, with their bounds."""
    c = {n: np.asarray(batch.column(n)) for n in MEMBER}
    m = np.asarray(batch.column("bands").flatten(), dtype=np.int64).reshape(batch.num_rows, BANDS)
    c["m"] = m.view(f"u{2 * per_band}")
    cut = np.flatnonzero((np.diff(c["bucket"]) != 0) | (np.diff(c["block"]) != 0) | (np.diff(c["role"]) != 0)) + 1
    for s, e in zip([0, *cut], [*cut, batch.num_rows]):
        if s < e:
            yield s, e, {n: x[s:e] for n, x in c.items()}


def allowed(held: dict, i: int, part: dict, threshold: int, least: float) -> np.ndarray:
    """The rows of ``part`` that member i of ``held`` may be linked with."""
    own = held["m"][i]
    near = (part["m"].view(np.uint16) == own.view(np.uint16)).mean(axis=1) >= least
    small, big = np.minimum(part["n"], held["n"][i]), np.maximum(part["n"], held["n"][i])
    # a pair that shares several buckets is met in its first
    first = (part["m"] == own).argmax(axis=1) == part["band"]
    return np.flatnonzero(near & first & (part["comp"] != held["comp"][i]) & (100 * small >= threshold * big))


def _likely(threshold: int, least: float, per_band: int):
    """The members of each block (those outside the bucket's largest component
    come first) whose signature allows a link in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, hit = None, {}, np.zeros(0, bool)

        def rows_of(part: dict, own: np.ndarray) -> pa.RecordBatch:
            flat = np.ascontiguousarray(part["m"][own]).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(own.sum() + 1, dtype=np.int32) * BANDS), pa.array(flat))
            return pa.RecordBatch.from_arrays([*(pa.array(part[n][own]) for n in MEMBER), lists], names=[*MEMBER, "bands"])
        for batch in batches:
            for _, _, part in _runs(batch, per_band):
                here = (part["bucket"][0], part["block"][0])
                if part["role"][0] == 0:
                    if here == key:
                        held, hit = {n: np.concatenate((held[n], x)) for n, x in part.items()}, np.concatenate((hit, np.zeros(len(part["v"]), bool)))
                        continue
                    if hit.any():
                        yield rows_of(held, hit)
                    held, hit, key = part, np.zeros(len(part["v"]), bool), here
                elif here == key:
                    own = np.zeros(len(part["v"]), bool)
                    for i in range(len(hit)):
                        rows = allowed(held, i, part, threshold, least)
                        own[rows] = True
                        hit[i] |= len(rows) > 0
                    if own.any():
                        yield rows_of(part, own)
        if hit.any():
            yield rows_of(held, hit)
    return run


def _compare(threshold: int, least: float, per_band: int):
    """Links between the members of a bucket outside its largest component
    (they come first) and all its members: signatures first, then full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, sets = None, {}, []
        for batch in batches:
            texts, left, right = batch.column("text"), [], []
            for s, e, part in _runs(batch, per_band):
                if part["role"][0] == 0:
                    here = (part["bucket"][0], part["block"][0])
                    same_block = here == key
                    held = {n: np.concatenate((held[n], x)) if same_block else x for n, x in part.items()}
                    new = [x for a, b in slices(texts.slice(s, e - s)) for x in shingle_sets(texts.slice(s + a, b - a))]
                    sets, key = (sets + new if same_block else new), here
                    continue
                if (part["bucket"][0], part["block"][0]) != key:
                    continue
                hits = [allowed(held, i, part, threshold, least) for i in range(len(held["v"]))]
                wanted = np.unique(np.concatenate(hits))
                for a, b in slices(texts.take(pa.array(s + wanted))):
                    own_sets = dict(zip(wanted[a:b].tolist(), shingle_sets(texts.take(pa.array(s + wanted[a:b])))))
                    for i, rows in enumerate(hits):
                        for r in rows.tolist():
                            if r in own_sets and similar(sets[i], own_sets[r], threshold):
                                left.append(held["v"][i])
                                right.append(part["v"][r])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def in_blocks(m: DataFrame) -> DataFrame:
    return m.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "role")


def rest_links(m: DataFrame, docs: DataFrame, bands: DataFrame, threshold: int, rows: int, block: int = 512) -> DataFrame:
    """Links (a, b) between different components in one bucket.  Blocks of
    members outside the bucket's largest component meet all its members, with
    their signatures (``bands``: v, bands).  Where these allow a link, members
    meet again with their texts and are compared on full sets.  A block's second
    meeting has the pairs of the first, so it finds the same links as if all
    texts had been there."""
    sizes = m.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    top = (sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.sum("c").alias("all"),
                                       F.max("c").alias("c"))
           .where("all > c").select("bucket", "top", F.ceil((F.col("all") - F.col("c")) / block).alias("_n")))
    m = m.join(top, "bucket")
    minors = m.where("comp <> top").withColumns({"block": F.pmod(F.xxhash64("v"), F.col("_n")), "role": F.lit(0)})
    everyone = m.withColumns({"block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)), "role": F.lit(1)})
    met = written(minors.unionByName(everyone).select(*MEMBER), "met")
    how = threshold, least_for(threshold), rows
    types = "bucket long, block long, role int, v long, n long, comp long, band int, bands array<long>"
    met = written(in_blocks(met.join(bands, "v").select(*MEMBER, "bands")).mapInArrow(lean(_likely(*how)), types), "likely")
    met = met.join(texts_of(docs, met), "v").select(*MEMBER, "bands", "text")
    return in_blocks(met).mapInArrow(lean(_compare(*how)), "a long, b long").distinct()


def texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(v, text) of the documents that ``rows`` names by v."""
    wanted = written(rows.select(F.col("v").alias("doc_id")).distinct(), "wanted")  # its size is known to the join
    return written(docs.select("doc_id", "text").join(wanted, "doc_id").select(F.col("doc_id").alias("v"), "text"), "texts")


def likely_pairs(pairs: DataFrame, bands: DataFrame, threshold: int) -> DataFrame:
    """The ``pairs`` (a, b) whose signatures (``bands``: v, bands) allow a link."""
    same = " + ".join(f"if((shiftrightunsigned(x ^ y, {i}) & 65535L) = 0, 1, 0)" for i in range(0, 64, 16))
    agree = F.expr(f"aggregate(zip_with(_a, _b, (x, y) -> {same}), 0, (s, n) -> s + n)")
    a, b = (bands.select(F.col("v").alias(c), F.col("bands").alias(f"_{c}")) for c in ("a", "b"))
    return pairs.join(b, "b").join(a, "a").where(agree / PLACES >= least_for(threshold)).select("a", "b")


def _bands(rows: int):
    """The signature's bands of ``rows`` places, in the order they lie in memory."""
    bits = 16 * rows
    if bits == 64:
        return F.col("bands")
    return F.expr("flatten(transform(bands, x -> array({})))".format(
        ", ".join(f"shiftrightunsigned(x, {i}) & {(1 << bits) - 1}L" for i in range(0, 64, bits))))


def same_id_links(sigs: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """Links (a, b) between the classes of rows that share a doc_id."""
    own = sigs.where("n_shingles > 0 and doc_id is not null").select("doc_id", *key)
    ids = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("doc_id")
    met = own.join(ids, "doc_id").join(classes.select(*key, "v"), key).select("doc_id", "v").distinct()
    least = met.groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("z")).where("a <> z").select("doc_id", "a")
    return met.join(least, "doc_id").where("a <> v").select("a", F.col("v").alias("b")).distinct()


def near_groups(docs: DataFrame, threshold: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    rows = rows_for(threshold)
    small_batches(docs.sparkSession)
    sigs = written(docs.select("doc_id", "text").mapInArrow(
        lean(_signatures), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "signatures")
    key = ["n_shingles", "k1", "k2"]
    classes = written(sigs.where("n_shingles > 0 and doc_id is not null").groupBy(*key)
                      .agg(F.min("doc_id").alias("v"), F.first("bands").alias("bands")), "classes")

    # texts, members and links go when the components are there
    kept = scratch_path(docs.sparkSession, "components")
    with scratch_folder(docs.sparkSession, "pairs"):
        places = classes.select("v", F.col("n_shingles").alias("n"), F.posexplode(_bands(rows)).alias("band", "_value")).select(
            "v", "n", "band", F.xxhash64("band", "_value").alias("bucket"))
        # written, as the engine splits a hot bucket only in a join of two plain shuffles
        shared = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c"), F.min(F.struct("v", "n")).alias("lo"), F.max(F.struct("v", "n")).alias("hi"))
        shared = written(shared.where("_c > 1").select("bucket", F.when(F.col("_c") > 2, F.array("lo", "hi")).otherwise(F.array("lo")).alias("pivots")), "shared")
        members = written(places.join(shared, "bucket"), "members")
        bands = classes.select("v", "bands")
        met = members.select("v", "n", F.explode("pivots").alias("p"))
        pairs = written(met.where("v <> p.v and 100 * least(n, p.n) >= {t} * greatest(n, p.n)".format(t=threshold))
                        .select(F.col("p.v").alias("a"), F.col("v").alias("b")).distinct(), "pairs")
        pairs = written(likely_pairs(pairs, bands, threshold), "likely")
        texts = texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("v")))
        links = written(confirm(pairs, texts, threshold).union(same_id_links(sigs, classes, key)), "links")
        comps = components(links)
        # what is left: buckets whose members are not all of one component
        members = members.where("size(pivots) > 1").drop("pivots").join(comps, "v", "left")
        members = members.withColumn("comp", F.coalesce("root", "v")).drop("root")
        mixed = written(members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket"), "mixed")
        rest = written(members.join(mixed, "bucket"), "rest")
        more = written(rest_links(rest, docs, bands, threshold, rows), "more")
        if not more.isEmpty():
            comps = components(links.union(more))
        comps.write.parquet(kept)
    comps = docs.sparkSession.read.schema(comps.schema).parquet(kept)

    ids = classes.join(comps, "v", "left").withColumn("root", F.coalesce("root", "v")).select(*key, "root")
    out = sigs.select("doc_id", *key).join(ids, key, "left")
    own = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` without the rows that are not kept: one document of each group
    stays, and one row of a doc_id that has several (the least text's)."""
    groups = written(near_groups(docs, **kw).select("doc_id", "kept"), "groups")
    # written, so that the join knows its size: where it is small, the texts stay in place
    gone = written(groups.where("not kept").select("doc_id").distinct(), "gone")
    several = written(groups.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("doc_id"), "several")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.join(gone, "doc_id", "left_anti").select(*cols)
    if several.isEmpty():
        return left
    one = left.join(several, "doc_id", "left_semi").select("doc_id", F.struct(*cols).alias("_row"), F.struct("text", F.xxhash64(*cols)).alias("_by"))
    one = one.groupBy("doc_id").agg(F.min_by("_row", "_by").alias("_row")).select("_row.*")
    return left.join(several, "doc_id", "left_anti").select(*cols).unionByName(one.select(*cols))
