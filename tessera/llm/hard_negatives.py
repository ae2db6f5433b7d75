"""Hard negatives by anchor-clustered shared lists.

Scores are integer inner products of ``floor(256 * x)`` vectors.  Anchors are
grouped by direction (spherical k-means).  For a cluster with centre c and
largest angle b between c and a member, no member a can score more with a row x
than ``|a| |x| cos(max(0, angle(x, c) - b))``.  Rows are sorted by that bound
once per cluster, and every member walks the shared list in steps until no row
left can enter its result: the bound is below its fifth best score, or below
the least score it admits.  Then it stops; the result is exact.

The work is dealt out as blocks of anchors (whole clusters, 1,024 rows) against
chunks of all rows (8,192): a task holds one of each, finds the best five of its
chunk for its members, and an aggregation merges them.  Two passes: positives
first, whose scores give the ranges in which negatives are looked for.

Only the directions of the clusters are fitted, on at most ``sample`` anchors
(8,192); they steer how early a walk ends, never what it finds.

Edge cases: rows with a null vec_id, label or vector, or a null or non-finite
component take no part; every other row counts as a row of its own, equal rows
and rows that share a vec_id too, and an anchor row is no partner of itself;
vectors shorter than others count as ended by zeros, an empty one as zero;
scores beyond 64 bits are cut to the largest long; ties go by vec_id; an anchor
without positives, or a positive with a score below 0, has no negatives; an
empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import small_batches, written

BLOCK, CHUNK, STEP = 1024, 8192, 512
BEST = 5
MOST_CLUSTERS = 256
SLACK = 1e-7  # of a cosine: more than what rounding can change


def matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors as rows of whole numbers, ended by zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = np.asarray(vectors.value_lengths().fill_null(0), dtype=np.int64)
    out = np.zeros((len(n), max(int(n.max(initial=0)), width or 0)))
    out[np.arange(out.shape[1]) < n[:, None]] = np.floor(256 * np.asarray(vectors.flatten(), dtype=np.float64))
    return out


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def directions(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from k rows that lie far from each other."""
    u, _ = units(x)
    centres, near = u[:1], u @ u[0]
    while len(centres) < min(k, len(u)):
        far = int(near.argmin())
        centres = np.vstack((centres, u[far]))
        near = np.maximum(near, u @ u[far])
    for _ in range(rounds):
        own = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, u)
        moved, norm = units(sums)
        centres = np.where(norm[:, None] > 0, moved, centres)
    return centres


def walk(anchors: np.ndarray, own_label: np.ndarray, own_row: np.ndarray, cluster: np.ndarray, ent: np.ndarray,
         lo: np.ndarray, hi: np.ndarray, same: bool, x: np.ndarray, label: np.ndarray, row: np.ndarray, ids: np.ndarray):
    """The best rows of ``x`` for each entry: entry i looks, for anchor
    ``ent[i]``, among rows of the same or of other labels for scores from lo[i]
    to hi[i].  Returns (entry, score, place in x, rows looked at)."""
    ua, na = units(anchors)
    ux, nx = units(x)
    kind = np.float64 if na.max(initial=0) * nx.max(initial=0) < 2.0 ** 52 else np.longdouble  # exact to 2**63
    anchors, x = anchors.astype(kind), x.astype(kind)
    fifth = np.full(len(ent), -np.inf, dtype=kind)
    got_e, got_s, got_i = np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64)
    looked = 0
    for c in np.unique(cluster):
        members = np.flatnonzero(cluster == c)
        centre, _ = units(ua[members].sum(axis=0, keepdims=True))
        widest = np.arccos(np.clip(ua[members] @ centre[0], -1, 1)).max()
        angle = np.arccos(np.clip(ux @ centre[0], -1, 1))
        bound = nx * (np.cos(np.maximum(0, angle - widest)) + SLACK)
        order = np.argsort(-bound, kind="stable")  # the list all members share
        live = np.flatnonzero((cluster[ent] == c) & (lo <= hi))
        for s in range(0, len(order), STEP):
            live = live[na[ent[live]] * bound[order[s]] + 1e-6 >= np.maximum(fifth[live], lo[live])]
            if not len(live):
                break
            at = order[s:s + STEP]
            who, back = np.unique(ent[live], return_inverse=True)
            looked += len(who) * len(at)
            score = anchors[who] @ x[at].T
            fits = (own_label[who][:, None] == label[at]) == same
            fits &= own_row[who][:, None] != row[at]
            score = np.where(fits, score, -np.inf)[back]
            e, i = np.nonzero((score >= np.maximum(fifth[live], lo[live])[:, None]) & (score <= hi[live][:, None]) & fits[back])
            if not len(e):
                continue
            all_e, all_s = np.concatenate((got_e, live[e])), np.concatenate((got_s, score[e, i]))
            all_i = np.concatenate((got_i, at[i]))
            rank = np.lexsort((row[all_i], ids[all_i], -all_s, all_e))
            all_e, all_s, all_i = all_e[rank], all_s[rank], all_i[rank]
            first = np.flatnonzero(np.r_[True, all_e[1:] != all_e[:-1]])
            nth = np.arange(len(all_e)) - np.repeat(first, np.diff(np.r_[first, len(all_e)]))
            last = nth == BEST - 1
            fifth[all_e[last]] = all_s[last]
            keep = nth < BEST
            got_e, got_s, got_i = all_e[keep], all_s[keep], all_i[keep]
    return got_e, got_s, got_i, looked


def _walks(same: bool):
    names = ["anchor", "nth", "score", "id", "row"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int32() if n == "nth" else pa.int64()) for n in names})
        a = matrix(left["embedding"])
        x = matrix(right["embedding"], a.shape[1])
        a = np.pad(a, ((0, 0), (0, x.shape[1] - a.shape[1])))
        num = lambda t, n: np.asarray(t[n].combine_chunks(), dtype=np.int64)
        own = num(left, "row")
        if same:
            ent = nth = np.arange(len(own))
            nth, lo, hi = np.zeros(len(own), np.int64), np.full(len(own), -np.inf), np.full(len(own), np.inf)
        else:
            top = left["scores"].combine_chunks()
            n = np.asarray(top.value_lengths(), dtype=np.int64)
            ent = np.repeat(np.arange(len(own)), n)
            nth = np.arange(len(ent)) - np.repeat(np.cumsum(n) - n, n)
            hi = np.asarray(top.flatten(), dtype=np.int64)
            lo = hi - hi // 5  # the least n with 80 * hi <= 100 * n
            lo, hi = lo.astype(np.longdouble), hi.astype(np.longdouble)
        e, s, i, _ = walk(a, num(left, "label"), own, num(left, "cluster"), ent, lo, hi, same,
                          x, num(right, "label"), num(right, "row"), num(right, "vec_id"))
        most = np.iinfo(np.int64).max
        whole = np.array([min(max(int(v), -most), most) for v in s.tolist()] if s.dtype != np.float64 else s, dtype=np.int64)
        return pa.table({"anchor": own[ent[e]], "nth": pa.array(nth[e], pa.int32()), "score": whole,
                         "id": num(right, "vec_id")[i], "row": num(right, "row")[i]})
    return run


def usable(rows: DataFrame) -> DataFrame:
    """row, vec_id, label and embedding of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("bigint")
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
                    F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding"))


def clustered(anchors: DataFrame, n: int, sample: int) -> tuple[DataFrame, int]:
    """Anchors with their cluster and block, and the number of blocks."""
    spark = anchors.sparkSession
    some = anchors.orderBy(F.xxhash64("vec_id", "row")).limit(sample).select("embedding").toArrow()
    centres = directions(matrix(some["embedding"]), min(MOST_CLUSTERS, -(-n // 64)))

    def nearest(batches):
        for b in batches:
            u = matrix(b.column("embedding"), centres.shape[1])
            own = (u[:, :centres.shape[1]] @ centres.T).argmax(axis=1) if b.num_rows else np.zeros(0)
            yield b.append_column("cluster", pa.array(own, pa.int32()))
    found = written(anchors.mapInArrow(nearest, StructType([*anchors.schema, StructField("cluster", IntegerType())])), "anchors")
    plan, block, used = [], 0, 0
    for r in found.groupBy("cluster").count().orderBy("cluster").collect():  # MOST_CLUSTERS rows at most
        pieces = -(-r["count"] // BLOCK)
        if used and (pieces > 1 or used + r["count"] > BLOCK):
            block, used = block + 1, 0
        plan.append((r["cluster"], block, pieces))
        if pieces > 1:
            block += pieces
        else:
            used += r["count"]
    blocks = block + (1 if used else 0)
    plan = spark.createDataFrame(plan, "cluster int, _first int, _pieces int")
    found = found.join(F.broadcast(plan), "cluster").withColumn(
        "block", (F.col("_first") + F.pmod(F.xxhash64("row"), F.col("_pieces"))).cast("int")).drop("_first", "_pieces")
    return found, blocks


def best(anchors: DataFrame, rows: DataFrame, blocks: int, chunks: int, same: bool) -> DataFrame:
    """anchor, nth, rank, id and score of the best rows of each entry."""
    left = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = rows.withColumns({"chunk": F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"),
                              "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    met = (left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
           .applyInArrow(_walks(same), "anchor long, nth int, score long, id long, row long"))
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id", "row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def hard_negatives(rows: DataFrame, every: int = 100, sample: int = 8192) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its first
    five positives: the first five rows of other labels whose score lies between
    four fifths of the positive's and the positive's."""
    spark = rows.sparkSession
    small_batches(spark)
    rows = written(usable(rows), "vectors")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], schema)
    anchors, blocks = clustered(rows.where(F.col("vec_id") % every == 0), n_anchors, sample)
    chunks = -(-n // CHUNK)
    tops = best(anchors, rows, blocks, chunks, True).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("top"))
    with_top = written(anchors.join(tops, anchors["row"] == tops["anchor"]).drop("anchor")
                       .withColumn("scores", F.col("top.score")), "positives")
    found = best(with_top.drop("top"), rows, blocks, chunks, False).select("anchor", "nth", "rank", "id", "score")
    own = with_top.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"),
                          F.posexplode("top").alias("nth", "p"))
    return own.join(found, ["anchor", "nth"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
