"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 64-bit hashes; a key belongs to
the first point clockwise.  No shard takes more keys than its capacity: keys of
an arc whose shard is full go on clockwise to the next shard with room.  With
``slack`` 0 the capacities differ by one at most and add up to the number of
keys, so all shards end equally full; a larger slack moves fewer keys when
shards are added.

Which keys overflow depends on counts alone: keys of one arc have the same way
round the ring.  So the plan is made from one count per arc (shards x vnodes
rows, whatever the input), and each key joins its arc's segment by its rank in
the arc.  Ranks come from cells; no task holds an arc.  They follow a hash of
the row's values, so a table's files and partitions have no say in where a row
goes: rows alike in all values are interchangeable, others have their place.

Edge cases: a null doc_id is placed by its text; null text has size 16 and the
checksum of the empty text; repeated rows are keys of their own, placed like
others of their arc; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, small_batches
from .ranks import numbered_copies, rank_in_group


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Points in ascending order and the shard of each.  A shard's points
    depend on its number alone, so more shards leave the others' in place."""
    shard = np.repeat(np.arange(shards), vnodes)
    point = mix(mix(shard.astype(np.uint64) + np.uint64(1)) + np.tile(np.arange(vnodes, dtype=np.uint64), shards))
    order = np.lexsort((shard, point))
    return point[order], shard[order]


def capacities(keys: int, natural: list[int], slack: float) -> list[int]:
    """Most keys of each shard; with no slack they add up to ``keys``."""
    n = len(natural)
    if slack > 0:
        return [int(-(-keys * (1 + slack) // n))] * n
    base, more = divmod(keys, n)
    first = sorted(range(n), key=lambda s: (-natural[s], s))[:more]
    return [base + (s in set(first)) for s in range(n)]


def segments(counts: dict[int, int], owner: list[int], shards: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): where keys of each arc go."""
    natural = [0] * shards
    for arc, c in counts.items():
        natural[owner[arc]] += c
    room = capacities(sum(counts.values()), natural, slack)
    used, out, over = [0] * shards, [], []

    def place(arc: int, rank: int, n: int, shard: int) -> int:
        take = min(n, room[shard] - used[shard])
        if take > 0:
            out.append((arc, rank, rank + take, shard, used[shard]))
            used[shard] += take
        return max(take, 0)
    for arc in sorted(counts):  # at home first
        took = place(arc, 0, counts[arc], owner[arc])
        if took < counts[arc]:
            over.append((arc, took, counts[arc] - took))
    for arc, rank, left in over:  # then clockwise
        at = arc
        while left:
            at = (at + 1) % len(owner)
            took = place(arc, rank, left, owner[at])
            rank, left = rank + took, left - took
    return out


def sharded(docs: DataFrame, shards: int, vnodes: int = 64, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    small_batches(docs.sparkSession)
    point, owner = ring(shards, vnodes)

    @F.pandas_udf("int")
    def arc_of(h: pd.Series) -> pd.Series:
        # a key's own point on the ring, then the first node at or after it
        at = np.searchsorted(point, mix(h.to_numpy().astype(np.int64).view(np.uint64)))
        return pd.Series((at % len(point)).astype(np.int32))
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = docs.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
                       F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64(F.col("doc_id").cast("string"))).alias("_h"))
    keys = numbered_copies(keys.withColumn("arc", arc_of("_h")).drop("_h"))
    counts = {r["arc"]: r["count"] for r in keys.groupBy("arc").count().collect()}  # one row per arc at most
    plan = docs.sparkSession.createDataFrame(segments(counts, owner.tolist(), shards, slack),
                                             "arc int, _from long, _to long, shard int, _slot long")
    ranked = rank_in_group(keys, "arc")
    # the plan has arcs and overflows of arcs: bounded by the ring, not by the input
    out = ranked.join(F.broadcast(plan), (ranked["arc"] == plan["arc"]) & (F.col("rank") >= F.col("_from"))
                      & (F.col("rank") < F.col("_to")))
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("_slot") + F.col("rank") - F.col("_from")).alias("slot"))
