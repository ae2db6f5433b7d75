"""Best-fit packing planned on a histogram of lengths.

1. An Arrow pass turns each text into subword ids and an end id, cut into
   pieces of at most ``capacity`` ids.  Ids are not kept, only each piece's
   length and checksum.
2. Pieces are counted by length: at most ``capacity`` rows, whatever the input.
3. Best fit, longest first, runs on those counts: all pieces of one length go
   into the sequences with the least room that holds them, many at a time.  The
   plan is a list of runs: ranks of one length, and the sequences they fill.
4. Each piece takes its rank within its length (by cells, so a length shared by
   a third of all pieces is no single task) and joins the run of that rank.

Edge cases: null text is empty, which still is a piece of one end id; repeated
rows and doc_ids are pieces of their own; null doc_id is carried along; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, lean, slices, small_batches, written
from .ranks import rank_in_group, salted
from .subwords import remembered, word_bpe

CAPACITY = 4096
END = 1


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, ranks, first sequence, sequences, first
    offset).  Rank first + j * sequences + i lies in sequence ``first sequence``
    + i at offset ``first offset`` + j * length."""
    rooms: dict[int, list[list[int]]] = {}  # room left: ranges of sequences
    order: list[int] = []  # the rooms there are, ascending
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append([first, n])

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect.bisect_left(order, length)
            if i < len(order):
                room = order[i]
                first, n = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(i)
            else:  # new sequences
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = min(room // length, left)
            take = min(n, left // each)
            runs.append((length, rank, each * take, first, take, capacity - room))
            put(room, first + take, n - take) if room < capacity or n > take else None
            put(room - each * length, first, take)
            rank, left = rank + each * take, left - each * take
    return runs


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = remembered(word_bpe, path)
        for batch in batches:
            doc, texts = batch.column(0), batch.column(1)
            for s, e in slices(texts):
                w = Words(texts.slice(s, e - s))
                ids, size = ids_of(w)
                ends = np.concatenate(([0], np.cumsum(size)))[w.bounds]
                ids = ids.astype("<u4")
                row, piece, start, length, crc = [], [], [], [], []
                last = np.array([END], "<u4").tobytes()
                for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    raw = ids[a:b].tobytes() + last
                    for k in range(0, b - a + 1, capacity):
                        part = raw[4 * k:4 * (k + capacity)]
                        row.append(s + i)
                        piece.append(k // capacity)
                        start.append(k)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its place: sequence_id and offset."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = docs.select("doc_id", "text").mapInArrow(
        lean(_pieces(path, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = written(salted(pieces), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    runs = spark.createDataFrame(plan(counts, capacity), "length long, _first long, _ranks long, _seq long, _n long, _at long")
    ranked = rank_in_group(pieces, "length").drop("salt")
    # the plan's size depends on the capacity, not on the input
    out = ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("_first"))
                      & (F.col("rank") < F.col("_first") + F.col("_ranks"))).drop(runs["length"])
    k = F.col("rank") - F.col("_first")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_seq") + k % F.col("_n")).alias("sequence_id"),
                      (F.col("_at") + F.floor(k / F.col("_n")) * F.col("length")).alias("offset"))
