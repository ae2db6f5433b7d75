"""Prefix trie of conversations by burst tries.

Every conversation is rebuilt as the first turns of an earlier one followed by
its own, and each distinct sequence of first turns is a node.

1. Turns get their places by a range sort, local numbers and offsets: a
   conversation of any length is numbered by many tasks.
2. A turn's id is a 128-bit digest of role and text.  Two exclusive-or sums over
   hashes of (id, place) name a sequence without gathering it; conversations
   with equal sequences become one class, whatever their number.
3. A class's turn ids are packed in segments of ``segment`` turns, one byte
   string each.  A trie head is a sequence, its container holds the suffixes of
   the classes below it, up to the end of the segment.
4. A container with over ``limit`` turns in several classes bursts: its head
   becomes a node with counted statistics and its suffixes go to containers by
   their next turn id.  This repeats until all fit.
5. The others are sorted and swept: a suffix leaves the nodes that it does not
   share with the one before and opens new ones; a node passes its sums on to
   its parent when it closes.  Sums reach burst heads by the chain of heads that
   a container carries, and the segment before by its next head.
   Behind the last segment that two classes reach together all are single
   chains, whose sums are known beforehand: they are swept at once.

SHA-256 reads its input in order, so the ids of the conversations that end at a
node stream sorted through one task, without being held.

Edge cases: a null conv_id takes no part; turns with the same number go by the
digest of role and text; repeated rows are turns of their own; null role or text
is empty; ``c - c % 5`` and the remainder follow SQL (towards zero) for negative
ids; an empty table has no conversation and gives no node, not even a root;
further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, small_batches, written

ID = 16  # bytes of a turn's id
SEGMENT = 1024
LIMIT = 100_000
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, end long")
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_ids(rows: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.octet_length(text).cast("bigint").alias("bytes"))


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``pos``, from 1 within each conversation, by turn (null first) and id."""
    salted = written(turns.withColumn("salt", F.monotonically_increasing_id()), "turns")
    order = [F.asc_nulls_first("turn"), F.col("id"), F.col("salt")]
    cut = written(salted.repartitionByRange("c", *order).withColumn("part", F.spark_partition_id()), "ranges")
    local = cut.withColumn("_n", F.row_number().over(Window.partitionBy("part", "c").orderBy(*order)))
    counts = cut.groupBy("c", "part").agg(F.count(F.lit(1)).alias("_k"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("c", "part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, ["c", "part"]).select("c", (F.col("_n") + F.col("_before")).alias("pos"), "id", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (c, pos, id, bytes), and all conversations (c)."""
    turns = written(numbered(turns), "numbered")
    sizes = turns.groupBy("c").agg(F.max("pos").alias("n"))
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(9))
    convs = sizes.select("c", h.alias("h"), (F.col("c") - F.col("c") % 5).alias("base"))
    of_base = sizes.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    convs = written(convs.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "convs")
    heads = turns.where("pos <= 8").withColumnRenamed("c", "base").join(convs, "base").where("pos <= h")
    own = turns.join(convs, "c").where("pos > h").withColumn("pos", F.col("taken") + F.col("pos") - F.col("h"))
    cols = ["c", "pos", "id", "bytes"]
    return written(heads.select(*cols).unionByName(own.select(*cols)), "rebuilt"), convs.select("c")


def _names():
    """Two hashes of (id, place), whose exclusive-or sums name a sequence."""
    return F.xxhash64("id", "pos"), F.xxhash64("pos", "id", F.lit(1))


def classes_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """c with its sequence's length ``n`` and its class ``v``, the least conversation."""
    a, b = _names()
    named = convs.join(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(a).alias("x"), F.bit_xor(b).alias("y")), "c", "left")
    named = written(named.select("c", *[F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in ("n", "x", "y")]), "named")
    least = named.groupBy("n", "x", "y").agg(F.min("c").alias("v"), F.count(F.lit(1)).alias("members"))
    return written(named.join(least, ["n", "x", "y"]).select("c", "n", "v", "members"), "classes")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of v, c."""
    last, state = None, None
    for batch in batches:
        out = []
        for v, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if v != last:
                if state:
                    out.append((last, state.hexdigest()))
                last, state = v, hashlib.sha256(str(c).encode())
            else:
                state.update(b",%d" % c)
        yield pa.RecordBatch.from_pylist([{"end": v, "ends_sha256": d} for v, d in out], DIGEST)
    if state:
        yield pa.RecordBatch.from_pylist([{"end": last, "ends_sha256": state.hexdigest()}], DIGEST)


DIGEST = pa.schema([("end", pa.int64()), ("ends_sha256", pa.string())])


def ends(classes: DataFrame) -> DataFrame:
    """end (a class) and the SHA-256 of its conversations' ids."""
    one = classes.where("members = 1").select(F.col("v").alias("end"), F.sha2(F.col("c").cast("string").cast("binary"), 256).alias("ends_sha256"))
    many = classes.where("members > 1").select("v", "c").repartition("v").sortWithinPartitions("v", "c")
    return one.unionByName(many.mapInArrow(lean(_digest), "end long, ends_sha256 string"))


def sweep(rows: list[dict], head_depth: int) -> tuple[list[list], list]:
    """The nodes of one container from its suffixes in order of path: lists like
    NODE, parents by number until the end.  The first is the head."""
    nodes = [[None, head_depth, None, 0, 0, 0, 0, None]]
    own = [0]  # bytes of each node's last turn
    stack, last = [0], b""

    def close() -> None:
        i = stack.pop()
        node = nodes[i]
        node[5] = node[5] or 1  # no child: a leaf itself
        node[6] += (node[3] - 1) * own[i]
        if stack:
            up = nodes[stack[-1]]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]
    for r in rows:
        path, same = r["path"], 0
        most = min(len(path), len(last))
        while same < most and path[same:same + ID] == last[same:same + ID]:
            same += ID
        while len(stack) > same // ID + 1:
            close()
        for k in range(same // ID, len(path) // ID):
            nodes.append([r["v"], head_depth + k + 1, stack[-1], 0, 0, 0, 0, None])
            own.append(r["sizes"][k])
            stack.append(len(nodes) - 1)
        for i in stack:
            nodes[i][0] = r["v"] if nodes[i][0] is None else min(nodes[i][0], r["v"])
            nodes[i][3] += r["members"]
        top = nodes[stack[-1]]
        if r["below"] is None:
            top[7] = r["v"]
        elif not top[5]:  # the same for all that go on from here
            top[4], top[5], top[6], top[7] = (r["below"][k] for k in ("kids", "leaves", "saved", "end"))
        last = path
    own[0] = rows[0]["head_bytes"]
    while stack:
        close()
    for node in nodes[1:]:
        node[2] = nodes[node[2]][0]
    nodes[0][2] = rows[0]["up_conv"]
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers, whose rows follow each other in order of path;
    a head carries its key and its chain of burst heads."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in NODE.split(", ")] + [
        ("x", pa.int64()), ("y", pa.int64()), ("is_head", pa.bool_()), ("chain", pa.list_(pa.int64()))])

    def result(rows):
        nodes = sweep(rows, rows[0]["depth"])
        cols = [list(c) for c in zip(*nodes)]
        n, first = len(nodes), rows[0]
        cols += [[first["x"]] * n, [first["y"]] * n, [True] + [False] * (n - 1), [first["chain"]] + [None] * (n - 1)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    held = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and any(held[0][k] != r[k] for k in ("s", "x", "y")):
                yield result(held)
                held = []
            held.append(r)
    if held:
        yield result(held)


def segments(turns: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Every class's turns in segments: class v, number s, the name (x, y) of the
    sequence before it, packed ids and sizes, the name after it (null at the end),
    and what the segments after it save if no other class goes that way.  A class
    that ends with a full segment (or has no turn) ends in an empty one, so that
    a head's container has all classes that reach the head."""
    reps = classes.where("c = v").select("v", "n", "members")
    own = reps.join(turns.withColumnRenamed("c", "v"), "v").withColumn("s", F.floor((F.col("pos") - 1) / size))
    last = reps.where(F.col("n") % size == 0).withColumn("s", F.floor(F.col("n") / size))
    rows = own.unionByName(last, allowMissingColumns=True)
    a, b = _names()
    part = rows.groupBy("v", "s").agg(
        F.first("n").alias("n"), F.first("members").alias("members"), F.bit_xor(F.when(F.col("id").isNotNull(), a)).alias("a"),
        F.bit_xor(F.when(F.col("id").isNotNull(), b)).alias("b"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("all_bytes"),
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "bytes")))).alias("t"))
    later = Window.partitionBy("v").orderBy("s").rowsBetween(1, Window.unboundedFollowing)
    upto = Window.partitionBy("v").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumns({"x": F.coalesce(F.bit_xor("a").over(upto), F.lit(0).cast("bigint")),
                             "y": F.coalesce(F.bit_xor("b").over(upto), F.lit(0).cast("bigint")),
                             "after": (F.col("members") - 1) * F.coalesce(F.sum("all_bytes").over(later), F.lit(0))})
    goes_on = F.col("n") >= (F.col("s") + 1) * size
    path = F.when(F.size("t") > 0, F.unhex(F.array_join(F.transform("t", lambda e: F.hex(e["id"])), ""))).otherwise(F.unhex(F.lit("")))
    return part.select("v", "s", "n", "members", "x", "y", "after", (F.col("s") * size).alias("depth"), path.alias("path"),
                       F.col("t.bytes").alias("sizes"),
                       *[F.when(goes_on, F.col(k).bitwiseXOR(F.col(d))).alias(f"next_{k}") for k, d in (("x", "a"), ("y", "b"))])


def level_nodes(rows: DataFrame, limit: int) -> DataFrame:
    """Nodes of all containers of one segment number, heads marked, by bursting
    and sweeping.  ``rows``: segments with ``below``, the sums of what follows."""
    rows = written(rows.select("s", "x", "y", "v", "members", "depth", "path", "sizes", "below", F.lit(None).cast("bigint").alias("up_conv"),
                               F.lit(0).cast("bigint").alias("head_bytes"), F.lit(None).cast("array<bigint>").alias("chain")), "containers")
    swept, burst = [], []
    while True:
        key = ["s", "x", "y"]  # a burst head may have the name of a later segment's
        big = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("path") / ID).alias("left"), F.min("v").alias("conv"),
                                     F.sum("members").alias("all"), F.max(F.when(F.expr("octet_length(path) = 0 and below is null"), F.col("v"))).alias("end"))
        big = written(big.where((F.col("k") > 1) & (F.col("left") > limit)), "oversized")
        if big.isEmpty():
            swept.append(rows)
            break
        swept.append(rows.join(big, key, "left_anti"))
        over = rows.join(big, key)
        # the oversized heads are nodes; their suffixes go to containers by next id
        burst.append(over.groupBy(*key).agg(
            F.first("conv").alias("conv_id"), F.first("depth").alias("depth"), F.first("up_conv").alias("parent_conv_id"), F.first("all").alias("n_convs"),
            F.first("head_bytes").alias("bytes"), F.first("end").alias("end"), F.first("chain").alias("chain")))
        a, b = _names()
        nxt = over.where("octet_length(path) > 0").withColumns({"id": F.expr(f"substring(path, 1, {ID})"), "pos": F.col("depth") + 1})
        rows = written(nxt.select(
            "s", F.col("x").bitwiseXOR(a).alias("x"), F.col("y").bitwiseXOR(b).alias("y"), "v", "members", F.col("pos").alias("depth"),
            F.expr(f"substring(path, {ID + 1}, octet_length(path))").alias("path"), F.expr("slice(sizes, 2, size(sizes))").alias("sizes"), "below",
            F.col("conv").alias("up_conv"), F.col("sizes")[0].alias("head_bytes"),
            F.concat(F.coalesce("chain", F.array().cast("array<bigint>")), F.array("x", "y")).alias("chain")), "containers")
    every = swept[0]
    for s in swept[1:]:
        every = every.unionByName(s)
    out = written(every.repartition("s", "x", "y").sortWithinPartitions("s", "x", "y", "path").mapInArrow(
        lean(_sweep), NODE + ", x long, y long, is_head boolean, chain array<long>"), "swept")
    if not burst:
        return out
    heads = burst[0]
    for h in burst[1:]:
        heads = heads.unionByName(h)
    heads = written(heads, "burst")
    # a container's sums, and each burst head's own, count for all heads above
    gains = out.where("is_head").select("chain", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")).unionByName(
        heads.select("chain", F.lit(0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    pairs = "explode(transform(sequence(0, size(chain) div 2 - 1), i -> named_struct('x', chain[2 * i], 'y', chain[2 * i + 1])))"
    sums = gains.where("size(chain) > 0").select(F.expr(pairs).alias("h"), "leaves", "saved").groupBy(
        F.col("h.x").alias("x"), F.col("h.y").alias("y")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("_below"))
    last = "named_struct('x', element_at(chain, -2), 'y', element_at(chain, -1))"
    kids = out.where("is_head").select("chain").unionByName(heads.select("chain")).where("size(chain) > 0").groupBy(
        F.expr(last).alias("h")).agg(F.count(F.lit(1)).alias("n_children")).select("h.x", "h.y", "n_children")
    done = heads.join(sums, ["x", "y"]).join(kids, ["x", "y"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        ((F.col("n_convs") - 1) * F.col("bytes") + F.col("_below")).alias("saved_tokens"), "end", "x", "y", F.lit(True).alias("is_head"), "chain")
    return written(out.unionByName(done), "level")


def trie_nodes(rows: DataFrame, segment: int = SEGMENT, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    small_batches(rows.sparkSession)
    turns, convs = rebuilt(turn_ids(rows))
    classes = classes_of(turns, convs)
    segs = written(segments(turns, classes, segment), "segments")
    shared = segs.where("s > 0").groupBy("s", "x", "y").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    deepest = shared.agg(F.max("s")).first()[0] or 0  # the last segment that two classes reach together
    below, parts = None, []
    for s in range(deepest, -1, -1):
        here = segs.where(F.col("s") >= s) if s == deepest else segs.where(F.col("s") == s)
        if below is None:  # what goes on is a chain of its own
            ended = F.col("n") == F.col("depth") + segment
            here = here.withColumn("below", F.when(F.col("next_x").isNotNull(), F.struct(
                F.when(ended, 0).otherwise(1).cast("bigint").alias("kids"), F.lit(1).cast("bigint").alias("leaves"),
                F.col("after").alias("saved"), F.when(ended, F.col("v")).alias("end"))))
        else:
            here = here.join(below, ["next_x", "next_y"], "left")
        nodes = level_nodes(here, limit)
        top = F.col("is_head") & F.col("chain").isNull() & (F.col("depth") > 0)  # nodes of the segment before
        parts.append(nodes.where(~top))
        below = nodes.where(top & (F.col("depth") == s * segment)).select(
            F.col("x").alias("next_x"), F.col("y").alias("next_y"),
            F.struct(F.col("n_children").alias("kids"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), "end").alias("below"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.join(ends(classes), "end", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
