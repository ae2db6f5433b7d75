"""Mergeable profiles (D1, D6): stored state, merged with what a change set adds.

A state has one row per window and column: counts, mean and centred squares of
the numeric columns, their least and largest value, a distinct sketch and a
quantile sketch.  States of disjoint rows merge: counts add up, moments combine
by the parallel update, sketches by their union.

So after a change set the rows of a window are read again only where the set
deletes or rewrites one (no sketch or minimum can forget a value).  Windows with
inserts alone merge the state of the inserts; all others keep their row, and no
row of theirs is read.  A state of tens of thousands of windows is small; it is
joined like any table.

Exact after any merges: n, nulls, min, max, and mean and std up to rounding.
Bounded: ``distinct`` (relative standard error about 1 % with 2**14 slots) and
the quartiles (rank error about 1 % with k = 200).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .drift import _number, _split_columns, touched_windows, window_index, window_start

LG_SLOTS, KLL_K = 14, 200
STATE = ["k", "column", "n", "nn", "mean", "m2", "min", "max", "hll", "kll"]
NUMBERS = ["mean", "m2", "min", "max"]


def profile_state(df: DataFrame, ts: str, width: str, origin: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The state of ``df``'s rows, in one pass with map-side combine.  Columns
    that are not numeric have counts and a distinct sketch only."""
    num, cat = _split_columns(df, columns, [ts])
    k = window_index(ts, width, origin).alias("k")
    one = F.struct
    null_d, null_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [one(F.lit(c).alias("column"), _number(c).alias("v"), _number(c).cast("string").alias("s")) for c in num]
    cells += [one(F.lit(c).alias("column"), null_d.alias("v"), F.coalesce(F.col(c).cast("string"), null_s).alias("s")) for c in cat]
    long = df.select(k, F.explode(F.array(*cells)).alias("_c")).select("k", "_c.column", "_c.v", "_c.s")
    return long.groupBy("k", "column").agg(
        F.count(F.lit(1)).alias("n"), F.count("s").alias("nn"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.hll_sketch_agg("s", F.lit(LG_SLOTS)).alias("hll"),
        F.when(F.count("v") > 0, F.kll_sketch_agg_double("v", F.lit(KLL_K))).alias("kll")).select(*STATE)


def merge_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """The state of the rows of both, which share none."""
    x, y = (d.select("k", "column", F.struct(*STATE[2:]).alias(name)) for d, name in ((a, "_x"), (b, "_y")))
    j = x.join(y, ["k", "column"], "full_outer")
    f = lambda side, c: F.col(f"{side}.{c}")
    n = [F.coalesce(f(s, "n"), F.lit(0).cast("bigint")) for s in ("_x", "_y")]
    nn = [F.coalesce(f(s, "nn"), F.lit(0).cast("bigint")) for s in ("_x", "_y")]
    total = nn[0] + nn[1]
    delta = f("_y", "mean") - f("_x", "mean")
    both = f("_x", "mean").isNotNull() & f("_y", "mean").isNotNull()

    def pick(c: str, merged: Column) -> Column:
        return F.when(both, merged).otherwise(F.coalesce(f("_x", c), f("_y", c))).alias(c)

    def union(c: str, merged: Column) -> Column:
        return F.when(f("_x", c).isNotNull() & f("_y", c).isNotNull(), merged).otherwise(F.coalesce(f("_x", c), f("_y", c))).alias(c)
    return j.select("k", "column", (n[0] + n[1]).alias("n"), total.alias("nn"),
                    pick("mean", f("_x", "mean") + delta * nn[1] / total),
                    pick("m2", f("_x", "m2") + f("_y", "m2") + delta * delta * nn[0] * nn[1] / total),
                    F.least(f("_x", "min"), f("_y", "min")).alias("min"), F.greatest(f("_x", "max"), f("_y", "max")).alias("max"),
                    union("hll", F.hll_union(f("_x", "hll"), f("_y", "hll"))),
                    union("kll", F.kll_sketch_merge_double(f("_x", "kll"), f("_y", "kll")))).select(*STATE)


def update_state(state: DataFrame, changes: DataFrame, after: DataFrame, ts: str, width: str, origin: str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """The state of ``after`` from the ``state`` before it and a change set
    (rows with ``change``: insert, delete, update_preimage, update_postimage).
    ``after`` is read in the rewritten windows alone, behind a range filter that
    the scan can use, and not at all if there are none."""
    cols = list(columns) if columns else [c for c in after.columns if c != ts]
    changes = written(changes.select("change", ts, *cols), "changes")
    rewritten = written(touched_windows(changes.where("change <> 'insert'"), ts, width, origin), "rewritten")
    added = changes.where("change = 'insert'").withColumn("_k", window_index(ts, width, origin))
    added = added.join(rewritten.withColumnRenamed("k", "_k"), "_k", "left_anti").drop("_k", "change")
    kept = state.join(rewritten, "k", "left_anti")
    out = merge_states(kept, profile_state(added, ts, width, origin, cols))
    span = rewritten.agg(window_start(F.min("k"), width, origin), window_start(F.max("k") + 1, width, origin)).first()
    if span[0] is None:
        return out
    rows = after.where((F.col(ts) >= F.lit(span[0])) & (F.col(ts) < F.lit(span[1]))).withColumn("_k", window_index(ts, width, origin))
    rows = rows.join(rewritten.withColumnRenamed("k", "_k"), "_k", "left_semi").drop("_k")
    return out.unionByName(profile_state(rows, ts, width, origin, cols))


def state_profile(state: DataFrame, width: str, origin: str) -> DataFrame:
    """The D1 profile of a state: the columns of :func:`drift.profile`, distinct
    counts and quartiles from the sketches."""
    q = [F.kll_sketch_get_quantile_double("kll", F.lit(p)).alias(f"p{int(100 * p)}") for p in (0.25, 0.5, 0.75)]
    return state.select(
        window_start("k", width, origin).alias("window"), "k", "column", "n", (F.col("n") - F.col("nn")).alias("nulls"),
        ((F.col("n") - F.col("nn")).cast("double") / F.col("n").cast("double")).alias("null_rate"),
        F.hll_sketch_estimate("hll").alias("distinct"), "min", "max", "mean",
        F.when((F.col("nn") > 1) & F.col("m2").isNotNull(), F.sqrt(F.col("m2") / (F.col("nn") - 1))).alias("std"), *q)
