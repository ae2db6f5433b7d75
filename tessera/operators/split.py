"""Repeatable splits (M1, M2).

M1 assigns each row by a hash of its key against cumulative weights: disjoint,
complete, independent of partitioning and of recomputation, no shuffle.
Sizes are approximately proportional.

M2 gives exact sizes (the held-out part is ``ceil`` of its share, then split
again, as a two-step train/test split does) by ranking rows on (hash, key)
with the distributed running count of :mod:`tessera.operators.prefix`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from .prefix import bucket_count, global_rank

DEFAULT_WEIGHTS = {"train": 0.6, "val": 0.2, "test": 0.2}


def _norm(weights: dict[str, float]) -> list[tuple[str, float]]:
    total = float(sum(weights.values()))
    if total <= 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights must be non-negative with a positive sum")
    return [(k, w / total) for k, w in weights.items()]


def split_column(key: str | Sequence[str], weights: dict[str, float] | None = None,
                 seed: int = 42) -> Column:
    u = unit_hash(key, seed)
    parts = _norm(weights or DEFAULT_WEIGHTS)
    acc, expr = 0.0, None
    for name, w in parts[:-1]:
        acc += w
        cond = u < F.lit(acc)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(parts[-1][0])
    return last if expr is None else expr.otherwise(last)


def split(df: DataFrame, key: str | Sequence[str], weights: dict[str, float] | None = None,
          seed: int = 42, col: str = "split") -> DataFrame:
    """M1: add ``col`` with the split name of every row."""
    return df.withColumn(col, split_column(key, weights, seed))


def exact_sizes(n: int, weights: dict[str, float] | None = None) -> dict[str, int]:
    """Sizes M2 produces for ``n`` rows (for tests and reports)."""
    parts = _norm(weights or DEFAULT_WEIGHTS)
    out, remaining = {}, n
    for i, (name, w) in enumerate(parts[:-1]):
        rest = sum(x for _, x in parts[i + 1:])
        share = rest / (w + rest) if (w + rest) > 0 else 0.0
        hold = math.ceil(remaining * share)
        out[name] = remaining - hold
        remaining = hold
    out[parts[-1][0]] = remaining
    return out


def split_exact(df: DataFrame, key: str | Sequence[str], weights: dict[str, float] | None = None,
                seed: int = 42, col: str = "split") -> DataFrame:
    """M2: exact sizes, rows ordered by (hash, key); the key must be unique."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = _norm(weights or DEFAULT_WEIGHTS)
    # the hash is uniform: equal steps of it are buckets of equal size
    nb = bucket_count(df, None)
    ranked = global_rank(df.withColumn("_u", unit_hash(keys, seed)), ["_u", *keys],
                         bucket=F.floor(F.col("_u") * nb).cast("int"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))  # one row: attached as a scalar subquery
    # Cut points as expressions of n: the held-out remainder is ceil(rem * share).
    cuts, remaining = [], F.col("_n")
    start = F.lit(0).cast("bigint")
    for i, (name, w) in enumerate(parts[:-1]):
        rest = sum(x for _, x in parts[i + 1:])
        share = rest / (w + rest) if (w + rest) > 0 else 0.0
        hold = F.ceil(remaining * F.lit(share))
        end = start + (remaining - hold)
        cuts.append((name, end))
        start, remaining = end, hold
    j = ranked.withColumn("_n", n.select("_n").scalar())
    expr = None
    for name, end in cuts:
        cond = F.col("rank0") < end
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(parts[-1][0])
    expr = last if expr is None else expr.otherwise(last)
    return j.select(*df.columns, expr.alias(col))
