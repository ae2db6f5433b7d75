"""Deterministic per-row uniform numbers from a key.

``u = int(first 8 hex digits of md5("<seed>:<key>"), 16) / 2^32`` lies in
[0, 1), depends only on the key and the seed, and survives repartitioning and
recomputation after an executor loss (unlike ``rand()`` or ``randomSplit``).
The same number is computable in any SQL engine with md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _key_text(key: str | Column | Sequence[str | Column]) -> Column:
    if isinstance(key, (str, Column)):
        key = [key]
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in key]
    # a NULL key is a key of its own; several parts carry their lengths, so
    # ("a|b", "c") and ("a", "b|c") differ
    if len(parts) == 1:
        return F.coalesce(parts[0], F.lit("<null>"))
    return F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def unit_hash(key: str | Column | Sequence[str | Column], seed: int = 42) -> Column:
    text = F.concat(F.lit(f"{seed}:"), _key_text(key))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
            .cast("double") / F.lit(TWO_POW_32))


def unit_hash_sql(key_sql: str, seed: int = 42) -> str:
    """The same number as a DuckDB expression over a key expression."""
    return (f"(('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"
            f" / 4294967296.0)")
