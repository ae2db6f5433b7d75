"""Keys, merges and change capture.

All checks are aggregations; partial (map-side) aggregation means a key that
holds a third of all rows still leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    pass


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _any_null(key: list[str]) -> Column:
    c = F.lit(False)
    for k in key:
        c = c | F.col(k).isNull()
    return c


def key_report(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row (rows, distinct_keys, null_keys, duplicate_keys, duplicate_rows)."""
    key = _as_list(key)
    per_key = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_null", _any_null(key)))
    valid = ~F.col("_null")
    dup = valid & (F.col("_n") > 1)
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(valid).cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n")).otherwise(0)), F.lit(0))
        .cast("bigint").alias("null_keys"),
        F.count_if(dup).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("_n")).otherwise(0)), F.lit(0))
        .cast("bigint").alias("duplicate_rows"),
    )


def require_key(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise :class:`KeyViolation` unless the key columns are never null and
    identify one row each.  One small aggregate reaches the driver."""
    r = key_report(df, key).first()
    if r["null_keys"] or r["duplicate_keys"]:
        raise KeyViolation(
            f"key {list(_as_list(key))}: {r['null_keys']} null keys, "
            f"{r['duplicate_keys']} duplicated keys over {r['duplicate_rows']} rows")


def key_violations(df: DataFrame, key: str | Sequence[str], salts: int = 32) -> DataFrame:
    """The offending rows, with ``violation`` ('null_key' or
    'duplicate_key') and ``key_rows`` (rows sharing the key).

    Keys are counted with map-side combine, and the rows look their key's count
    up under a salt made from the other columns: the rows of one key go to up
    to ``salts`` tasks, while the count table has a row per duplicated key and
    salt.  Rows with a null key keep their place in the same left join.
    """
    key = _as_list(key)
    rest = [c for c in df.columns if c not in key]
    salt = F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int") if rest else F.lit(0)
    counts = (df.filter(~_any_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows"))
              .filter(F.col("key_rows") > 1)
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit((salts if rest else 1) - 1)))))
    d = df.withColumn("_salt", salt).join(counts, [*key, "_salt"], "left")
    kind = F.when(_any_null(key), "null_key").when(F.col("key_rows").isNotNull(), "duplicate_key")
    return d.withColumn("violation", kind).filter(F.col("violation").isNotNull()).select(*df.columns, "violation", "key_rows")


def merge_insert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """MERGE .. WHEN NOT MATCHED THEN INSERT, as a plan.

    Rows of ``source`` whose key has no match in ``target`` are appended;
    matched target rows are untouched.  NULL keys never match, so they are
    inserted.  Running it again on its own output adds nothing.
    """
    key = _as_list(key)
    new_rows = source.join(target.select(*key), key, "left_anti")  # J5
    return target.unionByName(new_rows.select(*target.columns))


CHANGE_TYPES = ("insert", "delete", "update_preimage", "update_postimage")


def snapshot_changes(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """U4: row-level changes between two versions of a keyed table.

    Output: key columns, ``change`` (insert, delete, update_preimage,
    update_postimage) and the non-key columns.  One full outer join on the key;
    rows compare as structs with the null-safe ``<=>``.
    """
    key = _as_list(key)
    vals = [c for c in before.columns if c not in key]
    b = before.select(*key, F.struct(*vals).alias("_b"), F.lit(True).alias("_inb"))
    a = after.select(*key, F.struct(*[F.col(c) for c in vals]).alias("_a"),
                     F.lit(True).alias("_ina"))
    j = b.join(a, key, "full_outer")

    def item(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("change"), F.col(row).alias("row"))

    empty = F.array_remove(F.array(item("insert", "_a")), item("insert", "_a"))
    events = (F.when(F.col("_inb").isNull(), F.array(item("insert", "_a")))
              .when(F.col("_ina").isNull(), F.array(item("delete", "_b")))
              .when(~F.col("_b").eqNullSafe(F.col("_a")),
                    F.array(item("update_preimage", "_b"), item("update_postimage", "_a")))
              .otherwise(empty))
    out = j.select(*key, F.explode(events).alias("_e"))
    return out.select(*key, F.col("_e.change").alias("change"),
                      *[F.col(f"_e.row.{c}").alias(c) for c in vals])


def apply_changes(before: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Replay a change set on ``before``; ``apply_changes(b, snapshot_changes(b, a)) == a``."""
    key = _as_list(key)
    touched = changes.filter(F.col("change").isin("delete", "update_preimage")).select(*key)
    kept = before.join(touched, key, "left_anti")
    added = (changes.filter(F.col("change").isin("insert", "update_postimage"))
             .select(*before.columns))
    return kept.unionByName(added)
