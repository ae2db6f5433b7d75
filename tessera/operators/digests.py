"""Change capture by bucket digests (U4).

A keyed snapshot is summed up as one row per hash bucket of its key: the number
of rows and two order-independent digests of them (an exact sum and an
exclusive-or of 64-bit row hashes).  Equal buckets of two snapshots hold equal
rows, so only the buckets that differ are joined row by row.  A digest table is
small and can be stored beside its snapshot; a snapshot that is stored by bucket
(:func:`write_bucketed`) is then read in the buckets that differ alone.

The full comparison shuffles both snapshots whole; this shuffles the changed
buckets.  With ``buckets`` well above the number of changes most rows are only
hashed where they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import unit_hash
from .keys import _as_list, snapshot_changes

BUCKETS = 4096
BUCKET = "_bucket"


def bucket_of_key(key: str | Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.floor(unit_hash(_as_list(key)) * buckets).cast("int")


def _row_hash(df: DataFrame, salt: int) -> Column:
    """A hash of all columns by name; NULLs count, as a hash of the values alone
    skips them.  -0.0 and 0.0 are equal to the comparison, and here."""
    cols = []
    for c in sorted(df.columns):
        kind = df.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):  # a hash skips NULLs within
            v = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            v = F.col(c) + F.lit(0.0).cast(kind)
        else:
            v = F.col(c)
        cols += [v, F.col(c).isNull()]
    return F.xxhash64(F.lit(salt), *cols)


def digests(df: DataFrame, key: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, n, total, xor): one row per bucket that has rows."""
    rows = df.select(bucket_of_key(key, buckets).alias(BUCKET), _row_hash(df, 1).alias("_h"), _row_hash(df, 2).alias("_g"))
    return rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("total"),
                                    F.bit_xor("_g").alias("xor"))


def compare_digests(before: DataFrame, after: DataFrame) -> DataFrame:
    """(_bucket, n_before, n_after, differs) of two digest tables."""
    pick = lambda d, side: d.select(BUCKET, F.struct("n", "total", "xor").alias(side))
    j = pick(before, "_b").join(pick(after, "_a"), BUCKET, "full_outer")
    n = lambda side: F.coalesce(F.col(f"{side}.n"), F.lit(0).cast("bigint"))
    return j.select(BUCKET, n("_b").alias("n_before"), n("_a").alias("n_after"), (~F.col("_b").eqNullSafe(F.col("_a"))).alias("differs"))


def write_bucketed(df: DataFrame, path: str, key: str | Sequence[str], buckets: int = BUCKETS) -> None:
    """The snapshot in one folder per bucket, and its digests beside it."""
    df.withColumn(BUCKET, bucket_of_key(key, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path + "/rows")
    digests(read_bucketed(df.sparkSession, path).drop(BUCKET), key, buckets).coalesce(1).write.parquet(path + "/digests")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path + "/rows")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path + "/digests")


def digest_changes(before: DataFrame, after: DataFrame, key: str | Sequence[str], buckets: int = BUCKETS,
                   before_digests: DataFrame | None = None, after_digests: DataFrame | None = None) -> DataFrame:
    """U4: as :func:`keys.snapshot_changes` for snapshots with unique keys.
    Stored digests spare the pass over their snapshot; a snapshot with a
    ``_bucket`` column (:func:`read_bucketed`) is pruned to the buckets that
    differ, others are filtered by the key's bucket before the join."""
    b, a = (d.drop(BUCKET) for d in (before, after))
    db = before_digests if before_digests is not None else digests(b, key, buckets)
    da = after_digests if after_digests is not None else digests(a, key, buckets)
    # one number per bucket at most, whatever the snapshots; as literals they prune stored buckets
    changed = [r[0] for r in compare_digests(db, da).where("differs").select(BUCKET).collect()]

    def rows(df: DataFrame) -> DataFrame:
        if BUCKET not in df.columns:
            df = df.withColumn(BUCKET, bucket_of_key(key, buckets))
        return df.where(F.col(BUCKET).isin(changed)).drop(BUCKET)
    return snapshot_changes(rows(before), rows(after), key)
