"""Queries for sources, keys, merges, change capture and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import unit_hash_sql
from ..operators.columns import stack_frames
from ..operators.digests import compare_digests, digest_changes, digests
from ..operators.keys import key_report, key_violations, merge_insert, snapshot_changes
from ..sources.tables import scan_param
from . import fixtures as fx
from .registry import query


@query("scan_param", """
SELECT l_quantity AS trip_distance, l_extendedprice AS fare_amount FROM lineitem""")
def scan_param_q(spark, sf_dir):
    """S5 + P1: the table name is bound as a parameter, then two columns kept."""
    fx.table(spark, sf_dir, "lineitem").createOrReplaceTempView("taxi_trips")
    df = scan_param(spark, "taxi_trips")
    return df.select(F.col("l_quantity").alias("trip_distance"),
                     F.col("l_extendedprice").alias("fare_amount"))


def _key_report_sql(tbl: str, key: list[str]) -> str:
    k = ", ".join(key)
    anynull = " OR ".join(f"{c} IS NULL" for c in key)
    return f"""
WITH g AS (SELECT {k}, count(*) AS n FROM {tbl} GROUP BY {k})
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE NOT ({anynull})) AS BIGINT) AS distinct_keys,
       CAST(coalesce(sum(CASE WHEN {anynull} THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys,
       CAST(count(*) FILTER (WHERE NOT ({anynull}) AND n > 1) AS BIGINT) AS duplicate_keys,
       CAST(coalesce(sum(CASE WHEN NOT ({anynull}) AND n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS duplicate_rows
FROM g"""


@query("key_report_unique", _key_report_sql("customer", ["c_custkey"]))
def key_report_unique(spark, sf_dir):
    """U1 on a unique key."""
    return key_report(fx.table(spark, sf_dir, "customer"), "c_custkey")


@query("key_report_dup", _key_report_sql("lineitem", ["l_orderkey", "l_linenumber"]))
def key_report_dup(spark, sf_dir):
    """U1 on a key that is not unique."""
    return key_report(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("key_violations", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS key_rows FROM lineitem
           WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
           GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT l.*, 'duplicate_key' AS violation, g.key_rows
FROM lineitem l JOIN g USING (l_orderkey, l_linenumber)
UNION ALL
SELECT l.*, 'null_key' AS violation, CAST(NULL AS BIGINT) AS key_rows
FROM lineitem l WHERE l_orderkey IS NULL OR l_linenumber IS NULL""")
def key_violations_q(spark, sf_dir):
    """Rows of duplicated or null keys."""
    return key_violations(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


MERGE_SPLIT = "1998-01-01"
MERGE_SOURCE_FROM = "1997-01-01"


@query("merge_insert", f"""
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_SPLIT}'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_SOURCE_FROM}')
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def merge_insert_q(spark, sf_dir):
    """Orders before 1998 merged with a source from 1997 on whose prices
    differ; matched rows keep the target's values."""
    o = fx.table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(MERGE_SPLIT).cast("timestamp_ntz"))
    source = (o.filter(F.col("o_orderdate") >= F.lit(MERGE_SOURCE_FROM).cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return merge_insert(target, source, "o_orderkey")


_ORDER_VALS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_DIFF = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _ORDER_VALS)
_B = ", ".join(f"b.{c}" for c in _ORDER_VALS)
_A = ", ".join(f"a.{c}" for c in _ORDER_VALS)


@query("snapshot_changes", f"""
WITH {fx.ORDERS_V2_SQL}
SELECT a.o_orderkey, 'insert' AS change, {_A} FROM orders_v2 a
  WHERE NOT EXISTS (SELECT 1 FROM orders_v1 b WHERE b.o_orderkey = a.o_orderkey)
UNION ALL
SELECT b.o_orderkey, 'delete' AS change, {_B} FROM orders_v1 b
  WHERE NOT EXISTS (SELECT 1 FROM orders_v2 a WHERE b.o_orderkey = a.o_orderkey)
UNION ALL
SELECT b.o_orderkey, 'update_preimage' AS change, {_B} FROM orders_v1 b JOIN orders_v2 a
  ON b.o_orderkey = a.o_orderkey WHERE {_DIFF}
UNION ALL
SELECT a.o_orderkey, 'update_postimage' AS change, {_A} FROM orders_v1 b JOIN orders_v2 a
  ON b.o_orderkey = a.o_orderkey WHERE {_DIFF}""")
def snapshot_changes_q(spark, sf_dir):
    """U4: row-level changes between two versions of orders."""
    return snapshot_changes(fx.orders_v1(spark, sf_dir), fx.orders_v2(spark, sf_dir), "o_orderkey")


@query("change_counts", f"""
WITH {fx.ORDERS_V2_SQL},
ch AS (
  SELECT 'insert' AS change FROM orders_v2 a
    WHERE NOT EXISTS (SELECT 1 FROM orders_v1 b WHERE b.o_orderkey = a.o_orderkey)
  UNION ALL
  SELECT 'delete' FROM orders_v1 b
    WHERE NOT EXISTS (SELECT 1 FROM orders_v2 a WHERE b.o_orderkey = a.o_orderkey)
  UNION ALL
  SELECT unnest(['update_preimage', 'update_postimage']) FROM orders_v1 b JOIN orders_v2 a
    ON b.o_orderkey = a.o_orderkey WHERE {_DIFF})
SELECT change, count(*) AS n FROM ch GROUP BY change""")
def change_counts(spark, sf_dir):
    """U4 summarised: rows per change type."""
    ch = snapshot_changes(fx.orders_v1(spark, sf_dir), fx.orders_v2(spark, sf_dir), "o_orderkey")
    return ch.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


DIGEST_BUCKETS = 256
_V3_ORDERS = """
orders_v1 AS (SELECT * FROM orders),
orders_v3 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                     CASE WHEN o_orderkey % 1009 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
              FROM orders WHERE o_orderkey % 1013 <> 7)"""


def _orders_v3(spark, sf_dir):
    """Few changes: a price in every 1009 keys, and one key in 1013 deleted (fixed values of the fixture)."""
    o = fx.table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 1009 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return o.where(F.col("o_orderkey") % 1013 != 7).withColumn("o_totalprice", price)


_BUCKET_SQL = f"CAST(floor({unit_hash_sql('o_orderkey')} * {DIGEST_BUCKETS}) AS INTEGER)"


@query("digest_changes", f"""
WITH {_V3_ORDERS}
SELECT b.o_orderkey, 'delete' AS change, {_B} FROM orders_v1 b
  WHERE NOT EXISTS (SELECT 1 FROM orders_v3 a WHERE b.o_orderkey = a.o_orderkey)
UNION ALL
SELECT b.o_orderkey, 'update_preimage' AS change, {_B} FROM orders_v1 b JOIN orders_v3 a
  ON b.o_orderkey = a.o_orderkey WHERE {_DIFF}
UNION ALL
SELECT a.o_orderkey, 'update_postimage' AS change, {_A} FROM orders_v1 b JOIN orders_v3 a
  ON b.o_orderkey = a.o_orderkey WHERE {_DIFF}""")
def digest_changes_q(spark, sf_dir):
    """U4: the changes of a version with few of them, from bucket digests and a
    join of the buckets that differ."""
    return digest_changes(fx.orders_v1(spark, sf_dir), _orders_v3(spark, sf_dir), "o_orderkey", DIGEST_BUCKETS)


@query("digest_buckets", f"""
WITH {_V3_ORDERS},
b AS (SELECT {_BUCKET_SQL} AS bucket, * FROM orders_v1),
a AS (SELECT {_BUCKET_SQL} AS bucket, * FROM orders_v3),
d AS (SELECT DISTINCT bucket FROM ((SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL (SELECT * FROM a EXCEPT SELECT * FROM b))),
nb AS (SELECT bucket, count(*) AS n FROM b GROUP BY 1),
na AS (SELECT bucket, count(*) AS n FROM a GROUP BY 1)
SELECT coalesce(nb.bucket, na.bucket) AS bucket, coalesce(nb.n, 0) AS n_before, coalesce(na.n, 0) AS n_after, d.bucket IS NOT NULL AS differs
FROM nb FULL JOIN na ON nb.bucket = na.bucket LEFT JOIN d ON d.bucket = coalesce(nb.bucket, na.bucket)""")
def digest_buckets(spark, sf_dir):
    """U4: rows per bucket in both versions, and whether their digests differ:
    they do exactly where a row does."""
    db, da = (digests(d, "o_orderkey", DIGEST_BUCKETS) for d in (fx.orders_v1(spark, sf_dir), _orders_v3(spark, sf_dir)))
    return compare_digests(db, da).withColumnRenamed("_bucket", "bucket")


@query("stack_frames", f"""
WITH {fx.DRIFT_VIEW_SQL}
SELECT * FROM drift_view""")
def stack_frames_q(spark, sf_dir):
    """O3: frames with equal columns stacked (bag union): the first period and
    before, the second, and all after it."""
    dv = fx.drift_view(spark, sf_dir)
    p = F.col("period")
    return stack_frames(dv.filter((p <= 1) | p.isNull()), dv.filter(p == 2), dv.filter(p >= 3))
