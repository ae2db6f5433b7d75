"""Stand-in tables built over the driver's test tables.

Each builder has a Spark form (used by the library's queries) and a DuckDB
SQL form (used only as the independent oracle).  Both derive from the given
tables, so their size grows with the scale factor.

Fixed values of the fixtures (they define the expected results):
- churn view: history = orders before 2000-01-01; churned = no order on or
  after 2001-01-01; tenure as of 2001-01-01.
- drift view: periods of ten days from 2024-01-01; seed 42; in period 2
  ``location`` is NULL where the event type is 'signup' and ``temperature`` is
  NULL where u < 0.2; in period 3 ``location`` is 'Chicago' where u < 0.25;
  ``temperature`` is lowered by 30 from 2024-01-26 on.
- orders v2: keys with o_orderkey % 50 = 0 deleted, = 1 price times 1.1
  (rounded to cents), = 2 status NULL, = 3 key moved by 10,000,000.
- requests: customer keys in groups of four; group % 10 = 1 ends with an
  unknown key (key + 100,000,000), = 2 repeats its first key last, = 3 is
  malformed JSON (closing brace cut).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash, unit_hash_sql
from ..session import data_path

HISTORY_END = "2000-01-01"
CHURN_FROM = "2001-01-01"
AS_OF = "2001-01-01"
DRIFT_ORIGIN = "2024-01-01"
DRIFT_SHIFT_FROM = "2024-01-26"
PERIOD_DAYS = 10
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(data_path(sf_dir, name))


# --------------------------------------------------------------------------
# churn view
# --------------------------------------------------------------------------

def churn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer.  A single conditional aggregate over orders (one
    shuffle, partially aggregated map-side) gives history and churn flag."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    pre = d < F.lit(HISTORY_END).cast("timestamp_ntz")
    late = d >= F.lit(CHURN_FROM).cast("timestamp_ntz")
    n_pre = F.count(F.when(pre, F.lit(1)))
    h = o.groupBy("o_custkey").agg(
        F.min(F.when(pre, d)).alias("creation_date"),
        F.max(F.when(pre, d)).alias("last_transaction"),
        F.max_by(F.when(pre, F.col("o_orderstatus")), F.when(pre, F.col("o_orderkey")))
        .alias("last_event"),
        F.when(n_pre > 0, n_pre).alias("order_count"),
        F.max(late).alias("_late"),
    )
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
         .join(h, c.c_custkey == h.o_custkey, "left"))
    return j.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("firstname"),
        F.col("n_name").alias("address"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        "creation_date", "last_transaction", "last_event", "order_count",
        F.when(F.coalesce(F.col("_late"), F.lit(False)), 0).otherwise(1).cast("int").alias("churn"),
    )


CHURN_RAW_SQL = f"""
churn_raw AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id, c.c_name AS firstname, n.n_name AS address,
         c.c_mktsegment AS segment, c.c_acctbal AS balance,
         h.creation_date, h.last_transaction, h.last_event, h.order_count,
         CAST(CASE WHEN late.o_custkey IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churn
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS creation_date, max(o_orderdate) AS last_transaction,
                    arg_max(o_orderstatus, o_orderkey) AS last_event, count(*) AS order_count
             FROM orders WHERE o_orderdate < TIMESTAMP '{HISTORY_END}' GROUP BY o_custkey) h
         ON h.o_custkey = c.c_custkey
  LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CHURN_FROM}') late
         ON late.o_custkey = c.c_custkey
)"""

DROPPED_FEATURES = ["address", "firstname", "last_event"]
EXCLUDED = ["user_id", "last_transaction", "creation_date"]


def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ml_churn_features: the raw view without the label."""
    return churn_raw(spark, sf_dir).drop("churn")


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ml_churn_labels: P1 + P2, from the one flag that the label needs."""
    late = (table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit(CHURN_FROM).cast("timestamp_ntz"))
            .select("o_custkey").distinct())
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(late, c.c_custkey == late.o_custkey, "left").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.when(F.col("o_custkey").isNull(), 1).otherwise(0).cast("int").alias("churn_label"))


def features_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """churn_user_features: P3 (non-strict; absent names ignored) then P5."""
    from ..operators.columns import drop_columns, drop_missing
    return drop_missing(drop_columns(churn_features(spark, sf_dir), DROPPED_FEATURES, strict=False))


FEATURES_CLEAN_SQL = CHURN_RAW_SQL + """,
features_clean AS (
  SELECT user_id, segment, balance, creation_date, last_transaction, order_count FROM churn_raw
  WHERE user_id IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL AND NOT isnan(balance)
    AND creation_date IS NOT NULL AND last_transaction IS NOT NULL AND order_count IS NOT NULL
)"""


def customer_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), F.col("c_acctbal").alias("balance"))


def signal_label() -> Column:
    """1 if balance > 3000, flipped where the key hash is below 0.1."""
    base = F.when(F.col("balance") > 3000, 1).otherwise(0)
    return F.when(unit_hash("user_id", 7) < 0.1, 1 - base).otherwise(base).cast("int").alias("churn_label")


SIGNAL_LABEL_SQL = (f"CAST(CASE WHEN {unit_hash_sql('user_id', 7)} < 0.1 THEN 1 - (CASE WHEN balance > 3000 THEN 1 ELSE 0 END) "
                    "ELSE (CASE WHEN balance > 3000 THEN 1 ELSE 0 END) END AS INTEGER)")


def churn_signal_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that carry signal: balance > 3000, flipped where the key hash is
    below 0.1 (a learnable but noisy target)."""
    raw = customer_balance(spark, sf_dir)
    return raw.select("user_id", signal_label())


# --------------------------------------------------------------------------
# drift view
# --------------------------------------------------------------------------

def drift_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_transform(table(spark, sf_dir, "events"))


def drift_transform(ev: DataFrame) -> DataFrame:
    """Row-wise (stateless) events -> drift view; works on a stream too."""
    origin = F.lit(DRIFT_ORIGIN).cast("timestamp_ntz")
    period = (F.floor(F.timestamp_diff("MICROSECOND", origin, F.col("ts"))
                      / F.lit(PERIOD_DAYS * 86_400_000_000.0)) + 1).cast("int")
    u = unit_hash("event_id", SEED)
    base = ev.select("event_id", "ts", "event_type", "value", period.alias("period"), u.alias("_u"))
    loc = (F.when((F.col("period") == 2) & (F.col("event_type") == "signup"), F.lit(None))
           .when((F.col("period") == 3) & (F.col("_u") < 0.25), F.lit("Chicago"))
           .otherwise(F.col("event_type")))
    temp = (F.when((F.col("period") == 2) & (F.col("_u") < 0.2), F.lit(None))
            .when(F.col("ts") >= F.lit(DRIFT_SHIFT_FROM).cast("timestamp_ntz"), F.col("value") - 30)
            .otherwise(F.col("value")))
    return base.select("event_id", F.col("ts").alias("date"), loc.cast("string").alias("location"),
                       temp.cast("double").alias("temperature"), "period")


DRIFT_VIEW_SQL = f"""
drift_base AS (
  SELECT event_id, ts, event_type, value,
         CAST(floor(date_diff('microsecond', TIMESTAMP '{DRIFT_ORIGIN}', ts) / {PERIOD_DAYS * 86_400_000_000}.0) + 1 AS INTEGER) AS period,
         {unit_hash_sql('event_id', SEED)} AS u
  FROM events
),
drift_view AS (
  SELECT event_id, ts AS date,
         CASE WHEN period = 2 AND event_type = 'signup' THEN NULL
              WHEN period = 3 AND u < 0.25 THEN 'Chicago' ELSE event_type END AS location,
         CAST(CASE WHEN period = 2 AND u < 0.2 THEN NULL
              WHEN ts >= TIMESTAMP '{DRIFT_SHIFT_FROM}' THEN value - 30 ELSE value END AS DOUBLE) AS temperature,
         period
  FROM drift_base
)"""


# --------------------------------------------------------------------------
# taxi view
# --------------------------------------------------------------------------

def taxi_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_quantity").alias("trip_distance"),
                     F.col("l_extendedprice").alias("fare_amount"))


TAXI_VIEW_SQL = """
taxi_view AS (
  SELECT l_orderkey, l_linenumber, l_quantity AS trip_distance, l_extendedprice AS fare_amount
  FROM lineitem
)"""


# --------------------------------------------------------------------------
# two versions of orders
# --------------------------------------------------------------------------

def orders_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    r = F.pmod(F.col("o_orderkey"), F.lit(50))
    return (o.filter(r != 0).select(
        F.when(r == 3, F.col("o_orderkey") + 10_000_000).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_custkey",
        F.when(r == 2, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(r == 1, F.round(F.col("o_totalprice") * 1.1, 2)).otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        "o_orderdate", "o_orderpriority"))


ORDERS_V2_SQL = """
orders_v1 AS (SELECT * FROM orders),
orders_v2 AS (
  SELECT CASE WHEN o_orderkey % 50 = 3 THEN o_orderkey + 10000000 ELSE o_orderkey END AS o_orderkey,
         o_custkey,
         CASE WHEN o_orderkey % 50 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 50 = 1 THEN round(o_totalprice * 1.1, 2) ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 0
)"""


# --------------------------------------------------------------------------
# JSON requests
# --------------------------------------------------------------------------

def requests_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, body): one JSON text per group of four customer keys.

    Groups hold at most four rows, so ``collect_list`` per group is bounded.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey")
    g = F.floor(F.col("c_custkey") / 4).cast("bigint")
    pos = F.pmod(F.col("c_custkey"), F.lit(4)).cast("int")
    items = c.select(g.alias("request_id"), pos.alias("pos"),
                     F.col("c_custkey").cast("string").alias("user_id"))
    grouped = items.groupBy("request_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "user_id"))).alias("items"))
    kind = F.pmod(F.col("request_id"), F.lit(10))
    ids = F.transform("items", lambda x: x["user_id"])
    n = F.size("items")
    ids = (F.when(kind == 1, F.concat(F.slice(ids, 1, n - 1),
                                      F.array((F.element_at(ids, -1).cast("bigint") + 100_000_000)
                                              .cast("string"))))
           .when(kind == 2, F.concat(F.slice(ids, 1, n - 1), F.slice(ids, 1, 1)))
           .otherwise(ids))
    body = F.to_json(F.struct(F.transform(ids, lambda u: F.struct(u.alias("user_id"))).alias("inputs")))
    body = F.when(kind == 3, F.left(body, F.length(body) - 1)).otherwise(body)
    return grouped.select("request_id", body.alias("body"))


# Expected parse of the requests, written directly from customer keys.
REQUESTS_EXPECTED_SQL = """
req_items AS (
  SELECT CAST(floor(c_custkey / 4) AS BIGINT) AS request_id,
         CAST(c_custkey % 4 AS INTEGER) AS pos, c_custkey
  FROM customer
),
req_size AS (SELECT request_id, count(*) AS n, min(c_custkey) AS first_key FROM req_items GROUP BY request_id),
requests_expected AS (
  SELECT i.request_id, i.pos,
         CASE WHEN i.request_id % 10 = 1 AND i.pos = s.n - 1 THEN CAST(i.c_custkey + 100000000 AS VARCHAR)
              WHEN i.request_id % 10 = 2 AND i.pos = s.n - 1 THEN CAST(s.first_key AS VARCHAR)
              ELSE CAST(i.c_custkey AS VARCHAR) END AS user_id
  FROM req_items i JOIN req_size s USING (request_id)
  WHERE i.request_id % 10 <> 3
)"""
