"""Queries over the churn view: cleaning, labels, tenure, training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tenure import register_functions, tenure_days, tenure_sql
from ..operators.columns import label_features, normalize_missing, top_k
from . import fixtures as fx
from .features import FeatureFunction, FeatureLookup, FeatureSpec, key_table, lookup_heavy, training_set
from .registry import query


def churn_spec(feature_names=None) -> FeatureSpec:
    return FeatureSpec(
        lookups=[FeatureLookup("churn_user_features", "user_id", feature_names)],
        functions=[FeatureFunction("user_tenure", {"creation_date_in": "creation_date"},
                                   "user_tenure", params={"as_of": fx.AS_OF})],
        label="churn_label",
        exclude=list(fx.EXCLUDED))


@query("features_clean", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT * FROM features_clean""")
def features_clean(spark, sf_dir):
    """P3 then P5 over the raw feature view."""
    return fx.features_clean(spark, sf_dir)


@query("labels_renamed", f"""
WITH {fx.CHURN_RAW_SQL}
SELECT user_id, churn AS churn_label FROM churn_raw""")
def labels_renamed(spark, sf_dir):
    """P1 + P2."""
    return fx.churn_labels(spark, sf_dir)


@query("tenure_sorted", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT user_id, {tenure_sql('creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} AS user_tenure
FROM features_clean ORDER BY user_tenure""")
def tenure_sorted(spark, sf_dir):
    """F1 over the feature table, O1 ascending."""
    f = fx.features_clean(spark, sf_dir)
    return (f.select("user_id", tenure_days("creation_date", fx.AS_OF).alias("user_tenure"))
            .orderBy("user_tenure"))


TRAINING_SET_SQL = f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT r.churn AS churn_label, f.segment, f.balance, f.order_count,
       {tenure_sql('f.creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} AS user_tenure
FROM churn_raw r LEFT JOIN features_clean f ON r.user_id = f.user_id"""


@query("training_set", TRAINING_SET_SQL)
def training_set_q(spark, sf_dir):
    """M8: labels <- lookup(all features) <- tenure function -> exclusions."""
    return training_set(fx.churn_labels(spark, sf_dir), churn_spec(),
                        tables={"churn_user_features": fx.features_clean(spark, sf_dir)})


@query("training_set_named", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT r.user_id, r.churn AS churn_label, f.balance, f.creation_date,
       {tenure_sql('f.creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} AS user_tenure
FROM churn_raw r LEFT JOIN features_clean f ON r.user_id = f.user_id""")
def training_set_named(spark, sf_dir):
    """Named features only, in the given order; no exclusions."""
    spec = churn_spec(["balance", "creation_date"])
    spec.exclude = []
    return training_set(fx.churn_labels(spark, sf_dir), spec,
                        tables={"churn_user_features": fx.features_clean(spark, sf_dir)})


@query("training_set_multi_key", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_brand, p.p_size, p.p_retailprice,
       s.s_nationkey, s.s_acctbal
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def training_set_multi_key(spark, sf_dir):
    """Two lookups with different keys, applied left to right."""
    li = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    part = fx.table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    supp = fx.table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    spec = FeatureSpec(
        lookups=[FeatureLookup("part", "l_partkey", ["p_brand", "p_size", "p_retailprice"]),
                 FeatureLookup("supplier", "l_suppkey", ["s_nationkey", "s_acctbal"])],
        exclude=["l_partkey", "l_suppkey"])
    return training_set(li, spec, tables={"part": part, "supplier": supp})


@query("missing_normalized", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer""")
def missing_normalized(spark, sf_dir):
    """NaN (here every tenth balance) becomes NULL."""
    c = fx.table(spark, sf_dir, "customer")
    nan = F.when(F.col("c_custkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return normalize_missing(c.select("c_custkey", nan.alias("balance")))


@query("label_last", f"""
WITH {fx.CHURN_RAW_SQL}
SELECT user_id, segment, balance, order_count, churn FROM churn_raw""")
def label_last(spark, sf_dir):
    """Features and label in the same row, the label last."""
    df, features = label_features(fx.churn_raw(spark, sf_dir).select("churn", "user_id", "segment", "balance", "order_count"), "churn")
    return df.select(*features, "churn")


@query("top_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def top_orders(spark, sf_dir):
    """O2: the hundred dearest orders (a top-k report)."""
    return top_k(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                 [F.desc("o_totalprice"), "o_orderkey"], 100)


@query("tenure_sql_function", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT user_id, {tenure_sql('creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} AS user_tenure FROM features_clean""")
def tenure_sql_function(spark, sf_dir):
    """the tenure function called from SQL."""
    register_functions(spark)
    return fx.features_clean(spark, sf_dir).selectExpr(
        "user_id", f"user_tenure(creation_date, TIMESTAMP_NTZ '{fx.AS_OF}') AS user_tenure")


@query("key_only", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT user_id FROM features_clean""")
def key_only(spark, sf_dir):
    """The key-only table that batch scoring starts from."""
    return key_table(fx.features_clean(spark, sf_dir), "user_id")


@query("lookup_heavy_keys", """
WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS s_suppkey FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber, l.s_suppkey, s.s_name, s.s_acctbal FROM l LEFT JOIN supplier s ON l.s_suppkey = s.s_suppkey""")
def lookup_heavy_keys(spark, sf_dir):
    """J1 + J3: supplier features for all line items where one key holds a third
    of the rows: it is found by a sketch and dealt to several tasks."""
    li = fx.table(spark, sf_dir, "lineitem")
    left = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast(li.schema["l_suppkey"].dataType))
                     .otherwise(F.col("l_suppkey")).alias("s_suppkey"))
    return lookup_heavy(left, FeatureLookup("supplier", "s_suppkey", ["s_name", "s_acctbal"]), fx.table(spark, sf_dir, "supplier"), rows_per_task=10_000)
