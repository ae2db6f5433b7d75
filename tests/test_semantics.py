"""Semantics pins on tiny frames: tenure, missing values, column/row order of
operations, keys, JSON requests, schema contracts."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.tenure import register_functions, tenure_days
from tessera.operators.columns import drop_columns, drop_missing, normalize_missing
from tessera.operators.keys import KeyViolation, key_report, key_violations, require_key
from tessera.plans.features import FeatureFunction, FeatureLookup, FeatureSpec, training_set
from tessera.plans.model import check_contract, contract_of
from tessera.sources.requests import read_requests, request_errors

AS_OF = dt.datetime(2024, 11, 10, 12, 0, 0)


def test_tenure_floor_and_null(spark):
    rows = [(None,), (AS_OF - dt.timedelta(days=1),), (AS_OF - dt.timedelta(days=1) + dt.timedelta(seconds=1),),
            (AS_OF + dt.timedelta(hours=12),), (AS_OF + dt.timedelta(days=1, hours=12),),
            (AS_OF - dt.timedelta(days=400, hours=3),)]
    df = spark.createDataFrame(rows, "c timestamp_ntz")
    got = [r[0] for r in df.select(tenure_days("c", AS_OF)).collect()]
    # NULL -> -1; exactly one day -> 1; one second short -> 0; 12 h ahead -> -1
    # (floor, not truncation); 1.5 days ahead -> -2.
    assert got == [-1, 1, 0, -1, -2, 400]


def test_tenure_sql_function_accepts_string(spark):
    register_functions(spark)
    r = spark.sql("SELECT user_tenure('2024-11-01', timestamp_ntz'2024-11-10 12:00:00') AS a, "
                  "user_tenure(NULL) AS b, typeof(user_tenure('2024-11-01')) AS t").first()
    assert r["a"] == 9 and r["b"] == -1 and r["t"] == "int"


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, 2.0, None)],
                               "id int, x double, s string")
    assert drop_missing(df).count() == 1
    n = normalize_missing(df)
    assert n.filter(F.col("x").isNull()).count() == 2
    assert n.agg(F.avg("x")).first()[0] == 1.5  # NaN no longer poisons avg


def test_drop_columns_before_drop_missing(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "x", None)], "user_id int, email string, v double")
    # dropping email first keeps row 1, which has a NULL only in email
    assert drop_missing(drop_columns(df, ["email"])).count() == 1
    with pytest.raises(KeyError):
        drop_columns(df, ["nope"])
    assert drop_columns(df, ["nope", "email"], strict=False).columns == ["user_id", "v"]


def test_exclusion_applies_after_functions(spark):
    labels = spark.createDataFrame([("u1", 1), ("u2", 0), ("u3", 1)], "user_id string, churn_label int")
    feats = spark.createDataFrame([("u1", 10.0, dt.datetime(2024, 11, 1)), ("u2", 20.0, None)],
                                  "user_id string, f double, creation_date timestamp_ntz")
    spec = FeatureSpec(lookups=[FeatureLookup("feats", "user_id")],
                       functions=[FeatureFunction("user_tenure", {"creation_date_in": "creation_date"},
                                                  "user_tenure", params={"as_of": "2024-11-10"})],
                       label="churn_label", exclude=["user_id", "creation_date"])
    out = training_set(labels, spec, {"feats": feats})
    assert out.columns == ["churn_label", "f", "user_tenure"]
    got = sorted(((r.churn_label, r.f, r.user_tenure) for r in out.collect()), key=repr)
    # u3 has no features: NULL feature, tenure -1 (left join keeps it)
    assert got == sorted([(0, 20.0, -1), (1, 10.0, 9), (1, None, -1)], key=repr)


def test_lookup_name_clash_and_missing_label(spark):
    labels = spark.createDataFrame([("u1", 1.0)], "user_id string, f double")
    feats = spark.createDataFrame([("u1", 2.0)], "user_id string, f double")
    with pytest.raises(ValueError):
        training_set(labels, FeatureSpec(lookups=[FeatureLookup("t", "user_id")]), {"t": feats})
    with pytest.raises(KeyError):
        training_set(labels, FeatureSpec(label="nope"), {"t": feats})


def test_keys_unique_duplicate_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    r = key_report(df, "k").first().asDict()
    assert r == {"rows": 5, "distinct_keys": 2, "null_keys": 2, "duplicate_keys": 1, "duplicate_rows": 2}
    v = sorted((r.v, r.violation) for r in key_violations(df, "k").collect())
    assert v == [("b", "duplicate_key"), ("c", "duplicate_key"), ("d", "null_key"), ("e", "null_key")]
    with pytest.raises(KeyViolation):
        require_key(df, "k")
    require_key(df.filter("v in ('a', 'b')"), "k")


def test_requests_order_duplicates_and_errors(spark):
    df = spark.createDataFrame(
        [(1, '{"inputs":[{"user_id":"b"},{"user_id":"a"},{"user_id":"b"}]}'),
         (2, '{"inputs":[{"user_id":"x"}'), (3, '{"other": 1}'), (4, '{"inputs":[]}')],
        "request_id long, body string")
    got = [(r.request_id, r.pos, r.user_id) for r in read_requests(df).orderBy("request_id", "pos").collect()]
    assert got == [(1, 0, "b"), (1, 1, "a"), (1, 2, "b")]
    assert sorted(r.request_id for r in request_errors(df).collect()) == [2, 3, 4]


def test_schema_contract(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "trip_distance double, fare_amount double")
    c = contract_of(a, ["trip_distance"])
    assert check_contract(a, c) == []
    b = spark.createDataFrame([("1",)], "trip_distance string")
    assert check_contract(b, c)[0]["problem"] == "type"
    assert check_contract(b.withColumnRenamed("trip_distance", "x"), c)[0]["problem"] == "missing"


def test_log_loss_clipping_and_zero_division(spark):
    from tessera.operators.metrics import classification_metrics
    df = spark.createDataFrame([(1, 1, 1.0), (0, 1, 1.0)], "y int, p int, prob double")
    r = classification_metrics(df, "y", "p", "prob", by=[]).first()
    assert r.tp == 1 and r.fp == 1 and r.recall == 1.0 and r.precision == 0.5
    q = min(max(1.0, 1e-15), 1 - 1e-15)  # clipped in double arithmetic
    assert math.isclose(r.log_loss, (-math.log(q) - math.log(1 - q)) / 2, rel_tol=1e-9)
    one = classification_metrics(df.filter("y = 0"), "y", "p", by=[]).first()
    assert one.recall == 0.0 and one.f1 == 0.0  # 0/0 -> 0
