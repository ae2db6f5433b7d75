"""Heavy-key lookups, Python feature functions, requests taken once."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.plans.features import (FeatureFunction, FeatureLookup, FeatureSpec, assemble, heavy_keys, lookup, lookup_heavy,
                                    register_python_function)
from tessera.streaming.score import run_requests


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def frames(spark, n=30_000):
    """A third of the rows has one key; NULL and unknown keys too."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).when(F.col("id") % 50 == 2, -1).otherwise(F.col("id") % 900)
    left = spark.range(n, numPartitions=6).select("id", key.cast("bigint").alias("k"), F.array("id").alias("extra"))
    right = spark.range(900).select(F.col("id").alias("k"), F.concat(F.lit("f"), "id").alias("f"), F.lit(1).alias("unused"))
    return left, right


def test_heavy_keys_are_found(spark):
    left, _ = frames(spark)
    assert [tuple(r) for r in heavy_keys(left, ["k"], 1000).collect()] == [(7, 11)]
    two = left.withColumn("s", F.lit("it's"))
    assert [tuple(r) for r in heavy_keys(two, ["k", "s"], 1000).collect()] == [(7, "it's", 11)]
    assert heavy_keys(left, ["k"], 20_000).isEmpty()


def test_a_heavy_key_is_dealt_to_many_tasks(spark, no_broadcast):
    left, right = frames(spark)
    fl = FeatureLookup("t", "k", ["f"])
    out = lookup_heavy(left, fl, right, rows_per_task=1000)
    assert out.columns == ["id", "k", "extra", "f"]
    tasks = out.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 0.6 * left.where("k = 7").count()
    assert len(lookup(left, fl, right).where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()) == 1
    want = sorted(map(str, lookup(left, fl, right).collect()))
    assert sorted(map(str, out.collect())) == want and len(want) == 30_000


def test_lookup_without_heavy_keys_and_clashes(spark):
    left, right = frames(spark, 300)
    fl = FeatureLookup("t", "k")
    assert sorted(map(str, lookup_heavy(left, fl, right).collect())) == sorted(map(str, lookup(left, fl, right).collect()))
    with pytest.raises(ValueError):
        lookup_heavy(left, FeatureLookup("t", "k", ["extra"]), right.withColumn("extra", F.lit(1)), rows_per_task=10)


def test_python_function_as_feature_function(spark):
    def grade(score, bonus, limit=10):
        return None if score is None else ("high" if score + (bonus or 0) > limit else "low")
    register_python_function("grade", grade, "string", replace=True)
    spec = FeatureSpec(functions=[FeatureFunction("grade", {"score": "s", "bonus": "b"}, "g", {"limit": 4})])
    df = spark.createDataFrame([(1, 2.0, 3), (2, 2.0, None), (3, None, 1)], "id int, s double, b int")
    spec = FeatureSpec.from_json(spec.to_json())
    assert {r.id: r.g for r in assemble(df, spec).collect()} == {1: "high", 2: "low", 3: None}
    with pytest.raises(ValueError):
        register_python_function("grade", grade, "string")


def body(*users):
    return '{"inputs": [' + ", ".join('{"user_id": "%s"}' % u for u in users) + "]}"


def test_requests_are_taken_once_and_errors_kept(spark):
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    batches = [[(1, body("a", "b"), at(0)), (2, "{oops", at(0)), (3, body("zz"), at(1)), (1, body("a", "b"), at(0))],
               [(1, body("a", "b"), at(2)), (2, "{oops", at(2)), (4, body(), at(2)), (5, None, at(3)), (6, body("b", "b"), at(3))],
               [(6, body("b", "b"), at(4)), (7, body("a"), at(4))]]
    src = tempfile.mkdtemp(prefix="tessera-req-")
    schema = "request_id long, body string, sent_at timestamp"
    feats = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "user_id string, x double")
    score = lambda df: df.select("request_id", "pos", "user_id", (F.col("x") * 2).alias("y"))
    out = tempfile.mkdtemp(prefix="tessera-req-out-")
    for i, rows in enumerate(batches):  # a restart after each batch: the state goes on
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/part={i}")
        sdf = spark.readStream.schema(schema).parquet(src + "/part=*")
        scores, errors = run_requests(sdf, feats, "user_id", score, out + "/o", out + "/ck", delay="10 hours")
    got = sorted((r.request_id, r.pos, r.user_id, r.y) for r in scores.collect())
    assert got == [(1, 0, "a", 2.0), (1, 1, "b", 4.0), (3, 0, "zz", None), (6, 0, "b", 4.0), (6, 1, "b", 4.0), (7, 0, "a", 2.0)]
    assert sorted((r.request_id, r.body) for r in errors.collect()) == [(2, "{oops"), (4, '{"inputs": []}'), (5, None)]
