"""Sources and sinks: CSV with typed dates, catalog tables with keys, CTAS,
insert, drop, parameterised scan, JSON sink."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.keys import KeyViolation
from tessera.sources import tables as tb


def test_read_csv_date_positions(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    with open(os.path.join(d, "f.csv"), "w") as f:
        f.write("user_id,created,score,last\nu1,2024-11-01 10:00:00,1.5,2024-11-02\n"
                "u2,,2.5,not a date\n")
    df = tb.read_csv(spark, d, date_positions=[1, 3])
    rows = {r.user_id: r for r in df.collect()}
    assert dict(df.dtypes)["created"] == "timestamp_ntz"
    assert rows["u1"].created == dt.datetime(2024, 11, 1, 10, 0)
    assert rows["u2"].created is None and rows["u2"].last is None  # empty and bad -> missing


def test_keyed_table_lifecycle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tdb")
    tb.use(spark, db="tdb")
    tb.drop_table(spark, "ml_user_ids")
    tb.create_keyed_table(spark, "ml_user_ids", "user_id STRING", ["user_id"])
    tb.create_keyed_table(spark, "ml_user_ids", "user_id STRING", ["user_id"])  # no-op
    assert tb.table_key(spark, "ml_user_ids") == ["user_id"]
    src = spark.createDataFrame([("a",), ("b",)], "user_id string")
    tb.append_keyed(src, "ml_user_ids")
    with pytest.raises(KeyViolation):
        tb.append_keyed(spark.createDataFrame([("a",)], "user_id string"), "ml_user_ids")
    df, key = tb.read_keyed(spark, "ml_user_ids")
    assert key == ["user_id"] and sorted(r.user_id for r in df.collect()) == ["a", "b"]
    assert tb.scan_param(spark, "tdb.ml_user_ids").count() == 2
    assert tb.preview(tb.scan(spark, "ml_user_ids"), 1).count() == 1
    tb.drop_table(spark, "ml_user_ids")
    tb.drop_table(spark, "ml_user_ids")  # no error when absent
    assert not spark.catalog.tableExists("tdb.ml_user_ids")


def test_overwrite_and_ctas(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tdb")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    tb.write_table(a, "tdb.feat", key=["k"])
    tb.write_table(a.withColumn("w", F.lit(2)), "tdb.feat", key=["k"])  # schema replaced
    assert spark.table("tdb.feat").columns == ["k", "v", "w"]
    with pytest.raises(KeyViolation):
        tb.write_table(a.unionByName(a), "tdb.feat", key=["k"])
    assert tb.ctas_if_absent(a, "tdb.taxi") is True
    assert tb.ctas_if_absent(a.unionByName(a), "tdb.taxi") is False  # left untouched
    assert spark.table("tdb.taxi").count() == 1


def test_write_scored_json(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tessera-json-"), "eval")
    df = spark.createDataFrame([(1.0, 0, 0.0)], "x double, churn_label int, predictions double")
    tb.write_scored(df, d)
    back = spark.read.json(d)
    assert back.count() == 1 and set(back.columns) == {"x", "churn_label", "predictions"}
