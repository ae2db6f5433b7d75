"""CSV records with quotes, line breaks and bad cells; tables clustered by key."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.keys import KeyViolation
from tessera.plans.features import FeatureLookup, lookup
from tessera.sources import tables as tb

PROBE = '''id,note,day,amount
1,"a ""b"" c",2024-01-02,1.5
2,"two
lines, and a comma",2024-01-03 04:05:06,2
3,,not a date,
4,"",,3.25
'''


def folder(text, name="f.csv"):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write(text)
    return d


def test_quotes_line_breaks_types_and_dates(spark):
    d = folder(PROBE)
    df = tb.read_csv(spark, d, date_positions=[2])
    assert dict(df.dtypes) == {"id": "int", "note": "string", "day": "timestamp_ntz", "amount": "double"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 'a "b" c', dt.datetime(2024, 1, 2), 1.5), (2, "two\nlines, and a comma", dt.datetime(2024, 1, 3, 4, 5, 6), 2.0),
        (3, None, None, None), (4, None, None, 3.25)]
    bad = tb.csv_errors(spark, d, date_positions=[2]).collect()
    assert [(r.id, r._bad) for r in bad] == [(3, ["day"])]


def test_given_types_and_broken_records(spark):
    d = folder("a,b,c\n1,x,2024-01-01\noops,y,2024-01-02\n3,z\n4,w,2024-01-04,extra\n5,v,31/12/2024\n")
    schema = "a int, b string, c string"
    df = tb.read_csv(spark, d, schema, date_positions=[2])
    assert df.columns == ["a", "b", "c"]
    rows = {r.b: (r.a, r.c) for r in df.collect()}
    assert rows == {"x": (1, dt.datetime(2024, 1, 1)), "y": (None, dt.datetime(2024, 1, 2)), "z": (3, None),
                    "w": (4, dt.datetime(2024, 1, 4)), "v": (5, None)}
    bad = {r.b: (r._bad, r._corrupt_record) for r in tb.csv_errors(spark, d, schema, date_positions=[2]).collect()}
    assert bad == {"y": (None, "oops,y,2024-01-02"), "z": (None, "3,z"), "w": (None, "4,w,2024-01-04,extra"), "v": (["c"], None)}


def test_no_header_and_header_only(spark):
    df = tb.read_csv(spark, folder("1,a\n2,b\n"), "n int, s string", header=False)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a"), (2, "b")]
    assert tb.read_csv(spark, folder("n,s\n"), "n int, s string").count() == 0
    assert tb.csv_errors(spark, folder("n,s\n"), "n int, s string").count() == 0


def test_key_names_with_commas_and_quotes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], ["it's, a key", "v"])
    tb.write_table(df, "odd_key", ["it's, a key"])
    assert tb.table_key(spark, "odd_key") == ["it's, a key"]
    with pytest.raises(KeyViolation):
        tb.append_keyed(df.limit(1), "odd_key")
    tb.drop_table(spark, "odd_key")


def test_lookup_in_a_clustered_table_has_no_exchange_of_it(spark):
    feats = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    tb.write_table(feats, "feats_by_key", ["k"], buckets=8)
    tb.create_keyed_table(spark, "empty_by_key", "k BIGINT, x BIGINT", ["k"], buckets=8)
    assert tb.table_key(spark, "feats_by_key") == ["k"] == tb.table_key(spark, "empty_by_key")
    tb.append_keyed(feats.limit(10), "empty_by_key")
    assert spark.table("empty_by_key").count() == 10
    left = spark.range(300).select((F.col("id") * 7).alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = lookup(left, FeatureLookup("feats_by_key", "k"), spark.table("feats_by_key"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the labels go to the table's buckets, the table stays where it is
        assert plan.count("Exchange") == 1 and "hashpartitioning(k" in plan
        side = plan[plan.index("FileScan parquet"):] if plan.index("FileScan parquet") > plan.index("Exchange") else plan
        assert "SelectedBucketsCount: 8 out of 8" in side
        both = spark.table("feats_by_key").select("k").join(spark.table("feats_by_key"), "k")
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        assert {(r.k, r.x) for r in out.collect()} == {(7 * i, 14 * i) for i in range(300)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tb.drop_table(spark, "feats_by_key")
    tb.drop_table(spark, "empty_by_key")
