"""Mergeable profiles and streaming sketches."""

import datetime as dt
import os
import random
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.drift import profile
from tessera.operators.keys import snapshot_changes
from tessera.operators.profile_state import merge_states, profile_state, state_profile, update_state
from tessera.streaming.profile import late_rows, latest_by_key, run_available_now, stream_profile

WIDTH, ORIGIN = "1 day", "2024-01-01"
SCHEMA = "id long, at timestamp_ntz, x double, c string"


def events(seed, n, days=4, first=0):
    r = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    return [(first + i, day + dt.timedelta(days=r.random() * days), r.choice([None, float("nan"), r.gauss(1e6, 3), r.gauss(1e6, 3)]),
             r.choice([None, "a", f"v{r.randrange(200)}"])) for i in range(n)]


def rows(df):
    return {(r.k, r.column): r for r in df.collect()}


def same(got, want, rank_error=0.02, data=None):
    assert set(got) == set(want)
    for key, w in want.items():
        g = got[key]
        assert (g.n, g.nulls, g.window) == (w.n, w.nulls, w.window)
        assert (g.min, g.max) == (w.min, w.max)
        assert g.mean == (None if w.mean is None else pytest.approx(w.mean, rel=1e-12))
        assert g.std == (None if w.std is None else pytest.approx(w.std, rel=1e-6))
        assert abs(g.distinct - w.distinct) <= 0.05 * w.distinct
        if data and w.p50 is not None:
            for q, v in ((0.25, g.p25), (0.5, g.p50), (0.75, g.p75)):
                below = sum(x <= v for x in data[key]) / len(data[key])
                assert abs(below - q) <= rank_error + 1 / len(data[key])


def values(rs):
    out = {}
    for _, at, x, _ in rs:
        if x is not None and x == x:
            out.setdefault(((at - dt.datetime(2024, 1, 1)).days, "x"), []).append(x)
    return out


def test_merged_states_equal_the_whole(spark):
    parts = [events(i, n, first=10_000 * i) for i, n in enumerate((900, 1, 40, 700))]
    whole = [r for p in parts for r in p]
    states = [profile_state(spark.createDataFrame(p, SCHEMA), "at", WIDTH, ORIGIN, ["x", "c"]) for p in parts]
    merged = states[0]
    for s in states[1:]:
        merged = merge_states(s, merged)
    want = rows(profile(spark.createDataFrame(whole, SCHEMA), "at", WIDTH, ORIGIN, ["x", "c"]))
    same(rows(state_profile(merged, WIDTH, ORIGIN)), want, data=values(whole))


def test_update_by_a_change_set(spark):
    before = events(5, 1500)
    r = random.Random(1)
    after = [(i, at, x + 1 if at.day == 3 and x and r.random() < 0.3 else x, c) for i, at, x, c in before if at.day != 4 or r.random() < 0.9]
    after += [(90_000 + i, dt.datetime(2024, 1, 1 + i % 6, 5), float(i), "new") for i in range(60)]
    b, a = (spark.createDataFrame(x, SCHEMA) for x in (before, after))
    state = profile_state(b, "at", WIDTH, ORIGIN, ["x", "c"])
    changes = snapshot_changes(b, a, "id")
    got = rows(state_profile(update_state(state, changes, a, "at", WIDTH, ORIGIN, ["x", "c"]), WIDTH, ORIGIN))
    same(got, rows(profile(a, "at", WIDTH, ORIGIN, ["x", "c"])), data=values(after))


def test_inserts_read_no_stored_row(spark):
    d = tempfile.mkdtemp(prefix="tessera-state-")
    before, new = events(7, 500), events(8, 30, first=5000)
    spark.createDataFrame(before + new, SCHEMA).write.parquet(d + "/after")
    after = spark.read.parquet(d + "/after")
    spark.createDataFrame(before, SCHEMA).write.parquet(d + "/before")
    state = profile_state(spark.read.parquet(d + "/before"), "at", WIDTH, ORIGIN, ["x", "c"])
    state.write.parquet(d + "/state")
    inserts = spark.createDataFrame(new, SCHEMA).withColumn("change", F.lit("insert"))
    out = update_state(spark.read.parquet(d + "/state"), inserts, after, "at", WIDTH, ORIGIN, ["x", "c"])
    assert not any("/after" in f for f in out.inputFiles())
    same(rows(state_profile(out, WIDTH, ORIGIN)), rows(profile(after, "at", WIDTH, ORIGIN, ["x", "c"])))
    # one rewritten window: its rows are read behind a range filter that reaches the scan
    pre = spark.createDataFrame(before[:1], SCHEMA)
    one = pre.withColumn("change", F.lit("update_preimage")).unionByName(pre.withColumn("change", F.lit("update_postimage")))
    plan = update_state(spark.read.parquet(d + "/state"), one, after, "at", WIDTH, ORIGIN, ["x", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan


def test_empty_inputs(spark):
    none = spark.createDataFrame([], SCHEMA)
    state = profile_state(none, "at", WIDTH, ORIGIN, ["x", "c"])
    assert state.count() == 0
    a = spark.createDataFrame(events(3, 50), SCHEMA)
    changes = snapshot_changes(none, a, "id")
    got = rows(state_profile(update_state(state, changes, a, "at", WIDTH, ORIGIN, ["x", "c"]), WIDTH, ORIGIN))
    same(got, rows(profile(a, "at", WIDTH, ORIGIN, ["x", "c"])))


def stream_of(spark, batches):
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{d}/b{i}")
        os.utime(next(f"{d}/b{i}/{f}" for f in os.listdir(f"{d}/b{i}") if f.endswith(".parquet")), (1_700_000_000 + i, 1_700_000_000 + i))
    return d, spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(d + "/b*")


def test_stream_sketches_and_late_rows(spark):
    day = dt.datetime(2024, 1, 1)
    at = lambda d, h, i: day + dt.timedelta(days=d, hours=h, seconds=i)
    first = [(i, at(0, 1, i), float(i % 301), f"v{i % 90}") for i in range(3000)]
    second = [(4000 + i, at(3, 2, i), float(i % 17), "z") for i in range(500)]
    # two batches on, the watermark is in day 2: day 0 is over, day 3 is not
    more = [(4600 + i, at(3, 3, i), 1.0, "z") for i in range(5)]
    third = [(5000 + i, at(0, 5, i), 1e9, "late") for i in range(40)] + [(6000 + i, at(3, 4, i), 99.0, "y") for i in range(10)]
    d, sdf = stream_of(spark, [first, second, more, third])
    agg = stream_profile(sdf, "at", WIDTH, ORIGIN, ["x", "c"], delay="1 day", sketches=True)
    run_available_now(agg, d + "/out", d + "/ck", transform=lambda b: b.withColumn("k", F.datediff("w.start", F.lit("2024-01-01"))).drop("w"))
    got = {(r.k, r.column): r for r in latest_by_key(spark, d + "/out", ["k", "column"]).collect()}
    assert {k: (r.n, r.nulls) for k, r in got.items()} == {(0, "x"): (3000, 0), (0, "c"): (3000, 0), (3, "x"): (515, 0), (3, "c"): (515, 0)}
    assert abs(got[0, "x"].distinct - 301) <= 12 and abs(got[0, "c"].distinct - 90) <= 4 and got[3, "c"].distinct == 2
    xs = sorted(r[2] for r in first)
    assert (got[0, "x"].p25, got[0, "x"].p50, got[0, "x"].p75) == tuple(pytest.approx(xs[int(q * 3000) - 1], abs=1) for q in (0.25, 0.5, 0.75))
    assert got[0, "c"].p50 is None and got[0, "x"].std == pytest.approx(statistics.stdev(xs))
    d, sdf = stream_of(spark, [first, second, more, third])
    late = late_rows(spark, sdf, "at", WIDTH, ORIGIN, d + "/late", d + "/ck", delay="1 day")
    assert [(r.n, r.late) for r in late.orderBy("batch").collect()] == [(3000, 0), (500, 0), (5, 0), (50, 40)]
