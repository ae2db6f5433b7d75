"""Binned densities against exact sums; change capture by bucket digests."""

import glob
import math
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.digests import (BUCKET, compare_digests, digest_changes, digests, read_bucketed, read_digests,
                                       write_bucketed)
from tessera.operators.keys import snapshot_changes
from tessera.operators.stats import kde, kde2, kde2_binned, kde_binned, linear_grid


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(0)
    x = np.concatenate((r.normal(size=3000), r.normal(4, 0.2, 1500), [1e6, -1e6, 0.0]))
    rows = [(float(a), float(b)) for a, b in zip(x, x * 0.5 + r.normal(size=len(x)))]
    return spark.createDataFrame(rows + [(None, 1.0), (float("nan"), 2.0), (1.0, None)], "x double, y double").cache()


@pytest.mark.parametrize("m", [4, 32])
def test_binned_density_is_within_its_bound(points, m):
    grid, h = linear_grid(-4.0, 8.0, 37), 0.3
    exact = {r.gi: r.density for r in kde(points, "x", grid, h).collect()}
    got = {r.gi: r.density for r in kde_binned(points, "x", grid, h, m).collect()}
    bound = 1 / (8 * m * m) / (h * math.sqrt(2 * math.pi))
    assert set(got) == set(exact) and max(abs(got[i] - exact[i]) for i in exact) <= bound
    assert max(exact.values()) > 100 * bound or m == 4


@pytest.mark.parametrize("m", [4, 16])
def test_binned_density_of_pairs_is_within_its_bound(points, m):
    gx, gy, h = linear_grid(-3.0, 5.0, 9), linear_grid(-2.0, 4.0, 7), (0.4, 0.5)
    pairs = points.where("not isnan(x)")
    exact = {(r.gx, r.gy): r.density for r in kde2(pairs, "x", "y", gx, gy, h).collect()}
    got = {(r.gx, r.gy): r.density for r in kde2_binned(points, "x", "y", gx, gy, h, m).collect()}
    bound = 1 / (4 * m * m) / (2 * math.pi * h[0] * h[1])
    assert set(got) == set(exact) and max(abs(got[i] - exact[i]) for i in exact) <= bound


def test_binning_shuffles_nodes_not_rows(spark):
    """Twenty times the rows leave about as many nodes."""
    def nodes(n):
        df = spark.range(n, numPartitions=2).select((F.xxhash64("id") % 1000 / 100.0).alias("x"))
        d = kde_binned(df, "x", [0.0, 1.0], 1.0, 8)
        assert d.count() == 2
        return d
    plan = nodes(100_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") >= 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_rows_and_nothing_near_the_grid(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert kde_binned(none, "x", [0.0, 1.0]).count() == 0 and kde2_binned(none, "x", "y", [0.0], [0.0]).count() == 0
    far = spark.createDataFrame([(1e9,), (2e9,)], "x double")
    assert kde_binned(far, "x", [0.0], 1.0).count() == 0


SCHEMA = "k long, g string, v double, a array<string>"


def table(seed, n):
    r = random.Random(seed)
    return {i: (i, r.choice([None, "x", "y"]), r.choice([0.0, -0.0, None, r.random()]), r.choice([None, ["a"], ["a", None], [None, "a"]])) for i in range(n)}


def edited(rows, seed, n):
    r = random.Random(seed)
    out = dict(rows)
    for i in r.sample(sorted(rows), n):
        kind = r.randrange(4)
        if kind == 0:
            del out[i]
        elif kind == 1:
            out[i + 10 ** 6] = (i + 10 ** 6, *rows[i][1:])
        elif kind == 2:
            out[i] = (i, "changed", *rows[i][2:])
        else:
            out[i] = (*rows[i][:3], [None, None, "b"])
    return out


def canon(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("edits", [0, 5, 300])
def test_digest_changes_equal_the_full_comparison(spark, edits):
    before = table(1, 2000)
    after = edited(before, 2, edits)
    b, a = (spark.createDataFrame(list(x.values()), SCHEMA) for x in (before, after))
    want = canon(snapshot_changes(b, a, "k"))
    assert canon(digest_changes(b, a, "k", buckets=512)) == want
    assert (edits == 0) == (want == [])
    differs = compare_digests(digests(b, "k", 512), digests(a, "k", 512)).where("differs").count()
    assert differs <= 2 * edits


def test_swapped_values_and_nulls_differ(spark):
    """Nothing cancels: rows that trade values, NULLs that move."""
    b = spark.createDataFrame([(1, "x", 1.0, ["a", None]), (2, "y", 2.0, None), (3, None, None, [None])], SCHEMA)
    a = spark.createDataFrame([(1, "y", 1.0, ["a", None]), (2, "x", 2.0, None), (3, None, None, [])], SCHEMA)
    assert canon(digest_changes(b, a, "k", buckets=1)) == canon(snapshot_changes(b, a, "k"))
    c = spark.createDataFrame([(1, "x", 1.0, [None, "a"]), (2, "y", 2.0, None), (3, None, None, [None])], SCHEMA)
    assert {r.k for r in digest_changes(b, c, "k", buckets=2).collect()} == {1}


def test_stored_snapshots_are_read_in_changed_buckets_alone(spark):
    d = tempfile.mkdtemp(prefix="tessera-digest-")
    before = table(3, 1500)
    after = edited(before, 4, 3)
    b, a = (spark.createDataFrame(list(x.values()), SCHEMA) for x in (before, after))
    for df, name in ((b, "b"), (a, "a")):
        write_bucketed(df, f"{d}/{name}", "k", 64)
    sb, sa = read_bucketed(spark, d + "/b"), read_bucketed(spark, d + "/a")
    out = digest_changes(sb, sa, "k", 64, read_digests(spark, d + "/b"), read_digests(spark, d + "/a"))
    assert BUCKET not in out.columns
    assert canon(out) == canon(snapshot_changes(b, a, "k"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and "PartitionFilters: []" not in plan
    differs = compare_digests(read_digests(spark, d + "/b"), read_digests(spark, d + "/a")).where("differs")
    changed = {str(r[BUCKET]) for r in differs.collect()}
    assert 1 <= len(changed) <= 6  # of 64
    # files of the other buckets are not opened: they may be unreadable (inputFiles() lists them all the same)
    spoiled = [f for f in glob.glob(f"{d}/*/rows/{BUCKET}=*/*.parquet") if f.split(BUCKET + "=")[1].split("/")[0] not in changed]
    assert len(spoiled) > 100
    for f in spoiled:
        with open(f, "wb") as out_file:
            out_file.write(b"no parquet")
    again = digest_changes(sb, sa, "k", 64, read_digests(spark, d + "/b"), read_digests(spark, d + "/a"))
    assert canon(again) == canon(snapshot_changes(b, a, "k"))


def test_keys_of_two_columns_and_empty_sides(spark):
    b = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], "x int, y string, v double")
    a = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.0)], "x int, y string, v double")
    assert canon(digest_changes(b, a, ["x", "y"], 16)) == canon(snapshot_changes(b, a, ["x", "y"]))
    none = b.limit(0)
    assert canon(digest_changes(none, a, ["x", "y"], 16)) == canon(snapshot_changes(none, a, ["x", "y"]))
    assert digest_changes(none, none, ["x", "y"], 16).count() == 0
