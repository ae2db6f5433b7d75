import pytest

from tessera.plans.model import RUN_SCHEMA, compare_runs, read_runs, run_record, store_run

HIGHER = {"mae": False, "r2": True}


def record(spark, run_id, rows, params=None):
    metrics = spark.createDataFrame(rows, "split string, mae double, r2 double, n long")
    return run_record(spark, run_id, params or {}, metrics, ["t"])


def test_runs_are_stored_read_and_compared(spark, tmp_path):
    store = str(tmp_path / "runs")
    assert store_run(record(spark, "a", [("val", 2.0, 0.5, 9)], {"depth": 3}), store) == "a"
    store_run(record(spark, "007", [("val", 9.0, 0.9, 9)]), store)
    store_run(record(spark, "b", [("val", 2.0, 0.9, 9), ("test", float("nan"), None, 9)]), store)
    store_run(record(spark, "007", [("val", 1.0, 0.9, 9)]), store)  # again: replaces itself
    runs = read_runs(spark, store)
    assert sorted(r.run_id for r in runs.filter("kind = 'metric' and name = 'mae' and split = 'val'").collect()) == ["007", "a", "b"]
    assert {r.value_text for r in runs.filter("kind = 'param'").collect()} == {"3"}
    got = {(r.split, r.name, r.run_id): (r.value_num, r.baseline_value, r.change, r.place) for r in compare_runs(runs, "a", HIGHER).collect()}
    assert got["val", "mae", "a"] == (2.0, 2.0, 0.0, 2)
    assert got["val", "mae", "007"] == (1.0, 2.0, -1.0, 1)
    assert got["val", "mae", "b"] == (2.0, 2.0, 0.0, 2)  # equal values share a place
    assert [got["val", "r2", x][3] for x in ("007", "b", "a")] == [1, 1, 3]
    assert got["test", "r2", "b"] == (None, None, None, None)
    assert got["test", "mae", "b"][3] is None and got["test", "mae", "b"][1] is None
    assert not any(k[1] == "n" for k in got)
    plan = runs.filter("run_id = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_metrics_without_splits_meet_their_baseline(spark, tmp_path):
    store = str(tmp_path / "runs")
    for run_id, mae in (("a", 2.0), ("b", 1.5)):
        store_run(run_record(spark, run_id, {}, spark.createDataFrame([(mae,)], "mae double"), []), store)
    got = {r.run_id: (r.split, r.change, r.place) for r in compare_runs(read_runs(spark, store), "a", HIGHER).collect()}
    assert got == {"a": (None, 0.0, 2), "b": (None, -0.5, 1)}


def test_a_store_takes_one_well_named_run(spark, tmp_path):
    rows = [("a", "param", None, "k", None, "v"), ("b", "param", None, "k", None, "v")]
    for bad in (rows, [], [("a/b", *rows[0][1:])], [(None, *rows[0][1:])]):
        with pytest.raises(ValueError):
            store_run(spark.createDataFrame(bad, RUN_SCHEMA), str(tmp_path / "runs"))
