import os

import pytest

from tessera.session import remove_scratch, scratch_folder, scratch_path, written


def files_below(path):
    path = path.removeprefix("file:")
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs]


def test_intermediates_go_with_their_folder(spark):
    df = spark.range(10)
    kept = scratch_path(spark, "result")
    with scratch_folder(spark, "outer") as outer:
        a = written(df, "a")
        with scratch_folder(spark, "inner") as inner:
            written(a, "b")
            assert inner.startswith(outer) and files_below(inner)
        assert not files_below(inner) and files_below(outer)
        a.write.parquet(kept)
    assert not files_below(outer)
    assert spark.read.parquet(kept).count() == 10


def test_folder_goes_after_an_error_too(spark):
    with pytest.raises(RuntimeError):
        with scratch_folder(spark, "failing") as path:
            written(spark.range(3), "a")
            raise RuntimeError
    assert not files_below(path)
    assert path not in scratch_path(spark, "next")


def test_remove_all(spark):
    out = written(spark.range(5), "rows")
    assert out.count() == 5
    path = scratch_path(spark, "rows")
    with scratch_folder(spark, "open"):
        with pytest.raises(ValueError):
            remove_scratch(spark)
    remove_scratch(spark)
    assert not files_below(os.path.dirname(path))
    assert written(spark.range(5), "rows").count() == 5
