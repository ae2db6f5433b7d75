"""Column and row operators (P3, P5-P8, O3).  All are narrow projections or
filters; Catalyst pushes the not-null part of P5 into the scan and prunes
dropped columns from ``ReadSchema``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import unit_hash

_FLOATS = (T.FloatType, T.DoubleType)


def drop_columns(df: DataFrame, names: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop by name, the rest keeps its order.  ``strict`` raises on a
    name that is not there (the pandas form); ``strict=False`` ignores it."""
    missing = [n for n in names if n not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[n for n in names if n in df.columns])


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in float columns, so NULL is the only missing value."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _FLOATS):
            out.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def drop_missing(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """P5: drop rows with a missing value (NULL or NaN) in any (or all) of the
    columns.  Run it after :func:`drop_columns` so dropped columns do not
    remove rows."""
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def label_features(df: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """The label stays in the same row; returns the frame with the label
    last and the list of feature columns."""
    feats = [c for c in df.columns if c != label]
    return df.select(*feats, label), feats


def sample_rows(df: DataFrame, fraction: float, key: str | Sequence[str] | None = None,
                seed: int = 42) -> DataFrame:
    """Sample without replacement.  With ``key`` the sample is repeatable
    (a key hash, the same one the splits use); without it, Bernoulli sampling."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.filter(unit_hash(key, seed) < F.lit(float(fraction)))


def stack_frames(*dfs: DataFrame) -> DataFrame:
    """O3: bag union of frames with equal columns (duplicates kept)."""
    if not dfs:
        raise ValueError("nothing to stack")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def top_k(df: DataFrame, by: Sequence[str | Column], k: int) -> DataFrame:
    """O2: the first ``k`` rows in the order of ``by`` (each task keeps ``k``)."""
    return df.orderBy(*by).limit(k)
