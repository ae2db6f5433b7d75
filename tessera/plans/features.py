"""Feature specifications and training-set assembly.

A spec is a small list of lookups and functions applied in order:

1. every :class:`FeatureLookup` left-joins its table onto the incoming frame
   by key (the incoming frame is the left side; unmatched keys keep NULL
   features);
2. every :class:`FeatureFunction` adds a column computed from columns present
   so far (looked-up columns included);
3. ``exclude`` columns are dropped last, so an excluded column can still feed a
   function.

Joins are plain equi joins: Spark (with AQE) broadcasts a side only when its
measured size is under the broadcast threshold and otherwise sort-merges; a
feature table written in buckets of its key (``write_table(..., buckets=n)``)
avoids the shuffle of that side.  Where single keys hold much of the left
frame, :func:`lookup_heavy` deals their rows to many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tenure import tenure_days
from ..operators.keys import require_key
from ..session import written


@dataclass
class FeatureLookup:
    """Join ``table`` on ``lookup_key``; ``feature_names=None`` takes
    every non-key column, a list takes those in the given order."""
    table_name: str
    lookup_key: str | list[str]
    feature_names: list[str] | None = None

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)


# Registry of expression-bodied feature functions by name (B5/B6).  Each
# builder receives Columns for its bound parameters plus fixed keyword
# arguments and returns a Column.
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "user_tenure": lambda creation_date_in, as_of=None: tenure_days(creation_date_in, as_of),
}


def register_feature_function(name: str, builder: Callable[..., Column], replace: bool = False) -> None:
    """Make a user's own function known to specs under ``name``.
    ``builder`` gets a Column per bound parameter, and the fixed parameters."""
    if name in FUNCTIONS and not replace:
        raise ValueError(f"feature function {name!r} is registered already")
    FUNCTIONS[name] = builder


def register_python_function(name: str, fn: Callable, returns: str, replace: bool = False) -> None:
    """Make a plain Python function of scalars known to specs under
    ``name``.  It runs in Python workers on Arrow batches of its bound
    parameters (None where one is missing); fixed parameters are passed on.
    ``returns`` is the type of its result.  A Column builder
    (:func:`register_feature_function`) stays in the engine: prefer it where
    built-in functions can say the same."""
    import pandas as pd

    def builder(**given) -> Column:
        names = [p for p, c in given.items() if isinstance(c, Column)]
        fixed = {p: c for p, c in given.items() if not isinstance(c, Column)}

        def batch(*series: pd.Series) -> pd.Series:
            rows = zip(*(s.astype(object).where(s.notna(), None) for s in series))
            return pd.Series([fn(**dict(zip(names, row)), **fixed) for row in rows], dtype=object)
        batch.__annotations__ = {"series": pd.Series, "return": pd.Series}
        return F.pandas_udf(batch, returns)(*[given[p] for p in names])
    register_feature_function(name, builder, replace)


@dataclass
class FeatureFunction:
    """``output_name = udf_name(**{param: col(input_bindings[param])})``."""
    udf_name: str
    input_bindings: dict[str, str]
    output_name: str
    params: dict = field(default_factory=dict)

    def column(self) -> Column:
        if self.udf_name not in FUNCTIONS:
            raise KeyError(f"unknown feature function {self.udf_name!r}; register_feature_function makes it known "
                           f"(known: {sorted(FUNCTIONS)})")
        fn = FUNCTIONS[self.udf_name]
        args = {p: F.col(c) for p, c in self.input_bindings.items()}  # P11
        return fn(**args, **self.params).alias(self.output_name)


@dataclass
class FeatureSpec:
    lookups: list[FeatureLookup] = field(default_factory=list)
    functions: list[FeatureFunction] = field(default_factory=list)
    label: str | None = None
    exclude: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> FeatureSpec:
        d = json.loads(text)
        return cls(lookups=[FeatureLookup(**x) for x in d["lookups"]],
                   functions=[FeatureFunction(**x) for x in d["functions"]],
                   label=d.get("label"), exclude=list(d.get("exclude", [])))


TableResolver = Callable[[str], DataFrame]


def _resolver(spark: SparkSession, tables: dict[str, DataFrame] | None) -> TableResolver:
    def resolve(name: str) -> DataFrame:
        if tables and name in tables:
            return tables[name]
        return spark.table(name)
    return resolve


def lookup(df: DataFrame, fl: FeatureLookup, feature_table: DataFrame, check_key: bool = False) -> DataFrame:
    """Left join of ``df`` with the feature columns of ``feature_table``.

    Only the wanted columns are selected before the join, so pruning reaches
    the scan.  A name clash with the left frame is an error.  A duplicated key
    in ``feature_table`` would multiply rows: ``check_key`` raises on one (an
    aggregation over the key columns).
    """
    if check_key:
        require_key(feature_table, fl.keys)
    keys = fl.keys
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"lookup key {missing} not in the input frame")
    names = fl.feature_names
    if names is None:
        names = [c for c in feature_table.columns if c not in keys]
    clash = [n for n in names if n in df.columns]
    if clash:
        raise ValueError(f"feature names already present in the input frame: {clash}")
    right = feature_table.select(*keys, *names)
    return df.join(right, keys, "left").select(*df.columns, *names)


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int, most: int = 256) -> DataFrame:
    """(keys..., _salts): keys with more than ``rows_per_task`` rows and the
    number of tasks that their rows need.  A heavy-hitter sketch (frequent
    items) finds the candidates in one pass; it tracks 16 x ``most`` keys, so
    none above that share of the rows is missed.  At most ``most`` rows."""
    key = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    text = F.to_json(F.struct(key.alias("k")))  # the sketch takes strings
    top = df.where(F.col(keys[0]).isNotNull()).agg(F.call_function("approx_top_k", text, F.lit(most), F.lit(16 * most)).alias("t"))
    types = ", ".join(f"`{k}`: {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"struct<k: struct<{types}>>" if len(keys) > 1 else f"struct<k: {df.schema[keys[0]].dataType.simpleString()}>"
    found = top.select(F.explode("t").alias("e")).where(F.col("e.count") > rows_per_task).select(
        F.from_json("e.item", schema).alias("j"), F.ceil(F.col("e.count") / rows_per_task).cast("int").alias("_salts"))
    names = [F.col(f"j.k.`{k}`").alias(k) for k in keys] if len(keys) > 1 else [F.col("j.k").alias(keys[0])]
    return found.select(*names, "_salts")


def lookup_heavy(df: DataFrame, fl: FeatureLookup, feature_table: DataFrame, rows_per_task: int = 1_000_000,
                 most: int = 256) -> DataFrame:
    """J1/J3 as :func:`lookup`, for left frames in which some keys are heavy.

    Rows of a heavy key get a salt from their content and partition, so a
    repeated task gives them the same one; that key's feature rows are copied
    once per salt.  All other rows and features have salt 0 and are joined
    plainly: nothing else is copied."""
    keys = fl.keys
    names = fl.feature_names if fl.feature_names is not None else [c for c in feature_table.columns if c not in keys]
    heavy = written(heavy_keys(df, keys, rows_per_task, most), "heavy_keys")
    if heavy.isEmpty():
        return lookup(df, fl, feature_table)
    plain = [c for c in df.columns if isinstance(df.schema[c].dataType, (T.AtomicType, T.NullType))]
    # ``most`` rows at most: a proven bound for the broadcast
    left = df.join(F.broadcast(heavy), keys, "left")
    left = left.withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.coalesce("_salts", F.lit(1)))).cast("int")).drop("_salts")
    right = feature_table.select(*keys, *names).join(F.broadcast(heavy), keys, "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    clash = [n for n in names if n in df.columns]
    if clash:
        raise ValueError(f"feature names already present in the input frame: {clash}")
    return left.join(right, [*keys, "_salt"], "left").select(*df.columns, *names)


def assemble(df: DataFrame, spec: FeatureSpec, tables: dict[str, DataFrame] | None = None,
             apply_exclude: bool = True, check_keys: bool = False) -> DataFrame:
    """J3 + B6 + P4: lookups left to right, then functions, then exclusions."""
    resolve = _resolver(df.sparkSession, tables)
    out = df
    needed = _needed_columns(spec)
    for fl in spec.lookups:
        table = resolve(fl.table_name)
        if fl.feature_names is None:
            names = [c for c in table.columns if c not in fl.keys]
        else:
            names = list(fl.feature_names)
        # A lookup whose every column is excluded and unused adds nothing: skip
        # its join (Spark cannot drop it since the table is not known distinct).
        if apply_exclude and all(n in spec.exclude and n not in needed for n in names):
            continue
        out = lookup(out, FeatureLookup(fl.table_name, fl.lookup_key, names), table, check_keys)
    for fn in spec.functions:
        out = out.withColumn(fn.output_name, fn.column())
    if apply_exclude and spec.exclude:
        out = out.drop(*[c for c in spec.exclude if c in out.columns and c != spec.label])
    return out


def _needed_columns(spec: FeatureSpec) -> set[str]:
    return {c for fn in spec.functions for c in fn.input_bindings.values()}


def training_set(labels: DataFrame, spec: FeatureSpec,
                 tables: dict[str, DataFrame] | None = None, check_keys: bool = False) -> DataFrame:
    """M8: assemble features onto the label frame; the label column must exist."""
    if spec.label and spec.label not in labels.columns:
        raise KeyError(f"label column {spec.label!r} not in the input frame")
    return assemble(labels, spec, tables, check_keys=check_keys)


def key_table(features: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The key-only frame used for batch scoring."""
    key = [key] if isinstance(key, str) else list(key)
    return features.select(*key)
