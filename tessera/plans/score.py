"""Scoring (B1-B4, J6): models as columns over DataFrames.

A fitted ``PipelineModel`` scores inside the JVM (no Python worker); a
one-feature line is a closed-form expression; an arbitrary Python model is
loaded once per task and fed Arrow batches (``mapInPandas``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package


def score_linear(df: DataFrame, fit: DataFrame, x: str, output: str = "predictions") -> DataFrame:
    """B2 for the one-feature line: ``intercept + slope * x``.  ``fit`` is the
    one-row result of :func:`tessera.operators.stats.ols`; its coefficients
    enter as scalar subqueries, so the plan stays lazy and has no join."""
    slope = fit.select("slope").scalar()
    icpt = fit.select("intercept").scalar()
    return df.select(*df.columns, (icpt + slope * F.col(x).cast("double")).alias(output))


def score_with(df: DataFrame, load_fn: Callable[[], object], inputs: Sequence[str],
               output: str = "predictions", result_type: T.DataType = T.DoubleType()) -> DataFrame:
    """Any Python model with ``predict(pandas.DataFrame)``.  ``load_fn`` runs
    once per task, batches arrive through Arrow."""
    ship_package(df.sparkSession)
    inputs = list(inputs)
    schema = T.StructType(df.schema.fields + [T.StructField(output, result_type)])

    def run(batches):
        model = load_fn()
        for pdf in batches:
            pdf[output] = model.predict(pdf[inputs])
            yield pdf

    return df.mapInPandas(run, schema)

