"""Model metrics as distributed aggregates (A3, A4, A5).

Textbook definitions; 0/0 is reported as 0.0.  Each metric table is one
``groupBy(split)`` aggregate; AUCs pre-aggregate to distinct scores and use
the distributed running totals, so no split is ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .prefix import running_totals

EPS = 1e-15


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str,
                           probability: str | None = None, by: Sequence[str] = ("split",),
                           positive: int = 1) -> DataFrame:
    """A3: n, tp, fp, tn, fn, accuracy, precision, recall, f1 (and log_loss
    with a probability of the positive class, clipped to [1e-15, 1 - 1e-15]).
    A row without a label or prediction counts in none of them."""
    df = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn")]
    if probability:
        q = F.least(F.greatest(F.col(probability).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
        aggs.append(F.avg(-F.when(y, F.log(q)).otherwise(F.log(1 - q))).alias("log_loss"))
    g = df.groupBy(*by).agg(*aggs)
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = g.select(*by, "n", "tp", "fp", "tn", "fn",
                   _ratio(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
                   precision.alias("precision"), recall.alias("recall"),
                   *(["log_loss"] if probability else []))
    return out.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                       F.col("precision") + F.col("recall")))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ("split",),
        positive: int = 1, bins: int | None = None, buckets: int | None = None) -> DataFrame:
    """A4: ROC AUC (ties share rank) and PR AUC (average precision) per group.

    Rows are first reduced to (group, distinct score) with positive and
    negative counts; with ``bins`` scores are rounded onto ``bins`` equal
    steps first, so at most ``bins`` rows per group remain (approximate).
    Running totals in descending score order give, per distinct score,
    ROC: sum(neg * (cum_pos - pos / 2)) / (P * N) and
    AP: sum(pos / P * cum_pos / (cum_pos + cum_neg)).
    Rows without a label or a score (NULL or NaN) are left out.
    """
    by = list(by)
    s = F.col(score).cast("double")
    if bins:
        s = F.floor(s * bins) / bins
    y = F.col(label) == F.lit(positive)
    scored = df.where(F.col(label).isNotNull() & s.isNotNull() & ~F.isnan(s))
    g = materialize(scored.select(*by, (-s).alias("_ns"), y.alias("_y"))
                    .groupBy(*by, "_ns")
                    .agg(F.count_if("_y").cast("bigint").alias("_pos"),
                         F.count_if(~F.col("_y")).cast("bigint").alias("_neg")))
    cum = running_totals(g, by, ["_ns"], ["_pos", "_neg"], buckets)
    tot = g.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    j = cum.join(tot, by, "inner")
    roc_term = F.col("_neg") * (F.col("cum__pos") - F.col("_pos") / 2.0)
    ap_term = F.col("_pos") * _ratio(F.col("cum__pos"), F.col("cum__pos") + F.col("cum__neg"))
    r = j.groupBy(*by, "_P", "_N").agg(F.sum(roc_term).alias("_roc"), F.sum(ap_term).alias("_ap"))
    return r.select(*by, _ratio(F.col("_roc"), F.col("_P") * F.col("_N")).alias("roc_auc"),
                    _ratio(F.col("_ap"), F.col("_P")).alias("pr_auc"))


def regression_metrics(df: DataFrame, target: str, prediction: str,
                       by: Sequence[str] = ()) -> DataFrame:
    """A5: n, mae, mse, rmse, r2, max_error, mean_target, mape (rows with a
    zero target are left out of mape)."""
    y = F.col(target).cast("double")
    p = F.col(prediction).cast("double")
    e = y - p
    g = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.max(F.abs(e)).alias("max_error"),
        F.avg(y).alias("mean_target"),
        F.avg(F.when(y != 0, F.abs(e / y))).alias("mape"))
    return g.select(*by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                    (1 - _ratio(F.col("_sse"), F.col("_sst"))).alias("r2"),
                    "max_error", "mean_target", "mape")
