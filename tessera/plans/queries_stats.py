"""Queries for statistics, splits, fitted lines, scoring and metrics.

Doubles that come out of sums are rounded (same digits in both engines) so
the oracle can compare values exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import unit_hash_sql
from ..operators.columns import sample_rows
from ..operators.metrics import auc, classification_metrics, regression_metrics
from ..operators.split import split, split_exact
from ..operators.stats import describe, kde, kde2, kde2_binned, kde_binned, linear_grid, ols, pair_stats, split_sizes
from . import fixtures as fx
from .registry import query

R = 6  # decimals kept for rounded doubles


def rnd(c, d=R):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------- describe

_DESC_COLS = ["c_custkey", "c_nationkey", "c_acctbal"]
_DESC_STATS = [("count", 'CAST(count(value) AS DOUBLE)'), ("mean", "avg(value)"),
               ("std", "stddev_samp(value)"), ("min", "min(value)"),
               ("25%", "quantile_cont(value, 0.25)"), ("50%", "quantile_cont(value, 0.5)"),
               ("75%", "quantile_cont(value, 0.75)"), ("max", "max(value)")]
_DESC_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM customer" for c in _DESC_COLS)
_DESC_SQL = "WITH long AS (" + _DESC_LONG + ")\n" + "\nUNION ALL\n".join(
    f"SELECT \"column\", '{s}' AS stat, round({e}, {R}) AS value FROM long GROUP BY \"column\""
    for s, e in _DESC_STATS)


@query("describe_numeric", _DESC_SQL)
def describe_numeric(spark, sf_dir):
    """A1: describe in long form with exact quartiles."""
    d = describe(fx.table(spark, sf_dir, "customer"), _DESC_COLS)
    return d.withColumn("value", rnd("value"))


# ---------------------------------------------------------------- splits

SPLIT_WEIGHTS = {"train": 0.6, "val": 0.2, "test": 0.2}
TT_WEIGHTS = {"train": 0.8, "test": 0.2}


def _split_case_sql(key_sql: str, weights: dict, seed: int = 42) -> str:
    u = unit_hash_sql(key_sql, seed)
    acc, parts = 0.0, []
    items = list(weights.items())
    for name, w in items[:-1]:
        acc += w
        parts.append(f"WHEN {u} < {acc!r} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{items[-1][0]}' END"


@query("split_three_way", f"""
SELECT c_custkey, {_split_case_sql('c_custkey', SPLIT_WEIGHTS)} AS split FROM customer""")
def split_three_way(spark, sf_dir):
    """M1: 60/20/20 by a seeded hash of the key."""
    c = fx.table(spark, sf_dir, "customer").select("c_custkey")
    return split(c, "c_custkey", SPLIT_WEIGHTS, seed=42)


@query("split_sizes", f"""
SELECT {_split_case_sql('l_orderkey', TT_WEIGHTS)} AS split, count(*) AS n
FROM lineitem GROUP BY 1""")
def split_sizes_q(spark, sf_dir):
    """M1 + A2: 80/20 on lineitem keyed by order (whole orders stay together)."""
    li = split(fx.table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", TT_WEIGHTS)
    return split_sizes(li)


@query("split_exact", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {unit_hash_sql('c_custkey', 42)}, c_custkey) - 1 AS rk,
                  count(*) OVER () AS n FROM customer),
c AS (SELECT *, n - CAST(ceil(n * 0.4) AS BIGINT) AS n_train, CAST(ceil(n * 0.4) AS BIGINT) AS hold FROM r)
SELECT * EXCLUDE (rk, n, n_train, hold), CASE WHEN rk < n_train THEN 'train'
                       WHEN rk < n_train + (hold - CAST(ceil(hold * 0.5) AS BIGINT)) THEN 'val'
                       ELSE 'test' END AS split
FROM c""")
def split_exact_q(spark, sf_dir):
    """M2: exact 60/20/20 sizes (ceil of the held-out share, then half), all
    columns carried along."""
    return split_exact(fx.table(spark, sf_dir, "customer"), "c_custkey", SPLIT_WEIGHTS, seed=42)


@query("hash_sample", f"""
SELECT * FROM lineitem WHERE {unit_hash_sql('l_orderkey', 42)} < 0.1""")
def hash_sample(spark, sf_dir):
    """A repeatable 10 % sample of whole orders."""
    return sample_rows(fx.table(spark, sf_dir, "lineitem"), 0.1, key="l_orderkey", seed=42)


# ---------------------------------------------------------------- regression

_TAXI_SPLIT = f"""{fx.TAXI_VIEW_SQL},
taxi_split AS (SELECT *, {_split_case_sql('l_orderkey', TT_WEIGHTS)} AS split FROM taxi_view),
fit AS (SELECT regr_count(fare_amount, trip_distance) AS n,
               regr_slope(fare_amount, trip_distance) AS slope,
               regr_intercept(fare_amount, trip_distance) AS intercept,
               regr_r2(fare_amount, trip_distance) AS r2
        FROM taxi_split WHERE split = 'train'),
pred AS (SELECT t.l_orderkey, t.l_linenumber, t.trip_distance, t.fare_amount,
                f.intercept + f.slope * t.trip_distance AS predictions
         FROM taxi_split t, fit f WHERE t.split = 'test')"""


def _taxi_split(spark, sf_dir):
    return split(fx.taxi_view(spark, sf_dir), "l_orderkey", TT_WEIGHTS)


def _taxi_fit(spark, sf_dir):
    return ols(_taxi_split(spark, sf_dir).filter(F.col("split") == "train"),
               "fare_amount", "trip_distance")


def _taxi_pred(spark, sf_dir):
    from ..plans.score import score_linear
    test = _taxi_split(spark, sf_dir).filter(F.col("split") == "test")
    return score_linear(test, _taxi_fit(spark, sf_dir), "trip_distance", output="predictions")


@query("ols_fare", f"""
WITH {_TAXI_SPLIT}
SELECT n, round(slope, {R}) AS slope, round(intercept, 4) AS intercept, round(r2, 10) AS r2 FROM fit""")
def ols_fare(spark, sf_dir):
    """Fare on distance over the train split."""
    f = _taxi_fit(spark, sf_dir)
    return f.select("n", rnd("slope").alias("slope"), rnd("intercept", 4).alias("intercept"),
                    rnd("r2", 10).alias("r2"))


@query("predict_fare", f"""
WITH {_TAXI_SPLIT}
SELECT l_orderkey, l_linenumber, trip_distance, round(predictions, 4) AS predictions FROM pred""")
def predict_fare(spark, sf_dir):
    """B2: the fitted line as a column over the test split."""
    p = _taxi_pred(spark, sf_dir)
    return p.select("l_orderkey", "l_linenumber", "trip_distance",
                    rnd("predictions", 4).alias("predictions"))


class _Line:
    """A Python model as a user would bring one: predict(pandas frame)."""

    def __init__(self, slope: float, intercept: float):
        self.slope, self.intercept = slope, intercept

    def predict(self, pdf):
        return self.intercept + self.slope * pdf["trip_distance"]


@query("score_python_model", f"""
WITH {_TAXI_SPLIT}
SELECT l_orderkey, l_linenumber, trip_distance, round(predictions, 4) AS predictions FROM pred""")
def score_python_model(spark, sf_dir):
    """The fitted line as an arbitrary Python model, loaded once per task."""
    from ..plans.score import score_with
    fit = _taxi_fit(spark, sf_dir).first()
    slope, intercept = fit["slope"], fit["intercept"]
    test = _taxi_split(spark, sf_dir).filter(F.col("split") == "test").select("l_orderkey", "l_linenumber", "trip_distance")
    scored = score_with(test, lambda: _Line(slope, intercept), ["trip_distance"])
    return scored.withColumn("predictions", rnd("predictions", 4))


@query("regression_metrics", f"""
WITH {_TAXI_SPLIT}
SELECT count(*) AS n, round(avg(abs(fare_amount - predictions)), 4) AS mae,
       round(sqrt(avg((fare_amount - predictions) * (fare_amount - predictions))), 4) AS rmse,
       round(1 - sum((fare_amount - predictions) * (fare_amount - predictions))
                 / (var_pop(fare_amount) * count(fare_amount)), 8) AS r2,
       round(max(abs(fare_amount - predictions)), 4) AS max_error,
       round(avg(fare_amount), 4) AS mean_target,
       round(avg(CASE WHEN fare_amount <> 0 THEN abs((fare_amount - predictions) / fare_amount) END), 8) AS mape
FROM pred""")
def regression_metrics_q(spark, sf_dir):
    """A5 on the test split."""
    m = regression_metrics(_taxi_pred(spark, sf_dir), "fare_amount", "predictions")
    return m.select("n", rnd("mae", 4).alias("mae"), rnd("rmse", 4).alias("rmse"),
                    rnd("r2", 8).alias("r2"), rnd("max_error", 4).alias("max_error"),
                    rnd("mean_target", 4).alias("mean_target"), rnd("mape", 8).alias("mape"))


@query("pair_stats", """
WITH t AS (SELECT l_quantity AS x1, l_extendedprice AS x2, l_discount AS x3 FROM lineitem),
p AS (
  SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, regr_count(x2, x1) AS n, corr(x1, x2) AS corr,
         regr_slope(x2, x1) AS slope, regr_intercept(x2, x1) AS intercept, regr_r2(x2, x1) AS r2 FROM t
  UNION ALL SELECT 'l_quantity', 'l_discount', regr_count(x3, x1), corr(x1, x3), regr_slope(x3, x1), regr_intercept(x3, x1), regr_r2(x3, x1) FROM t
  UNION ALL SELECT 'l_extendedprice', 'l_quantity', regr_count(x1, x2), corr(x2, x1), regr_slope(x1, x2), regr_intercept(x1, x2), regr_r2(x1, x2) FROM t
  UNION ALL SELECT 'l_extendedprice', 'l_discount', regr_count(x3, x2), corr(x2, x3), regr_slope(x3, x2), regr_intercept(x3, x2), regr_r2(x3, x2) FROM t
  UNION ALL SELECT 'l_discount', 'l_quantity', regr_count(x1, x3), corr(x3, x1), regr_slope(x1, x3), regr_intercept(x1, x3), regr_r2(x1, x3) FROM t
  UNION ALL SELECT 'l_discount', 'l_extendedprice', regr_count(x2, x3), corr(x3, x2), regr_slope(x2, x3), regr_intercept(x2, x3), regr_r2(x2, x3) FROM t)
SELECT x, y, n, round(corr, 8) AS corr, round(slope, 6) AS slope, round(intercept, 4) AS intercept,
       round(r2, 10) AS r2 FROM p""")
def pair_stats_q(spark, sf_dir):
    """Correlation and fitted line for each ordered pair of columns."""
    p = pair_stats(fx.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return p.select("x", "y", "n", rnd("corr", 8).alias("corr"), rnd("slope", 6).alias("slope"),
                    rnd("intercept", 4).alias("intercept"), rnd("r2", 10).alias("r2"))


KDE_GRID = linear_grid(-1000.0, 10000.0, 23)
KDE2_GX = linear_grid(0.0, 50.0, 11)
KDE2_GY = linear_grid(0.0, 0.1, 11)
KDE_BIN_GRID = linear_grid(0.0, 100_000.0, 101)
KDE2_BIN_GY = linear_grid(0.0, 100_000.0, 21)


def _grid_sql(points, name, idx):
    return " UNION ALL ".join(f"SELECT {i} AS {idx}, CAST({p!r} AS DOUBLE) AS {name}"
                              for i, p in enumerate(points))


@query("kde_grid", f"""
WITH v AS (SELECT c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL),
s AS (SELECT count(*) AS n, pow(count(*), -0.2) * stddev_samp(v) AS h FROM v),
g AS ({_grid_sql(KDE_GRID, 'x', 'gi')})
SELECT g.gi, g.x, round(sum(exp(-0.5 * ((g.x - v.v) / s.h) * ((g.x - v.v) / s.h))) / (s.n * s.h * sqrt(2 * pi())), 12) AS density
FROM v, s, g GROUP BY g.gi, g.x, s.n, s.h""")
def kde_grid(spark, sf_dir):
    """Gaussian density of customer balance on a 23-point grid."""
    d = kde(fx.table(spark, sf_dir, "customer"), "c_acctbal", KDE_GRID)
    return d.select("gi", "x", rnd("density", 12).alias("density"))


@query("kde2_grid", f"""
WITH v AS (SELECT l_quantity AS vx, l_discount AS vy FROM lineitem WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL),
s AS (SELECT count(*) AS n, pow(count(*), -1.0/6) * stddev_samp(vx) AS hx, pow(count(*), -1.0/6) * stddev_samp(vy) AS hy FROM v),
gx AS ({_grid_sql(KDE2_GX, 'x', 'gx')}),
gy AS ({_grid_sql(KDE2_GY, 'y', 'gy')})
SELECT gx.gx, gy.gy, gx.x, gy.y,
       round(sum(exp(-0.5 * (((gx.x - v.vx) / s.hx) * ((gx.x - v.vx) / s.hx) + ((gy.y - v.vy) / s.hy) * ((gy.y - v.vy) / s.hy))))
             / (s.n * s.hx * s.hy * 2 * pi()), 8) AS density
FROM v, s, gx, gy GROUP BY gx.gx, gy.gy, gx.x, gy.y, s.n, s.hx, s.hy""")
def kde2_grid(spark, sf_dir):
    """A8 (2-D): density of (quantity, discount) over all line items on an 11 x 11 grid."""
    d = kde2(fx.table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount", KDE2_GX, KDE2_GY)
    return d.select("gx", "gy", "x", "y", rnd("density", 8).alias("density"))


@query("kde_binned", f"""
WITH v AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
s AS (SELECT count(*) AS n, pow(count(*), -0.2) * stddev_samp(v) AS h FROM v),
p AS (SELECT (v - {KDE_BIN_GRID[0]!r}) / (h / 32) AS p, n, h FROM v, s WHERE v > {KDE_BIN_GRID[0]!r} - 9 * h AND v < {KDE_BIN_GRID[-1]!r} + 9 * h),
b AS (SELECT i, n, h, sum(w) AS w FROM (SELECT floor(p) AS i, 1 - (p - floor(p)) AS w, n, h FROM p
                                        UNION ALL SELECT floor(p) + 1, p - floor(p), n, h FROM p) GROUP BY i, n, h),
g AS ({_grid_sql(KDE_BIN_GRID, 'x', 'gi')})
SELECT g.gi, g.x, round(sum(w * exp(-0.5 * pow((g.x - ({KDE_BIN_GRID[0]!r} + i * (h / 32))) / h, 2))) / (n * h * sqrt(2 * pi())), 11) AS density
FROM b, g GROUP BY g.gi, g.x, n, h""")
def kde_binned_q(spark, sf_dir):
    """Density of the price of all line items on a 101-point grid, by linear binning."""
    d = kde_binned(fx.table(spark, sf_dir, "lineitem"), "l_extendedprice", KDE_BIN_GRID)
    return d.select("gi", "x", rnd("density", 11).alias("density"))


@query("kde2_binned", f"""
WITH v AS (SELECT l_quantity AS vx, l_extendedprice AS vy FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
s AS (SELECT count(*) AS n, pow(count(*), -1.0/6) * stddev_samp(vx) AS hx, pow(count(*), -1.0/6) * stddev_samp(vy) AS hy FROM v),
p AS (SELECT (vx - {KDE2_GX[0]!r}) / (hx / 8) AS px, (vy - {KDE2_BIN_GY[0]!r}) / (hy / 8) AS py, n, hx, hy FROM v, s
      WHERE vx > {KDE2_GX[0]!r} - 9 * hx AND vx < {KDE2_GX[-1]!r} + 9 * hx AND vy > {KDE2_BIN_GY[0]!r} - 9 * hy AND vy < {KDE2_BIN_GY[-1]!r} + 9 * hy),
b AS (SELECT i, j, n, hx, hy, sum(w) AS w FROM (
        SELECT floor(px) + a AS i, floor(py) + b AS j, n, hx, hy,
               abs(1 - a - (px - floor(px))) * abs(1 - b - (py - floor(py))) AS w
        FROM p, (SELECT unnest([0, 1]) AS a) ta, (SELECT unnest([0, 1]) AS b) tb) GROUP BY i, j, n, hx, hy),
gx AS ({_grid_sql(KDE2_GX, 'x', 'gx')}),
gy AS ({_grid_sql(KDE2_BIN_GY, 'y', 'gy')}),
m AS (SELECT gx.gx, gx.x, j, n, hx, hy, sum(w * exp(-0.5 * pow((gx.x - ({KDE2_GX[0]!r} + i * (hx / 8))) / hx, 2))) AS s
      FROM b, gx GROUP BY ALL)
SELECT gx, gy.gy, x, gy.y, round(sum(s * exp(-0.5 * pow((gy.y - ({KDE2_BIN_GY[0]!r} + j * (hy / 8))) / hy, 2))) / (n * hx * hy * 2 * pi()), 12) AS density
FROM m, gy GROUP BY gx, gy.gy, x, gy.y, n, hx, hy""")
def kde2_binned_q(spark, sf_dir):
    """A8 (2-D): density of (quantity, price) over all line items on an 11 x 21 grid, by linear binning."""
    d = kde2_binned(fx.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", KDE2_GX, KDE2_BIN_GY)
    return d.select("gx", "gy", "x", "y", rnd("density", 12).alias("density"))


# ---------------------------------------------------------------- classification

# A closed-form score with signal for the churn view's signal label.
def _logit_score(balance):
    return 1.0 / (1.0 + F.exp(-(balance - F.lit(3000.0)) / F.lit(500.0)))


_CLS_SQL = f"""{fx.CHURN_RAW_SQL},
lab AS (
  SELECT user_id, balance,
         CAST(CASE WHEN {unit_hash_sql('user_id', 7)} < 0.1
                   THEN 1 - (CASE WHEN balance > 3000 THEN 1 ELSE 0 END)
                   ELSE (CASE WHEN balance > 3000 THEN 1 ELSE 0 END) END AS INTEGER) AS churn_label
  FROM churn_raw),
scored AS (
  SELECT *, {_split_case_sql('user_id', SPLIT_WEIGHTS)} AS split,
         1.0 / (1.0 + exp(-(balance - 3000.0) / 500.0)) AS probability
  FROM lab),
pred AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)"""


def _cls_scored(spark, sf_dir):
    lab = fx.customer_balance(spark, sf_dir).select("user_id", "balance", fx.signal_label())
    s = split(lab, "user_id", SPLIT_WEIGHTS).withColumn("probability", _logit_score(F.col("balance")))
    return s.withColumn("prediction", F.when(F.col("probability") >= 0.5, 1).otherwise(0))


@query("classification_metrics", f"""
WITH {_CLS_SQL},
m AS (SELECT split, count(*) AS n,
             count(*) FILTER (WHERE churn_label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE churn_label <> 1 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE churn_label <> 1 AND prediction <> 1) AS tn,
             count(*) FILTER (WHERE churn_label = 1 AND prediction <> 1) AS fn,
             avg(-CASE WHEN churn_label = 1 THEN ln(least(greatest(probability, 1e-15), 1 - 1e-15))
                       ELSE ln(1 - least(greatest(probability, 1e-15), 1 - 1e-15)) END) AS log_loss
      FROM pred GROUP BY split),
r AS (SELECT *, coalesce(CAST(tp + tn AS DOUBLE) / nullif(n, 0), 0.0) AS accuracy,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall FROM m)
SELECT split, n, tp, fp, tn, fn, round(accuracy, {R}) AS accuracy, round(precision, {R}) AS precision,
       round(recall, {R}) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), {R}) AS f1,
       round(log_loss, {R}) AS log_loss
FROM r""")
def classification_metrics_q(spark, sf_dir):
    """A3: per split, positive label 1."""
    m = classification_metrics(_cls_scored(spark, sf_dir), "churn_label", "prediction", "probability")
    return m.select("split", "n", "tp", "fp", "tn", "fn",
                    *[rnd(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "log_loss")])


@query("roc_auc", f"""
WITH {_CLS_SQL},
g AS (SELECT split, probability AS s, count(*) FILTER (WHERE churn_label = 1) AS pos,
             count(*) FILTER (WHERE churn_label <> 1) AS neg FROM pred GROUP BY split, probability),
c AS (SELECT *, sum(pos) OVER (PARTITION BY split ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cpos,
                sum(neg) OVER (PARTITION BY split ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cneg,
                sum(pos) OVER (PARTITION BY split) AS P, sum(neg) OVER (PARTITION BY split) AS N FROM g)
SELECT split, round(sum(neg * (cpos - pos / 2.0)) / (max(P) * max(N)), {R}) AS roc_auc,
       round(sum(pos * CAST(cpos AS DOUBLE) / (cpos + cneg)) / max(P), {R}) AS pr_auc
FROM c GROUP BY split""")
def roc_auc_q(spark, sf_dir):
    """A4: ROC AUC and PR AUC per split, exact, via distributed running totals."""
    a = auc(_cls_scored(spark, sf_dir), "churn_label", "probability")
    return a.select("split", rnd("roc_auc").alias("roc_auc"), rnd("pr_auc").alias("pr_auc"))
