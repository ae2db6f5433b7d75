"""Queries for encoding, model fitting, batch/stream scoring, requests and run
records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.tenure import tenure_days, tenure_sql
from ..operators.metrics import auc, classification_metrics, regression_metrics
from ..operators.split import split
from ..session import data_path, scratch_path, written
from ..sources.requests import read_requests, request_errors
from ..streaming.profile import latest_by_key, run_available_now, stream_profile
from ..streaming.score import run_requests, stream_score
from . import fixtures as fx
from .features import assemble, key_table
from .encoding import encode_long, fit_dictionary, fit_table_one_hot
from .model import (GBTParams, compare_runs, contract_of, fit_gbt, fit_gbt_rounds, fit_linear, predict, read_runs, run_record, score_batch,
                    store_run)
from .queries_drift import ORIGIN, WIDTH, _k_sql, sketches_near
from .queries_features import churn_spec
from .queries_stats import SPLIT_WEIGHTS, TT_WEIGHTS, _split_case_sql
from .registry import query

# ---------------------------------------------------------------- one-hot (M3)

OHE_COLS = ["c_mktsegment", "c_nationkey", "c_acctbal"]


def _ohe_sql() -> str:
    tr = f"SELECT * FROM customer WHERE {_split_case_sql('c_custkey', SPLIT_WEIGHTS)} = 'train'"
    cats = " UNION ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM tr" for c in OHE_COLS)
    allv = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM customer"
                              for c in OHE_COLS)
    return f"""
WITH tr AS ({tr}),
cats AS ({cats}),
slots AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS slot FROM cats),
allv AS ({allv})
SELECT a."column", a.value, coalesce(s.slot, -1) AS slot, count(*) AS n
FROM allv a LEFT JOIN slots s ON a."column" = s."column" AND a.value = s.value
GROUP BY 1, 2, 3"""


@query("one_hot_counts", _ohe_sql())
def one_hot_counts(spark, sf_dir):
    """M3: dictionary fit on the train split, applied to all rows; per column
    and raw value the active slot (-1 = all zeros, i.e. unseen in training)."""
    c = split(fx.table(spark, sf_dir, "customer"), "c_custkey", SPLIT_WEIGHTS)
    d = fit_dictionary(c.filter(F.col("split") == "train"), OHE_COLS)
    return encode_long(c, d, OHE_COLS).groupBy("column", "value", "slot").agg(F.count(F.lit(1)).alias("n"))


OHE_SLOTS = f"""
WITH tr AS (SELECT * FROM customer WHERE {_split_case_sql('c_custkey', SPLIT_WEIGHTS)} = 'train'),
cats AS ({" UNION ".join(f"SELECT {i} AS i, CAST({c} AS VARCHAR) AS value FROM tr" for i, c in enumerate(OHE_COLS))}),
slots AS (SELECT i, value, row_number() OVER (ORDER BY i, value) - 1 AS slot FROM cats),
allv AS ({" UNION ALL ".join(f"SELECT c_custkey, {i} AS i, CAST({c} AS VARCHAR) AS value FROM customer" for i, c in enumerate(OHE_COLS))})
SELECT a.c_custkey, (SELECT count(*) FROM slots)::INT AS width,
       coalesce(string_agg(CAST(s.slot AS VARCHAR), ',' ORDER BY s.slot), '') AS slots
FROM allv a LEFT JOIN slots s ON a.i = s.i AND a.value = s.value GROUP BY 1"""


@query("one_hot_rows", OHE_SLOTS)
def one_hot_rows(spark, sf_dir):
    """M3 + M6: every row's sparse vector from the dictionary of the train
    split, all columns one-hot, numeric ones too: its width and its slots."""
    c = split(fx.table(spark, sf_dir, "customer"), "c_custkey", SPLIT_WEIGHTS)
    enc = fit_table_one_hot(c.filter(F.col("split") == "train"), OHE_COLS)
    v = enc.transform(c).select("c_custkey", F.unwrap_udt("features").alias("v"))
    return v.select("c_custkey", F.col("v.size").alias("width"),
                    F.array_join(F.transform("v.indices", lambda i: i.cast("string")), ",").alias("slots"))


# ---------------------------------------------------------------- GBT + batch scoring

#: the label's noise-free rule is balance > 3000; a fitted model must follow it beyond this distance
CLEAR = 500


def _clear_sql() -> str:
    return f"count(*) FILTER (WHERE abs(balance - 3000) > {CLEAR})"


def _gbt_training(spark, sf_dir):
    labels = fx.churn_signal_label(spark, sf_dir)
    feats = fx.features_clean(spark, sf_dir)
    spec = churn_spec()
    df = assemble(labels, spec, {"churn_user_features": feats}, apply_exclude=False)
    # a customer without features still has a balance, which the label is made of
    df = split(df, "user_id", SPLIT_WEIGHTS)
    return df.drop(*spec.exclude), spec, feats


def _follows():
    """Whether the class is the rule's; NULL where the balance is near the threshold."""
    return F.when(F.abs(F.col("balance") - 3000) > CLEAR, (F.col("prediction") == 1.0) == (F.col("balance") > 3000))


@query("gbt_score_batch", f"""
WITH {fx.FEATURES_CLEAN_SQL}
SELECT user_id, segment, balance, order_count,
       {tenure_sql('creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} AS user_tenure,
       TRUE AS is_class, TRUE AS agrees, TRUE AS follows_rule
FROM features_clean""")
def gbt_score_batch(spark, sf_dir):
    """M3 + M4 + M6 + M7 + B7 + B1: fit encoder + boosted trees with early
    stopping on the validation split, then score the key-only table by key,
    inputs checked against the recorded schema.  Per key (exactly once) the
    looked-up features, whether the prediction is a class and the one that its
    probability says, and whether the predictions follow the rule behind the
    label in 97 % of the rows whose balance is clear of the threshold."""
    df, spec, feats = _gbt_training(spark, sf_dir)
    model = fit_gbt(df, "churn_label")
    contract = contract_of(df, ["segment", "balance", "order_count", "user_tenure"])
    keys = key_table(feats, "user_id")
    spec.label = None
    out = written(score_batch(keys, model, spec, {"churn_user_features": feats}, contract=contract), "scored")
    follows = out.agg(F.avg(_follows().cast("int"))).scalar()
    return out.select("user_id", "segment", "balance", "order_count", "user_tenure",
                      F.col("prediction").isin(0.0, 1.0).alias("is_class"),
                      ((F.col("prediction") == 1.0) == (F.col("probability") >= 0.5)).alias("agrees"),
                      (follows >= 0.97).alias("follows_rule"))


_GBT_ROWS = f"""{fx.FEATURES_CLEAN_SQL},
gbt_rows AS (SELECT r.user_id, r.churn_label, f.balance, {_split_case_sql('r.user_id', SPLIT_WEIGHTS)} AS split
             FROM (SELECT user_id, {fx.SIGNAL_LABEL_SQL} AS churn_label FROM churn_raw) r
             LEFT JOIN features_clean f ON f.user_id = r.user_id)"""


@query("gbt_metrics", f"""
WITH {_GBT_ROWS}
SELECT split, count(*) AS n, count(*) FILTER (WHERE churn_label = 1) AS positives, {_clear_sql()} AS clear,
       TRUE AS follows_rule, TRUE AS learned
FROM gbt_rows GROUP BY 1""")
def gbt_metrics(spark, sf_dir):
    """A3 + A4 on the boosted trees, per split: rows, positives, rows whose
    balance is clear of the threshold, whether 97 % of these are predicted by
    the rule behind the label (which the label itself follows in 90 %), and
    whether the ROC AUC is over 0.7."""
    df, _, _ = _gbt_training(spark, sf_dir)
    scored = written(predict(fit_gbt(df, "churn_label"), df).select("split", "balance", "churn_label", "prediction", "probability"), "scored")
    n = classification_metrics(scored, "churn_label", "prediction").select("split", "n", (F.col("tp") + F.col("fn")).alias("positives"))
    rule = scored.groupBy("split").agg(F.count(_follows()).alias("clear"), (F.avg(_follows().cast("int")) >= 0.97).alias("follows_rule"))
    a = auc(scored, "churn_label", "probability").select("split", (F.col("roc_auc") > 0.7).alias("learned"))
    return n.join(rule, "split").join(a, "split")


@query("gbt_rounds", f"""
WITH {_GBT_ROWS}
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_valid,
       TRUE AS stops_by_rule, TRUE AS best_is_least, TRUE AS cut_has_loss FROM gbt_rows""")
def gbt_rounds(spark, sf_dir):
    """M4: the rounds of a fit with patience 5, the rule recomputed from their
    losses with window functions: it stops five rounds behind the best (or at
    the last), the best is the least loss, and the cut ensemble has that loss,
    recomputed from its probabilities on the validation rows."""
    df, _, _ = _gbt_training(spark, sf_dir)
    model, fit = fit_gbt_rounds(df, "churn_label")
    r = fit.rounds(spark).withColumn("before", F.min("loss").over(Window.orderBy("round").rowsBetween(Window.unboundedPreceding, -1)))
    better = r.withColumn("better", F.coalesce(F.col("loss") < F.col("before"), F.lit(True)))
    seen = better.agg(F.max(F.when(F.col("better"), F.col("round"))).alias("best"), F.max("round").alias("stop"), F.min("loss").alias("least"),
                      F.min_by("round", F.struct("loss", "round")).alias("least_at"))
    p = F.when(F.col("churn_label") == 1, F.col("probability")).otherwise(1 - F.col("probability"))
    rows = predict(model, df).select("split", p.alias("p"))
    # the loss of a margin m is 2 log(1 + exp(-2 y m)), and the probability 1 / (1 + exp(-2 m))
    n = rows.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_valid"),
                 F.avg(F.when(F.col("split") == "val", -2 * F.log("p"))).alias("again"))
    return n.crossJoin(seen).select(  # one row each
        "n_train", "n_valid",
        (F.col("stop") == F.least(F.col("best") + GBTParams.patience, F.lit(GBTParams.max_iter))).alias("stops_by_rule"),
        ((F.col("best") == F.col("least_at")) & (F.col("best") == fit.best)).alias("best_is_least"),
        (F.abs(F.col("again") - F.col("least")) < 1e-9).alias("cut_has_loss"))


def _metrics_sql() -> dict[str, str]:
    e = "fare_amount - predictions"
    return {"n": "count(*)", "mae": f"avg(abs({e}))", "mse": f"avg(({e}) * ({e}))", "rmse": f"sqrt(avg(({e}) * ({e})))",
               "r2": f"1 - sum(({e}) * ({e})) / (var_pop(fare_amount) * count(fare_amount))", "max_error": f"max(abs({e}))",
               "mean_target": "avg(fare_amount)", "mape": f"avg(CASE WHEN fare_amount <> 0 THEN abs(({e}) / fare_amount) END)"}


def _record_sql() -> str:
    metrics = _metrics_sql()
    rows = " UNION ALL ".join(f"SELECT 'taxi_linear', 'metric', split, '{m}', round(CAST({x} AS DOUBLE), 3) + 0.0, NULL FROM pred GROUP BY split"
                              for m, x in metrics.items())
    params = {"fitIntercept": "True", "regParam": "0.0", "elasticNetParam": "0.0", "solver": "normal"}
    head = " UNION ALL ".join(f"SELECT 'taxi_linear' AS run_id, 'param' AS kind, CAST(NULL AS VARCHAR) AS split, '{k}' AS name, "
                              f"CAST(NULL AS DOUBLE) AS value_num, '{v}' AS value_text" for k, v in params.items())
    return f"""
WITH {fx.TAXI_VIEW_SQL},
s AS (SELECT *, {_split_case_sql('l_orderkey', TT_WEIGHTS)} AS split FROM taxi_view),
fit AS (SELECT regr_slope(fare_amount, trip_distance) AS slope, regr_intercept(fare_amount, trip_distance) AS icpt
        FROM s WHERE split = 'train'),
pred AS (SELECT s.split, s.fare_amount, f.icpt + f.slope * s.trip_distance AS predictions FROM s, fit f)
{head}
UNION ALL SELECT 'taxi_linear', 'input', NULL, 'table', NULL, 'lineitem'
UNION ALL {rows}"""


@query("run_record", _record_sql())
def run_record_q(spark, sf_dir):
    """M5 + A5 + M9: MLlib least squares on the train split, metrics per split,
    recorded with parameters and the input table."""
    t = split(fx.taxi_view(spark, sf_dir), "l_orderkey", TT_WEIGHTS)
    model = fit_linear(t.filter(F.col("split") == "train"), "fare_amount", ["trip_distance"])
    scored = predict(model, t, probability=None)
    metrics = regression_metrics(scored, "fare_amount", "prediction", by=["split"])
    lr = model.stages[-1]
    params = {"fitIntercept": lr.getFitIntercept(), "regParam": lr.getRegParam(),
              "elasticNetParam": lr.getElasticNetParam(), "solver": lr.getSolver()}
    return (run_record(spark, "taxi_linear", params, metrics, ["lineitem"])
            .withColumn("value_num", F.round("value_num", 3) + 0.0))


_HIGHER = {"mae": False, "rmse": False, "r2": True, "max_error": False}


def _compared_sql() -> str:
    m = _metrics_sql()
    rows = " UNION ALL ".join(f"SELECT run_id, split, '{k}' AS name, round(CAST({m[k]} AS DOUBLE), 3) + 0.0 AS v, {-1 if up else 1} AS way "
                              "FROM pred GROUP BY run_id, split" for k, up in _HIGHER.items())
    return f"""
WITH {fx.TAXI_VIEW_SQL},
s AS (SELECT *, {_split_case_sql('l_orderkey', TT_WEIGHTS)} AS split FROM taxi_view),
fit AS (SELECT regr_slope(fare_amount, trip_distance) AS slope, regr_intercept(fare_amount, trip_distance) AS icpt,
               avg(fare_amount) AS mean FROM s WHERE split = 'train'),
pred AS (SELECT 'taxi_linear' AS run_id, s.split, s.fare_amount, f.icpt + f.slope * s.trip_distance AS predictions FROM s, fit f
         UNION ALL SELECT 'taxi_mean', s.split, s.fare_amount, f.mean FROM s, fit f),
m AS ({rows})
SELECT m.split, m.name, m.run_id, m.v AS value_num, b.v AS baseline_value, round(m.v - b.v, 3) + 0.0 AS change,
       rank() OVER (PARTITION BY m.split, m.name ORDER BY m.way * m.v) AS place
FROM m JOIN m b ON b.split = m.split AND b.name = m.name AND b.run_id = 'taxi_mean'"""


@query("runs_compared", _compared_sql())
def runs_compared(spark, sf_dir):
    """M5 + A5 + M9: two runs, least squares and the train split's mean, are
    recorded and stored (the first twice, as a repeated job does), read back
    and compared per split and metric, the mean being the baseline."""
    t = split(fx.taxi_view(spark, sf_dir), "l_orderkey", TT_WEIGHTS)
    train = t.filter(F.col("split") == "train")
    linear = predict(fit_linear(train, "fare_amount", ["trip_distance"]), t, probability=None)
    mean = t.withColumn("prediction", train.agg(F.avg("fare_amount")).scalar())
    store = scratch_path(spark, "runs")
    for run_id, scored in (("taxi_linear", linear), ("taxi_mean", mean), ("taxi_linear", linear)):
        metrics = regression_metrics(scored, "fare_amount", "prediction", by=["split"])
        store_run(run_record(spark, run_id, {}, metrics, ["lineitem"]).withColumn("value_num", F.round("value_num", 3) + 0.0), store)
    return compare_runs(read_runs(spark, store), "taxi_mean", _HIGHER).withColumn("change", F.round("change", 3) + 0.0)


# ---------------------------------------------------------------- requests

@query("requests_parsed", f"""
WITH {fx.REQUESTS_EXPECTED_SQL}
SELECT request_id, pos, user_id FROM requests_expected""")
def requests_parsed(spark, sf_dir):
    """One row per key of every well-formed request, input order kept."""
    return read_requests(fx.requests_text(spark, sf_dir))


@query("request_errors", """
SELECT DISTINCT CAST(floor(c_custkey / 4) AS BIGINT) AS request_id FROM customer
WHERE CAST(floor(c_custkey / 4) AS BIGINT) % 10 = 3""")
def request_errors_q(spark, sf_dir):
    """S12 error output: requests whose text does not parse."""
    return request_errors(fx.requests_text(spark, sf_dir)).select("request_id")


def _prob(balance):
    return 1.0 / (1.0 + F.exp(-(balance - F.lit(3000.0)) / F.lit(500.0)))


def _score_requests(df):
    p = _prob(F.col("balance"))
    return df.select("request_id", "pos", "user_id",
                     F.coalesce(F.col("_found"), F.lit(False)).alias("found"),
                     "balance", "order_count",
                     F.when(F.col("_found"), tenure_days("creation_date", fx.AS_OF)).alias("user_tenure"),
                     F.round(p, 6).alias("probability"),
                     F.when(p >= 0.5, 1).when(p < 0.5, 0).alias("prediction"))


def _features_for_requests(spark, sf_dir):
    return fx.features_clean(spark, sf_dir).select(
        "user_id", "balance", "order_count", "creation_date", F.lit(True).alias("_found"))


REQUEST_LOOKUP_SQL = f"""
WITH {fx.FEATURES_CLEAN_SQL}, {fx.REQUESTS_EXPECTED_SQL}
SELECT r.request_id, r.pos, r.user_id, f.user_id IS NOT NULL AS found, f.balance, f.order_count,
       CASE WHEN f.user_id IS NOT NULL THEN {tenure_sql('f.creation_date', "TIMESTAMP '" + fx.AS_OF + "'")} END AS user_tenure,
       round(1.0 / (1.0 + exp(-(f.balance - 3000.0) / 500.0)), 6) AS probability,
       CASE WHEN 1.0 / (1.0 + exp(-(f.balance - 3000.0) / 500.0)) >= 0.5 THEN 1
            WHEN 1.0 / (1.0 + exp(-(f.balance - 3000.0) / 500.0)) < 0.5 THEN 0 END AS prediction
FROM requests_expected r LEFT JOIN features_clean f ON r.user_id = f.user_id"""


@query("request_lookup", REQUEST_LOOKUP_SQL)
def request_lookup(spark, sf_dir):
    """J6 (batch): keys in, features fetched, prediction out; unknown keys kept."""
    parsed = read_requests(fx.requests_text(spark, sf_dir))
    return _score_requests(parsed.join(_features_for_requests(spark, sf_dir), "user_id", "left"))


@query("stream_score", REQUEST_LOOKUP_SQL)
def stream_score_q(spark, sf_dir):
    """The same requests read as a stream (files written from customer),
    stream-static join, scored, appended; equals the batch result."""
    src = scratch_path(spark, "requests_src")
    fx.requests_text(spark, sf_dir).write.parquet(src)
    sdf = spark.readStream.schema("request_id bigint, body string").parquet(src)
    # stored once: a micro-batch joins the table, it does not aggregate orders again
    feats = written(_features_for_requests(spark, sf_dir), "request_features")
    scored = stream_score(sdf, feats, "user_id", _score_requests)
    out = scratch_path(spark, "stream_score_out")
    run_available_now(scored, out, scratch_path(spark, "stream_score_ckpt"), output_mode="append")
    return spark.read.parquet(out).drop("batch")


@query("stream_requests", f"""
SELECT request_id, pos, user_id, found, probability, FALSE AS malformed FROM ({REQUEST_LOOKUP_SQL})
UNION ALL
SELECT DISTINCT CAST(floor(c_custkey / 4) AS BIGINT), NULL::INT, NULL::VARCHAR, NULL::BOOLEAN, NULL::DOUBLE, TRUE FROM customer
WHERE CAST(floor(c_custkey / 4) AS BIGINT) % 10 = 3""")
def stream_requests(spark, sf_dir):
    """A stream in which every request is sent twice, a minute apart: each
    is scored once, and the malformed ones are kept, once each."""
    src = scratch_path(spark, "requests_sent")
    sent = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod("request_id", F.lit(3600)))
    once = fx.requests_text(spark, sf_dir).withColumn("sent_at", sent)
    for i, df in enumerate((once, once.withColumn("sent_at", F.timestamp_add("MINUTE", F.lit(1), F.col("sent_at"))))):
        df.write.parquet(f"{src}/part={i}")
    sdf = spark.readStream.schema("request_id bigint, body string, sent_at timestamp").parquet(src + "/part=*")
    feats = written(_features_for_requests(spark, sf_dir), "request_features")
    scores, errors = run_requests(sdf, feats, "user_id", _score_requests, scratch_path(spark, "requests_out"), scratch_path(spark, "requests_ckpt"))
    return scores.select("request_id", "pos", "user_id", "found", "probability", F.lit(False).alias("malformed")).unionByName(
        errors.select("request_id", F.lit(True).alias("malformed")), allowMissingColumns=True)


# ---------------------------------------------------------------- streaming profile

@query("stream_sketches", f"""
WITH {fx.DRIFT_VIEW_SQL},
pw AS (SELECT {_k_sql('date')} AS k, location, temperature FROM drift_view)
SELECT k, 'temperature' AS "column", count(*) AS n, count(temperature) AS present, TRUE AS distinct_near, TRUE AS quartiles_near FROM pw GROUP BY k
UNION ALL SELECT k, 'location', count(*), count(location), TRUE, TRUE FROM pw GROUP BY k""")
def stream_sketches(spark, sf_dir):
    """The streaming profile with sketches in its state, held against the
    rows of the batch view: distinct counts within 5 % and quartiles within 1 %
    of all ranks."""
    from ..operators.drift import window_index
    path = data_path(sf_dir, "events")
    ev = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")
    agg = stream_profile(fx.drift_transform(ev), "date", WIDTH, ORIGIN, ["location", "temperature"], delay="1 day", sketches=True)
    out = scratch_path(spark, "stream_sketches_out")
    run_available_now(agg, out, scratch_path(spark, "stream_sketches_ckpt"), output_mode="update",
                      transform=lambda b: b.withColumn("window", F.col("w.start").cast("timestamp_ntz")).drop("w"))
    res = latest_by_key(spark, out, ["window", "column"]).withColumn("k", window_index("window", WIDTH, ORIGIN)).drop("window")
    return sketches_near(fx.drift_view(spark, sf_dir), res, 0.01)


@query("stream_profile", f"""
WITH {fx.DRIFT_VIEW_SQL},
pw AS (SELECT {_k_sql('date')} AS k, location, temperature FROM drift_view),
prof AS (
  SELECT k, 'temperature' AS "column", count(*) AS n, count(*) - count(temperature) AS nulls,
         min(temperature) AS "min", max(temperature) AS "max", avg(temperature) AS mean,
         stddev_samp(temperature) AS std FROM pw GROUP BY k
  UNION ALL
  SELECT k, 'location', count(*), count(*) - count(location), NULL::DOUBLE, NULL::DOUBLE,
         NULL::DOUBLE, NULL::DOUBLE FROM pw GROUP BY k)
SELECT TIMESTAMP '{ORIGIN}' + INTERVAL (k * 10) DAY AS "window", k, "column", n, nulls,
       round(CAST(nulls AS DOUBLE) / n, 6) AS null_rate, round("min", 6) AS "min", round("max", 6) AS "max",
       round(mean, 6) AS mean, round(std, 6) AS std
FROM prof""")
def stream_profile_q(spark, sf_dir):
    """Events read as a stream, the drift view applied row-wise, a
    watermarked tumbling-window profile in update mode, upserted by key."""
    from ..operators.drift import window_index
    path = data_path(sf_dir, "events")
    # a pattern that matches the table itself, be it one file or a folder of part files
    ev = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")
    agg = stream_profile(fx.drift_transform(ev), "date", WIDTH, ORIGIN,
                         ["location", "temperature"], delay="1 day")
    out = scratch_path(spark, "stream_profile_out")
    run_available_now(agg, out, scratch_path(spark, "stream_profile_ckpt"), output_mode="update",
                      transform=lambda b: b.select(F.col("w.start").cast("timestamp_ntz").alias("window"), "column", "n",
                                                   "nulls", "min", "max", "mean", "std"))
    res = latest_by_key(spark, out, ["window", "column"])
    return res.select("window", window_index("window", WIDTH, ORIGIN).alias("k"), "column", "n", "nulls",
                      F.round(F.col("nulls") / F.col("n"), 6).alias("null_rate"),
                      *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")])
