"""Queries over the drift view: profiles, drift metrics, alerts, incremental
profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.drift import (category_changes, category_drift, drift_alerts, drift_long,
                               null_drift, numeric_drift, profile, profile_changes, window_index)
from ..operators.keys import snapshot_changes
from ..operators.profile_state import profile_state, state_profile, update_state
from ..session import written
from . import fixtures as fx
from .registry import query

WIDTH = f"{fx.PERIOD_DAYS} days"
ORIGIN = fx.DRIFT_ORIGIN
COLS = ["location", "temperature"]
WMICROS = fx.PERIOD_DAYS * 86_400_000_000

# Fixed alert thresholds of the registered query.
THRESHOLDS = {"null_rate_delta": 0.1, "new_values": 0.0, "lost_values": 0.0, "tv": 0.1,
              "psi": 0.2, "js": 0.05, "ks": 0.1, "wasserstein": 5.0, "mean_shift": 5.0}


def _k_sql(ts: str) -> str:
    return f"CAST(floor(date_diff('microsecond', TIMESTAMP '{ORIGIN}', {ts}) / {WMICROS}.0) AS BIGINT)"


def _profile_cte(src: str) -> str:
    return f"""
pw AS (SELECT {_k_sql('date')} AS k, location, temperature FROM {src}),
prof AS (
  SELECT k, 'temperature' AS "column", count(*) AS n, count(*) - count(temperature) AS nulls,
         count(DISTINCT temperature) AS "distinct", min(temperature) AS "min", max(temperature) AS "max",
         avg(temperature) AS mean, stddev_samp(temperature) AS std,
         quantile_cont(temperature, 0.25) AS p25, quantile_cont(temperature, 0.5) AS p50,
         quantile_cont(temperature, 0.75) AS p75
  FROM pw GROUP BY k
  UNION ALL
  SELECT k, 'location', count(*), count(*) - count(location), count(DISTINCT location),
         NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
  FROM pw GROUP BY k)"""


PROFILE_SELECT = f"""
SELECT TIMESTAMP '{ORIGIN}' + INTERVAL (k * {fx.PERIOD_DAYS}) DAY AS "window", k, "column", n, nulls,
       round(CAST(nulls AS DOUBLE) / n, 6) AS null_rate, "distinct",
       round("min", 6) AS "min", round("max", 6) AS "max", round(mean, 6) AS mean, round(std, 6) AS std,
       round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75
FROM prof"""


def _round_profile(p):
    out = p.withColumn("null_rate", F.round("null_rate", 6))
    for c in ("min", "max", "mean", "std", "p25", "p50", "p75"):
        out = out.withColumn(c, F.round(c, 6))
    return out


@query("window_profile", f"WITH {fx.DRIFT_VIEW_SQL}, {_profile_cte('drift_view')} {PROFILE_SELECT}")
def window_profile(spark, sf_dir):
    """Per ten-day window and column, exact distinct counts and quartiles."""
    return _round_profile(profile(fx.drift_view(spark, sf_dir), "date", WIDTH, ORIGIN, COLS))


NULLD_CTE = """
nulld AS (
  SELECT k, "column", null_rate, prev_null_rate, null_rate - prev_null_rate AS delta FROM (
    SELECT k, "column", CAST(nulls AS DOUBLE) / n AS null_rate,
           lag(CAST(nulls AS DOUBLE) / n) OVER (PARTITION BY "column" ORDER BY k) AS prev_null_rate,
           lag(k) OVER (PARTITION BY "column" ORDER BY k) AS pk
    FROM prof) t WHERE pk = k - 1)"""


@query("null_drift", f"""
WITH {fx.DRIFT_VIEW_SQL}, {_profile_cte('drift_view')}, {NULLD_CTE}
SELECT k, "column", round(null_rate, 6) AS null_rate, round(prev_null_rate, 6) AS prev_null_rate,
       round(delta, 6) AS delta FROM nulld""")
def null_drift_q(spark, sf_dir):
    """Null rate of each window against the previous one."""
    p = profile(fx.drift_view(spark, sf_dir), "date", WIDTH, ORIGIN, COLS, detail=False)
    d = null_drift(p)
    return d.select("k", "column", *[F.round(c, 6).alias(c) for c in ("null_rate", "prev_null_rate", "delta")])


CATD_CTE = f"""
cf AS (SELECT {_k_sql('date')} AS k, location AS value, count(*) AS cnt
       FROM drift_view GROUP BY 1, 2),
ct AS (SELECT k, sum(cnt) AS total FROM cf GROUP BY k),
cpairs AS (
  SELECT coalesce(c.k, p.k + 1) AS k, coalesce(c.value, p.value) AS value,
         coalesce(c.cnt, 0) AS cur_cnt, coalesce(p.cnt, 0) AS prev_cnt
  FROM cf c FULL OUTER JOIN cf p ON c.k = p.k + 1 AND c.value IS NOT DISTINCT FROM p.value),
cj AS (
  SELECT x.*, a.total AS cur_total, b.total AS prev_total,
         CAST(x.cur_cnt AS DOUBLE) / a.total AS p, CAST(x.prev_cnt AS DOUBLE) / b.total AS q
  FROM cpairs x JOIN ct a ON a.k = x.k JOIN ct b ON b.k = x.k - 1),
catd AS (
  SELECT k,
         count(*) FILTER (WHERE prev_cnt = 0 AND cur_cnt > 0) AS new_values,
         count(*) FILTER (WHERE cur_cnt = 0 AND prev_cnt > 0) AS lost_values,
         sum(abs(p - q)) / 2 AS tv,
         sum((cur_cnt - cur_total * greatest(q, 1e-6)) * (cur_cnt - cur_total * greatest(q, 1e-6))
             / (cur_total * greatest(q, 1e-6))) AS chi2,
         sum((greatest(p, 1e-6) - greatest(q, 1e-6)) * ln(greatest(p, 1e-6) / greatest(q, 1e-6))) AS psi,
         sum(0.5 * (CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
             + 0.5 * (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) AS js
  FROM cj GROUP BY k)"""


@query("category_drift", f"""
WITH {fx.DRIFT_VIEW_SQL}, {CATD_CTE}
SELECT k, new_values, lost_values, round(tv, 6) AS tv, round(chi2, 4) AS chi2, round(psi, 6) AS psi,
       round(js, 6) AS js FROM catd""")
def category_drift_q(spark, sf_dir):
    """D3: location drift between consecutive windows (NULL is a category)."""
    d = category_drift(fx.drift_view(spark, sf_dir), "location", "date", WIDTH, ORIGIN)
    return d.select("k", "new_values", "lost_values", F.round("tv", 6).alias("tv"),
                    F.round("chi2", 4).alias("chi2"), F.round("psi", 6).alias("psi"),
                    F.round("js", 6).alias("js"))


@query("category_changes", f"""
WITH {fx.DRIFT_VIEW_SQL}, {CATD_CTE}
SELECT k, value, CASE WHEN prev_cnt = 0 THEN 'new' ELSE 'lost' END AS change,
       prev_cnt AS prev_count, cur_cnt AS count
FROM cj WHERE prev_cnt = 0 OR cur_cnt = 0""")
def category_changes_q(spark, sf_dir):
    """D3 detail: location values that appear or vanish between windows."""
    return category_changes(fx.drift_view(spark, sf_dir), "location", "date", WIDTH, ORIGIN)


_E = [f"e{i}" for i in range(1, 10)]
NUMD_CTE = f"""
nb AS (SELECT {_k_sql('date')} AS k, temperature AS v FROM drift_view WHERE temperature IS NOT NULL),
ncnt AS (SELECT k, v, count(*) AS c FROM nb GROUP BY k, v),
nsides AS (SELECT k, v, c AS n_cur, 0 AS n_base FROM ncnt UNION ALL SELECT k + 1, v, 0, c FROM ncnt),
nper AS (SELECT k, v, sum(n_cur) AS n_cur, sum(n_base) AS n_base FROM nsides GROUP BY k, v),
ntot AS (SELECT k, sum(n_cur) AS tot_cur, sum(n_base) AS tot_base, sum(v * n_cur) AS sc, sum(v * n_base) AS sb
         FROM nper GROUP BY k HAVING sum(n_cur) > 0 AND sum(n_base) > 0),
ncum AS (SELECT *, sum(n_cur) OVER (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING) AS cc,
                   sum(n_base) OVER (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb,
                   lag(v) OVER (PARTITION BY k ORDER BY v) AS pv FROM nper),
nks AS (SELECT c.k, max(abs(cb / tot_base - cc / tot_cur)) AS ks,
               sum(coalesce(abs((cb - n_base) / tot_base - (cc - n_cur) / tot_cur) * (v - pv), 0)) AS wasserstein
        FROM ncum c JOIN ntot t ON c.k = t.k GROUP BY c.k),
nedges AS (SELECT k + 1 AS k, {", ".join(f"quantile_cont(v, {i / 10}) AS e{i}" for i in range(1, 10))}
           FROM nb GROUP BY k),
nbk AS (SELECT s.k, {" + ".join(f"CAST(s.v > {e} AS INTEGER)" for e in _E)} AS b,
               sum(n_cur) AS bc, sum(n_base) AS bb
        FROM nsides s JOIN nedges e ON s.k = e.k GROUP BY 1, 2),
npsi AS (SELECT x.k, sum((greatest(bc / tot_cur, 1e-6) - greatest(bb / tot_base, 1e-6))
                         * ln(greatest(bc / tot_cur, 1e-6) / greatest(bb / tot_base, 1e-6))) AS psi
         FROM nbk x JOIN ntot t ON x.k = t.k GROUP BY x.k),
numd AS (SELECT t.k, CAST(tot_cur AS BIGINT) AS n, CAST(tot_base AS BIGINT) AS prev_n,
                sc / tot_cur - sb / tot_base AS mean_shift, ks, wasserstein, psi
         FROM ntot t JOIN nks USING (k) JOIN npsi USING (k))"""


@query("numeric_drift", f"""
WITH {fx.DRIFT_VIEW_SQL}, {NUMD_CTE}
SELECT k, n, prev_n, round(mean_shift, 6) AS mean_shift, round(ks, 6) AS ks,
       round(wasserstein, 6) AS wasserstein, round(psi, 6) AS psi FROM numd""")
def numeric_drift_q(spark, sf_dir):
    """Temperature mean shift, KS, Wasserstein-1 and decile PSI between windows."""
    d = numeric_drift(fx.drift_view(spark, sf_dir), "temperature", "date", WIDTH, ORIGIN)
    return d.select("k", "n", "prev_n", *[F.round(c, 6).alias(c) for c in
                                          ("mean_shift", "ks", "wasserstein", "psi")])


def _alerts_sql() -> str:
    cat = " UNION ALL ".join(
        f"SELECT k, 'location' AS \"column\", '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM catd"
        for m in ("new_values", "lost_values", "tv", "chi2", "psi", "js"))
    num = " UNION ALL ".join(
        f"SELECT k, 'temperature', '{m}', CAST({m} AS DOUBLE) FROM numd"
        for m in ("mean_shift", "ks", "wasserstein", "psi"))
    cond = " OR ".join(f"(metric = '{m}' AND abs(value) > {t!r})" for m, t in THRESHOLDS.items())
    case = " ".join(f"WHEN '{m}' THEN {t!r}" for m, t in THRESHOLDS.items())
    return f"""
WITH {fx.DRIFT_VIEW_SQL}, {_profile_cte('drift_view')}, {NULLD_CTE}, {CATD_CTE}, {NUMD_CTE},
dl AS (SELECT k, "column", 'null_rate_delta' AS metric, CAST(delta AS DOUBLE) AS value FROM nulld
       UNION ALL {cat} UNION ALL {num})
SELECT k, "column", metric, round(value, 6) AS value, CAST(CASE metric {case} END AS DOUBLE) AS threshold
FROM dl WHERE {cond}"""


@query("drift_alerts", _alerts_sql())
def drift_alerts_q(spark, sf_dir):
    """Every drift metric of the view against fixed thresholds."""
    dv = fx.drift_view(spark, sf_dir)
    p = profile(dv, "date", WIDTH, ORIGIN, COLS, detail=False)  # null rates only
    long = drift_long(nulls=null_drift(p),
                      categories={"location": category_drift(dv, "location", "date", WIDTH, ORIGIN)},
                      numerics={"temperature": numeric_drift(dv, "temperature", "date", WIDTH, ORIGIN)})
    a = drift_alerts(long, THRESHOLDS)
    return a.select("k", "column", "metric", F.round("value", 6).alias("value"), "threshold")


def drift_view_v2(dv):
    """The drift view with one edit in window 3: temperature + 1 where
    period = 3 and event_id % 7 = 0 (fixed values of the fixture)."""
    edit = (F.col("period") == 3) & (F.pmod(F.col("event_id"), F.lit(7)) == 0)
    return dv.withColumn("temperature", F.when(edit, F.col("temperature") + 1).otherwise(F.col("temperature")))


_V2_SQL = """
drift_v2 AS (SELECT event_id, date, location,
                    CASE WHEN period = 3 AND event_id % 7 = 0 THEN temperature + 1 ELSE temperature END AS temperature,
                    period FROM drift_view),
touched AS (SELECT DISTINCT """ + _k_sql("a.date") + """ AS k FROM drift_view b JOIN drift_v2 a USING (event_id)
            WHERE a.temperature IS DISTINCT FROM b.temperature OR a.location IS DISTINCT FROM b.location),
drift_v2t AS (SELECT * FROM drift_v2 WHERE """ + _k_sql("date") + """ IN (SELECT k FROM touched))"""


@query("profile_changes", f"""
WITH {fx.DRIFT_VIEW_SQL}, {_V2_SQL}, {_profile_cte('drift_v2t')} {PROFILE_SELECT}""")
def profile_changes_q(spark, sf_dir):
    """After an edit, re-profile only the windows its change set touches."""
    before = fx.drift_view(spark, sf_dir)
    after = drift_view_v2(before)
    ch = snapshot_changes(before, after, "event_id")
    return _round_profile(profile_changes(after, ch, "date", WIDTH, ORIGIN, COLS))


def drift_view_v3(dv):
    """The edit of window 3, and new rows in window 1: events whose number is
    divisible by 9, three hours later and 5 degrees warmer (fixed values of the fixture)."""
    v2 = drift_view_v2(dv)
    again = dv.where((F.col("period") == 1) & (F.pmod(F.col("event_id"), F.lit(9)) == 0))
    new = again.withColumns({"event_id": -F.col("event_id") - 1, "date": F.timestamp_add("HOUR", F.lit(3), F.col("date")),
                             "temperature": F.col("temperature") + 5})
    return v2.unionByName(new)


_V3_SQL = _V2_SQL.split("touched AS")[0].rstrip().rstrip(",") + """,
drift_v3 AS (SELECT * FROM drift_v2 UNION ALL
             SELECT -event_id - 1, date + INTERVAL 3 HOUR, location, temperature + 5, period FROM drift_view
             WHERE period = 1 AND event_id % 9 = 0)"""


def sketches_near(view, p, share):
    """(k, column, n, present, distinct_near, quartiles_near): what a profile's
    sketches say, held against counts over the rows of the view: distinct counts
    within 5 %, quartiles within ``share`` of all ranks."""
    cell = lambda c, x: F.struct(F.lit(c).alias("column"), x.alias("v"), F.col(c).cast("string").alias("s"))
    long = view.select(window_index("date", WIDTH, ORIGIN).alias("k"), F.explode(F.array(
        cell("temperature", F.col("temperature")), cell("location", F.lit(None).cast("double")))).alias("c")).select("k", "c.*")
    marks = ["p25", "p50", "p75"]
    j = long.join(p.select("k", "column", "distinct", *marks), ["k", "column"])
    near = j.groupBy("k", "column").agg(
        F.count(F.lit(1)).alias("n"), F.count("s").alias("present"), F.count("v").alias("m"),
        (F.abs(F.count_distinct("s") - F.first("distinct")) <= 0.05 * F.count_distinct("s") + 0.5).alias("distinct_near"),
        *[F.count_if(F.col("v") < F.col(q)).alias(f"lo{q}") for q in marks],
        *[F.count_if(F.col("v") <= F.col(q)).alias(f"hi{q}") for q in marks])
    slack = F.greatest(share * F.col("m"), F.lit(1.0))
    fits = F.lit(True)
    for q, part in zip(marks, (0.25, 0.5, 0.75)):
        fits = fits & (F.col(f"lo{q}") <= part * F.col("m") + slack) & (F.col(f"hi{q}") >= part * F.col("m") - slack)
    return near.select("k", "column", "n", "present", "distinct_near", fits.alias("quartiles_near"))


@query("profile_incremental", f"""
WITH {fx.DRIFT_VIEW_SQL}, {_V3_SQL}, {_profile_cte('drift_v3')}
SELECT TIMESTAMP '{ORIGIN}' + INTERVAL (k * {fx.PERIOD_DAYS}) DAY AS "window", k, "column", n, nulls,
       round(CAST(nulls AS DOUBLE) / n, 6) AS null_rate, round("min", 6) AS "min", round("max", 6) AS "max",
       round(mean, 6) AS mean, round(std, 6) AS std, TRUE AS distinct_near, TRUE AS quartiles_near FROM prof""")
def profile_incremental(spark, sf_dir):
    """D1 + D6: the stored state of the drift view, brought up to date by the
    change set of a version with rewritten and new rows; equals the full profile
    of that version: exact parts as they are, distinct counts within 5 % and
    quartiles within 3 % of all ranks."""
    before = fx.drift_view(spark, sf_dir)
    after = drift_view_v3(before)
    state = written(profile_state(before, "date", WIDTH, ORIGIN, COLS), "state")
    changes = snapshot_changes(before, after, "event_id")
    p = state_profile(update_state(state, changes, after, "date", WIDTH, ORIGIN, COLS), WIDTH, ORIGIN)
    near = sketches_near(after, p, 0.03).select("k", "column", "distinct_near", "quartiles_near")
    out = p.join(near, ["k", "column"])
    return out.select("window", "k", "column", "n", "nulls", *[F.round(c, 6).alias(c) for c in ("null_rate", "min", "max", "mean", "std")],
                      "distinct_near", "quartiles_near")
