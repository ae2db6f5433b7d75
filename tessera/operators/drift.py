"""Time-windowed profiles and drift.

Windows are tumbling, ``width`` long, aligned to ``origin``; window ``k``
covers ``[origin + k * width, origin + (k + 1) * width)``.  Drift compares
each window with the one before it (``k - 1 -> k``).  Metric formulas are
textbook; absent categories or buckets are smoothed to 1e-6 where a log or a
division needs it.

A profile has one row per window and column.  Value counts (window, column,
value) can be as large as the data for continuous columns: they are written
once, and the numeric comparisons use the distributed running totals, so no
comparison is sorted in one task.  NaN is a missing value throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .prefix import quantile_aggs, quantiles_from_counts, running_totals
from .stats import NUMERIC

SMOOTH = 1e-6


def _number(c: str) -> Column:
    """A column as a double, NaN as NULL."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _micros(width: str) -> int:
    n, unit = width.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
            "hours": 3600, "day": 86400, "days": 86400}[unit.lower()]
    return int(float(n) * mult * 1_000_000)


def window_index(ts: str | Column, width: str, origin: str) -> Column:
    """k = floor((ts - origin) / width) as a bigint."""
    c = F.col(ts) if isinstance(ts, str) else ts
    d = F.timestamp_diff("MICROSECOND", F.lit(origin).cast("timestamp_ntz"), c.cast("timestamp_ntz"))
    w = _micros(width)
    return ((d - F.pmod(d, F.lit(w))) / F.lit(w)).cast("bigint")


def window_start(k: str | Column, width: str, origin: str) -> Column:
    kk = F.col(k) if isinstance(k, str) else k
    return F.timestamp_add("MICROSECOND", kk * F.lit(_micros(width)),
                           F.lit(origin).cast("timestamp_ntz"))


def _split_columns(df: DataFrame, columns: Sequence[str] | None, skip: Sequence[str]):
    cols = [c for c in (columns or df.columns) if c not in skip]
    num = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    cat = [c for c in cols if c not in num]
    return num, cat


def profile(df: DataFrame, ts: str, width: str, origin: str,
            columns: Sequence[str] | None = None, approx: bool = False,
            detail: bool = True, slices: Sequence[str] = ()) -> DataFrame:
    """One row per (window, column): window (start), k, column, n, nulls,
    null_rate, distinct, min, max, mean, std, p25, p50, p75.  Numeric stats
    are NULL for non-numeric columns.  ``approx`` switches distinct counts and
    quartiles to their one-pass sketches; ``detail=False`` leaves them out
    (NULL), which saves the per-value pass when only counts are needed.  With
    ``slices`` (row columns) each of their value combinations is profiled too,
    in columns of those names.

    Exact distinct counts and quartiles share one table of counts per
    (window, column, value) and one running-count pass over it.
    """
    num, cat = _split_columns(df, columns, [ts, *slices])
    if slices:
        # one key: the window and the slice; NULL is a slice of its own
        key = F.struct(window_index(ts, width, origin).alias("k"), *slices)
        out = _profile(df, key, num, cat, approx, detail)
        out = out.select(F.col("k.k").alias("_k"), *[F.col(f"k.{s}").alias(s) for s in slices],
                         *[c for c in out.columns if c != "k"]).withColumnRenamed("_k", "k")
    else:
        out = _profile(df, window_index(ts, width, origin), num, cat, approx, detail)
    return out.select(
        window_start("k", width, origin).alias("window"), "k", *slices, "column", "n",
        (F.col("n") - F.col("_nn")).alias("nulls"),
        ((F.col("n") - F.col("_nn")).cast("double") / F.col("n").cast("double")).alias("null_rate"),
        "distinct", "min", "max", "mean", "std", "p25", "p50", "p75")


def _profile(df: DataFrame, key: Column, num: list[str], cat: list[str], approx: bool, detail: bool) -> DataFrame:
    k = key.alias("k")
    nulld = F.lit(None).cast("double")
    parts = []
    if num:
        long = (df.select(k, *[_number(c).alias(c) for c in num])
                .unpivot(["k"], num, "column", "value"))
        aggs = [F.count(F.lit(1)).alias("n"), F.count("value").alias("_nn"),
                F.min("value").alias("min"), F.max("value").alias("max"),
                F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")]
        if not detail:
            base = long.groupBy("k", "column").agg(
                *aggs, F.lit(None).cast("bigint").alias("distinct"),
                *[nulld.alias(c) for c in ("p25", "p50", "p75")])
        elif approx:
            base = long.groupBy("k", "column").agg(
                *aggs, F.approx_count_distinct("value").alias("distinct"),
                F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("_q")).select(
                "*", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(("p25", "p50", "p75"))]).drop("_q")
        else:
            # One pass over the rows: counts per (window, column, value), NULL
            # included; every statistic below reads this (materialized) table.
            counts = materialize(long.groupBy("k", "column", "value")
                                 .agg(F.count(F.lit(1)).alias("_c")))
            nonnull = counts.filter(F.col("value").isNotNull())
            first = counts.groupBy("k", "column").agg(
                F.sum("_c").alias("n"),
                F.sum(F.when(F.col("value").isNotNull(), F.col("_c"))).alias("_nn"),
                F.min("value").alias("min"), F.max("value").alias("max"),
                (F.sum(F.col("value") * F.col("_c")) / F.sum(F.when(F.col("value").isNotNull(), F.col("_c"))))
                .alias("mean"))
            # sample std, two-pass (centred) over the distinct values
            dev = nonnull.join(first.select("k", "column", "mean"), ["k", "column"]) \
                .groupBy("k", "column").agg(
                    F.sum(F.col("_c") * (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean")))
                    .alias("_ss"))
            q = quantiles_from_counts(nonnull, ["k", "column"], "value", "_c", [0.25, 0.5, 0.75],
                                      names=["p25", "p50", "p75"], distinct_name="distinct")
            base = (first.join(dev, ["k", "column"], "left").join(q, ["k", "column"], "left")
                    .withColumn("std", F.when(F.col("_nn") > 1, F.sqrt(F.col("_ss") / (F.col("_nn") - 1))))
                    .withColumn("_nn", F.coalesce(F.col("_nn"), F.lit(0).cast("bigint")))
                    .withColumn("distinct", F.coalesce(F.col("distinct"), F.lit(0).cast("bigint")))
                    .drop("_ss"))
        parts.append(base)
    if cat:
        long = (df.select(k, *[F.col(c).cast("string").alias(c) for c in cat])
                .unpivot(["k"], cat, "column", "value"))
        if not detail:
            dist = F.lit(None).cast("bigint")
        else:
            dist = F.approx_count_distinct("value") if approx else F.count_distinct("value")
        parts.append(long.groupBy("k", "column").agg(
            F.count(F.lit(1)).alias("n"), F.count("value").alias("_nn"), dist.alias("distinct"),
            *[nulld.alias(c) for c in ("min", "max", "mean", "std", "p25", "p50", "p75")]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def null_drift(prof: DataFrame, baseline: int | None = None) -> DataFrame:
    """Null rate of each window against the previous window of the same
    column: (k, column, null_rate, prev_null_rate, delta).  The profile has
    one row per window and column, so the per-column window is tiny.  With
    ``baseline`` every other window is compared with that window instead."""
    if baseline is not None:
        b = prof.where(F.col("k") == baseline).select("column", F.col("null_rate").alias("prev_null_rate"))
        p = prof.where(F.col("k") != baseline).select("k", "column", "null_rate").join(b, "column")
        return p.select("k", "column", "null_rate", "prev_null_rate",
                        (F.col("null_rate") - F.col("prev_null_rate")).alias("delta"))
    w = Window.partitionBy("column").orderBy("k")
    p = prof.select("k", "column", "null_rate",
                    F.lag("k").over(w).alias("_pk"), F.lag("null_rate").over(w).alias("prev_null_rate"))
    p = p.filter(F.col("_pk") == F.col("k") - 1)
    return p.select("k", "column", "null_rate", "prev_null_rate",
                    (F.col("null_rate") - F.col("prev_null_rate")).alias("delta"))


def _pairs(freq: DataFrame) -> DataFrame:
    """(k, value, cur_cnt, prev_cnt, cur_total, prev_total): every value of
    window k or k-1, for windows k whose predecessor exists.  Each count is a
    row of its own window and of the next one's comparison, and one aggregation
    brings the two together; NULL is a value like any other."""
    zero = F.lit(0).cast("bigint")
    sides = freq.select("k", "value", F.col("cnt").alias("cur_cnt"), zero.alias("prev_cnt")).unionByName(
        freq.select((F.col("k") + 1).alias("k"), "value", zero.alias("cur_cnt"), F.col("cnt").alias("prev_cnt")))
    per = sides.groupBy("k", "value").agg(F.sum("cur_cnt").alias("cur_cnt"), F.sum("prev_cnt").alias("prev_cnt"))
    tot = sides.groupBy("k").agg(F.sum("cur_cnt").alias("cur_total"), F.sum("prev_cnt").alias("prev_total"))
    return per.join(tot.where("cur_total > 0 and prev_total > 0"), "k")


def category_frequencies(df: DataFrame, col: str, ts: str, width: str, origin: str) -> DataFrame:
    """(k, value, cnt): counts per window and value, NULL as its own category;
    partial aggregation keeps a hot value at one row per task."""
    return (df.select(window_index(ts, width, origin).alias("k"), F.col(col).cast("string").alias("value"))
            .groupBy("k", "value").agg(F.count(F.lit(1)).alias("cnt")))


def category_changes(df: DataFrame, col: str, ts: str, width: str, origin: str) -> DataFrame:
    """D3 detail: values that appear ('new') or vanish ('lost') from k-1 to k."""
    j = _pairs(category_frequencies(df, col, ts, width, origin))
    return j.select("k", "value", F.when(F.col("prev_cnt") == 0, "new")
                    .when(F.col("cur_cnt") == 0, "lost").alias("change"),
                    F.col("prev_cnt").alias("prev_count"), F.col("cur_cnt").alias("count")) \
            .filter(F.col("change").isNotNull())


def category_drift(df: DataFrame, col: str, ts: str, width: str, origin: str) -> DataFrame:
    """D3: per window k (against k-1): new_values, lost_values, total
    variation, chi-square, PSI and Jensen-Shannon divergence (natural log)."""
    j = _pairs(category_frequencies(df, col, ts, width, origin))
    p = F.col("cur_cnt") / F.col("cur_total")
    q = F.col("prev_cnt") / F.col("prev_total")
    ps, qs = F.greatest(p, F.lit(SMOOTH)), F.greatest(q, F.lit(SMOOTH))
    m = (p + q) / 2
    e = F.col("cur_total") * qs
    kl = lambda a: F.when(a > 0, a * F.log(a / m)).otherwise(0.0)
    return j.groupBy("k").agg(
        F.count_if((F.col("prev_cnt") == 0) & (F.col("cur_cnt") > 0)).alias("new_values"),
        F.count_if((F.col("cur_cnt") == 0) & (F.col("prev_cnt") > 0)).alias("lost_values"),
        (F.sum(F.abs(p - q)) / 2).alias("tv"),
        F.sum((F.col("cur_cnt") - e) * (F.col("cur_cnt") - e) / e).alias("chi2"),
        F.sum((ps - qs) * F.log(ps / qs)).alias("psi"),
        F.sum(0.5 * kl(p) + 0.5 * kl(q)).alias("js"))


PSI_EDGES = [i / 10 for i in range(1, 10)]


def numeric_drift(df: DataFrame, col: str, ts: str, width: str, origin: str,
                  buckets: int | None = None) -> DataFrame:
    """Per window k (against k-1): n, prev_n, mean_shift, ks, wasserstein
    and psi over the deciles of window k-1.  NULLs are ignored.

    Values are counted per (comparison, value), each window being the current
    side of its own comparison and the baseline side of the next one.  One
    running-total pass gives both empirical CDFs at every distinct value, and
    from the baseline's running count also the decile edges; a second small
    aggregate buckets both sides on those edges.
    """
    v = _number(col)
    base = (df.select(window_index(ts, width, origin).alias("k"), v.alias("v"))
            .filter(F.col("v").isNotNull()))
    cnt = base.groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    sides = cnt.select("k", "v", F.col("c").alias("n_cur"), F.lit(0).cast("bigint").alias("n_base")) \
        .unionByName(cnt.select((F.col("k") + 1).alias("k"), "v", F.lit(0).cast("bigint").alias("n_cur"),
                                F.col("c").alias("n_base")))
    per = materialize(sides.groupBy("k", "v").agg(F.sum("n_cur").alias("n_cur"),
                                                  F.sum("n_base").alias("n_base")))
    tot = per.groupBy("k").agg(F.sum("n_cur").alias("tot_cur"), F.sum("n_base").alias("tot_base"),
                               F.sum(F.col("v") * F.col("n_cur")).alias("_sc"),
                               F.sum(F.col("v") * F.col("n_base")).alias("_sb")) \
        .filter((F.col("tot_cur") > 0) & (F.col("tot_base") > 0))
    cum = running_totals(per, ["k"], ["v"], ["n_cur", "n_base"], buckets, prev_of="v")
    j = cum.join(tot, "k")
    d_here = F.col("cum_n_base") / F.col("tot_base") - F.col("cum_n_cur") / F.col("tot_cur")
    d_prev = ((F.col("cum_n_base") - F.col("n_base")) / F.col("tot_base")
              - (F.col("cum_n_cur") - F.col("n_cur")) / F.col("tot_cur"))
    w1 = F.coalesce(F.abs(d_prev) * (F.col("v") - F.col("prev_v")), F.lit(0.0))
    names = [f"e{i}" for i in range(1, 10)]
    # baseline rows only (n_base > 0) locate the baseline's decile edges
    jb = j.withColumn("_vb", F.when(F.col("n_base") > 0, F.col("v")))
    q_aggs, q_finals = quantile_aggs("_vb", "n_base", "cum_n_base", "tot_base", PSI_EDGES, names)
    stats = jb.groupBy("k", "tot_cur", "tot_base", "_sc", "_sb").agg(
        F.max(F.abs(d_here)).alias("ks"), F.sum(w1).alias("wasserstein"), *q_aggs) \
        .select("k", "tot_cur", "tot_base", "_sc", "_sb", "ks", "wasserstein", *q_finals)
    # stats has one row per comparison: bounded by the number of windows
    bucket = sum((F.col("v") > F.col(e)).cast("int") for e in names)
    bk = per.join(stats.select("k", "tot_cur", "tot_base", *names), "k") \
        .groupBy("k", "tot_cur", "tot_base", bucket.alias("b")) \
        .agg(F.sum("n_cur").alias("bc"), F.sum("n_base").alias("bb"))
    pc = F.greatest(F.col("bc") / F.col("tot_cur"), F.lit(SMOOTH))
    pb = F.greatest(F.col("bb") / F.col("tot_base"), F.lit(SMOOTH))
    psi = bk.groupBy("k").agg(F.sum((pc - pb) * F.log(pc / pb)).alias("psi"))
    return stats.join(psi, "k").select(
        "k", F.col("tot_cur").alias("n"), F.col("tot_base").alias("prev_n"),
        (F.col("_sc") / F.col("tot_cur") - F.col("_sb") / F.col("tot_base")).alias("mean_shift"),
        "ks", "wasserstein", "psi")


def drift_long(nulls: DataFrame | None = None, categories: dict[str, DataFrame] | None = None,
               numerics: dict[str, DataFrame] | None = None) -> DataFrame:
    """Stack drift tables to (k, column, metric, value)."""
    parts = []

    def add(d: DataFrame, column: Column, metrics: dict[str, str]) -> None:
        wide = d.select("k", column.alias("column"), *[F.col(c).cast("double").alias(m) for m, c in metrics.items()])
        parts.append(wide.unpivot(["k", "column"], list(metrics), "metric", "value"))
    if nulls is not None:
        add(nulls, F.col("column"), {"null_rate_delta": "delta"})
    for col, d in (categories or {}).items():
        add(d, F.lit(col), {m: m for m in ("new_values", "lost_values", "tv", "chi2", "psi", "js")})
    for col, d in (numerics or {}).items():
        add(d, F.lit(col), {m: m for m in ("mean_shift", "ks", "wasserstein", "psi")})
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_alerts(drift: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Rows of a long drift table whose |value| exceeds its metric's threshold."""
    th = None
    for m, t in thresholds.items():
        c = (F.col("metric") == m) & (F.abs(F.col("value")) > F.lit(float(t)))
        th = c if th is None else th | c
    return drift.filter(th).withColumn(
        "threshold", F.element_at(F.create_map(*[x for m, t in thresholds.items()
                                                 for x in (F.lit(m), F.lit(float(t)))]),
                                  F.col("metric")))


def touched_windows(changes: DataFrame, ts: str, width: str, origin: str) -> DataFrame:
    """Windows (k) that a change set (pre and post images) touches."""
    return changes.select(window_index(ts, width, origin).alias("k")).distinct()


def profile_changes(after: DataFrame, changes: DataFrame, ts: str, width: str, origin: str,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Profile only the windows the change set touches: a semi join of the
    new snapshot on those windows, behind a range filter on ``ts`` (from the
    first to the last touched window) that the scan can use."""
    k = touched_windows(changes, ts, width, origin)
    span = k.agg(window_start(F.min("k"), width, origin).alias("lo"), window_start(F.max("k") + 1, width, origin).alias("hi"))
    after = after.where((F.col(ts) >= span.select("lo").scalar()) & (F.col(ts) < span.select("hi").scalar()))
    sub = after.withColumn("_k", window_index(ts, width, origin)) \
               .join(k.withColumnRenamed("k", "_k"), "_k", "left_semi").drop("_k")
    return profile(sub, ts, width, origin, columns)
