"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Each document gets word statistics; a document that fails the base rules is
out.  The others form a point of five transformed statistics.  Per language
and source a minimum-covariance-determinant (MCD) estimate of centre and
scatter is fitted to the ``coverage`` of the points that lie closest together,
and points whose Mahalanobis distance from it is beyond a chi-square quantile
are rejected.

How the estimate is found: two starts per group (mean and covariance; medians
and quartile ranges) are improved by concentration steps: distances from the
present estimate, then the moments of the nearest ``coverage`` of the points.
The start with the smaller determinant wins.  One step is one aggregation: the
distances are cut into bins on a logarithmic scale, moments are summed per
(group, bin) map-side, and the first bins that hold the wanted share are added
up.  A group of any size thus leaves a few hundred rows per task.  Points are
held as integers (in 1/256), so all sums are exact and a repeated task gives
the same verdicts.

Edge cases: null or blank text has no words and fails the base rules; null
language and source are groups like others; groups with fewer than
``min_group`` points use the estimate of all points together; an empty table
gives an empty result; repeated rows are rows like others; columns of the
input named like a statistic are replaced in ``quality_stats``'s result, and
``keep_good`` returns the input's columns unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, written

UNIT = 256
#: least standard deviation assumed of each statistic: what differs by less is not unusual
FLOORS = (0.3, 0.05, 0.03, 0.05, 0.05)
P = len(FLOORS)
STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
X = [f"_x{i}" for i in range(P)]


def chi2_cdf(x: float, k: float) -> float:
    term = total = 1.0 / math.gamma(k / 2 + 1)
    for i in range(1, 400):
        term *= (x / 2) / (k / 2 + i)
        total += term
    return total * math.exp(-x / 2) * (x / 2) ** (k / 2)


def chi2_quantile(p: float, k: float) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def repeat_words(words: Column, size: int, repeated: Column) -> Column:
    """Words covered by the windows at the ascending 0-based positions."""
    nxt = F.concat(F.slice(repeated, 2, F.size(repeated)), F.array(F.lit(1 << 40)))
    return F.aggregate(F.zip_with(repeated, nxt, lambda a, b: F.least(b - a, F.lit(size))),
                       F.lit(0).cast("bigint"), lambda acc, v: acc + v)


def quality_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the word statistics of ``text`` (long columns) added.

    A window is five consecutive words; equal windows are found by 64-bit
    hash.  Only a text in which some window occurs twice sorts its windows.
    """
    spaces = r"[\x20\x09-\x0D]+"
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(WHITE))
    d = docs.withColumns({
        "_w": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, spaces)),
        "_l": F.filter(F.split(t, "\n"), lambda s: F.btrim(s, F.lit(WHITE)) != "")})
    d = d.withColumn("_h", F.when(F.size("_w") < 5, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("_w") - 5),
                    lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(5)]))))
    # sorted (hash, position) pairs of texts with repeats; equal neighbours are repeats
    pairs = F.sort_array(F.transform(F.col("_h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) == F.size("_h"),
                                  F.lit(None)).otherwise(pairs))
    same = F.filter(F.transform(F.col("_s"), lambda s, j: F.when(
        (s["h"] == F.get(F.col("_s"), j + 1)["h"]) | ((j > 0) & (s["h"] == F.get(F.col("_s"), F.greatest(j - 1, F.lit(0)))["h"])),
        s["i"])), lambda i: i.isNotNull())
    d = d.withColumn("_r", F.when(F.col("_s").isNotNull(), F.sort_array(same)))
    out = {
        "n_words": F.size("_w"), "word_chars": F.char_length(F.array_join("_w", "")),
        "n_symbols": F.char_length(t) - F.char_length(F.regexp_replace(t, r"[#*$%&|<>]", "")),
        "n_lines": F.size("_l"), "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.coalesce(repeat_words(F.col("_w"), 5, F.col("_r")), F.lit(0))}
    d = d.withColumns({k: v.cast("bigint") for k, v in out.items()}).drop("_w", "_l", "_h", "_s", "_r")
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def points(stats: DataFrame) -> DataFrame:
    """The transformed statistics as integers in units of 1/256."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    f = [F.log(n), F.log(chars / n), F.sqrt(F.col("n_symbols") / chars),
         F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]
    return stats.withColumns({c: F.round(v * UNIT).cast("bigint") for c, v in zip(X, f)})


def cholesky(mean: list[Column], cov) -> tuple[dict, dict]:
    """Columns m_i and l_i_j of the estimate; ``cov(i, j)`` with the least
    variances added to the diagonal."""
    return {f"m_{i}": mean[i] for i in range(P)}, {f"c_{i}_{j}": cov(i, j) + (
        F.lit((FLOORS[i] * UNIT) ** 2) if i == j else F.lit(0.0)) for i in range(P) for j in range(i + 1)}


def factor(df: DataFrame) -> DataFrame:
    """c_i_j (covariances) to l_i_j (their Cholesky factor) and log_det."""
    for j in range(P):
        done = [F.col(f"l_{j}_{k}") for k in range(j)]
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(
            F.col(f"c_{j}_{j}") - sum((v * v for v in done), F.lit(0.0)), F.lit(1.0))))
        df = df.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - sum(
            (F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l_{j}_{j}")
            for i in range(j + 1, P)}) if j + 1 < P else df
    det = sum((F.log(F.col(f"l_{j}_{j}")) for j in range(P)), F.lit(0.0))
    return df.withColumn("log_det", det).drop(*[f"c_{i}_{j}" for i in range(P) for j in range(i + 1)])


def with_distance(df: DataFrame, scale: float = 1.0) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    ys = []
    for i in range(P):
        df = df.withColumn(f"_y{i}", (F.col(X[i]) - F.col(f"m_{i}") - sum(
            (F.col(f"l_{i}_{k}") * F.col(f"_y{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l_{i}_{i}"))
        ys.append(f"_y{i}")
    return df.withColumn("d2", sum((F.col(y) * F.col(y) for y in ys), F.lit(0.0)) / F.lit(scale)).drop(*ys)


def moment_sums() -> list[Column]:
    x = [F.col(c) for c in X]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s_{i}") for i in range(P)],
            *[F.sum(x[i] * x[j]).alias(f"q_{i}_{j}") for i in range(P) for j in range(i + 1)]]


def from_sums(df: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("n").cast("double")
    mean = [F.col(f"s_{i}") / n for i in range(P)]
    m, c = cholesky(mean, lambda i, j: F.col(f"q_{i}_{j}") / n - mean[i] * mean[j])
    return factor(df.select(*keys, *[v.alias(k) for k, v in {**m, **c}.items()]))


def concentrate(pts: DataFrame, est: DataFrame, coverage: float) -> DataFrame:
    """One concentration step for every group and start."""
    keys = ["_lang", "_source", "_pooled", "start"]
    d = with_distance(joined(pts, est))
    b = (d.withColumn("bin", F.floor(F.log2(1 + F.col("d2")) * 16).cast("int"))
         .groupBy(*keys, "bin").agg(*moment_sums()))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys)
    b = (b.withColumn("_before", F.coalesce(F.sum("n").over(
            w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_all", F.sum("n").over(w))
         .where(F.col("_before") < F.lit(coverage) * F.col("_all")))
    sums = [f"s_{i}" for i in range(P)] + [f"q_{i}_{j}" for i in range(P) for j in range(i + 1)]
    return from_sums(b.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums]), keys)


def joined(pts: DataFrame, est: DataFrame, how: str = "inner") -> DataFrame:
    e = est.withColumnsRenamed({"_lang": "e_lang", "_source": "e_source", "_pooled": "e_pooled"})
    return pts.join(e, F.col("_lang").eqNullSafe(F.col("e_lang")) & F.col("_source").eqNullSafe(F.col("e_source"))
                    & (F.col("_pooled") == F.col("e_pooled")), how).drop("e_lang", "e_source", "e_pooled")


def mcd_estimates(pts: DataFrame, coverage: float = 0.75, steps: int = 3, min_group: int = 50) -> DataFrame:
    """One row per group: (_lang, _source, _pooled), m_i, l_i_j.  ``pts`` has
    the points and group columns ``lang`` and ``source``."""
    pts = pts.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *X).withColumn("_pooled", F.lit(False))
    pooled = pts.withColumns({"_lang": F.lit(None).cast("string"), "_source": F.lit(None).cast("string"), "_pooled": F.lit(True)})
    keys = ["_lang", "_source", "_pooled"]
    both = pts.unionByName(pooled)
    quart = [F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"_p{i}") for i, c in enumerate(X)]
    first = written(both.groupBy(*keys).agg(*moment_sums(), *quart)
                    .where(F.col("_pooled") | (F.col("n") >= min_group)), "mcd-start")
    classic = from_sums(first, keys).withColumn("start", F.lit(0))
    med = [F.col(f"_p{i}")[1] for i in range(P)]
    m, c = cholesky(med, lambda i, j: F.pow((F.col(f"_p{i}")[2] - F.col(f"_p{i}")[0]) / 1.349, 2.0) if i == j else F.lit(0.0))
    robust = factor(first.select(*keys, *[v.alias(k) for k, v in {**m, **c}.items()])).withColumn("start", F.lit(1))
    est = written(classic.unionByName(robust), "mcd-step")
    for _ in range(steps):
        est = written(concentrate(both, est, coverage), "mcd-step")
    cols = [c for c in est.columns if c not in (*keys, "start", "log_det")]
    best = est.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct("log_det", "start")).alias("e"))
    return written(best.select(*keys, "e.*"), "mcd")


def judged(stats: DataFrame, learned: DataFrame | None = None, coverage: float = 0.75, quantile: float = 0.9999999, **kw) -> DataFrame:
    """Adds ``d2`` and ``kept`` to a frame with statistics, ``lang`` and
    ``source``.  ``learned``, the statistics that the estimates are made from
    (the frame's own if not given), is read several times: pass a written one."""
    pts = points(stats)
    own = pts if learned is None else points(learned)
    est = mcd_estimates(own.where(~F.col("base_failed")), coverage, **kw)
    # the factor that makes the scatter of the nearest share right for normal points
    scale = coverage / chi2_cdf(chi2_quantile(coverage, P), P + 2)
    pts = pts.withColumns({"_lang": F.col("lang"), "_source": F.col("source"), "_pooled": F.lit(False)})
    # a group without an estimate of its own looks up the one of all points
    d = joined(pts, est.select("_lang", "_source", "_pooled", F.lit(True).alias("_own")), "left")
    d = d.withColumns({"_lang": F.when(F.col("_own"), F.col("_lang")), "_source": F.when(F.col("_own"), F.col("_source")),
                       "_pooled": F.col("_own").isNull()}).drop("_own")
    d = joined(d, est, "left")
    d = with_distance(d, scale)
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= chi2_quantile(quantile, P), F.lit(True))
    return d.withColumn("kept", kept)


def quality(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, statistics, base_failed, d2 and kept of every document."""
    cols = ["doc_id", "lang", "source"]
    stats = written(quality_stats(docs.select(*cols, "text")).drop("text"), "quality-stats")
    return judged(stats, **kw).select("doc_id", *STATS, "base_failed", "d2", "kept")


def keep_good(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its own columns."""
    cols = ["lang", "source"]
    stats = written(quality_stats(docs.select(*cols, "text")).drop("text"), "quality-stats")
    # the statistics are computed again where the rows pass by, once a row (inline
    # keeps the filter from repeating them): no copy of the texts is kept
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *cols, "text")
    again = quality_stats(wide).select("_row", *cols, F.inline(F.array(F.struct(*STATS, "base_failed"))))
    return judged(again, stats, **kw).where("kept").select("_row.*")
