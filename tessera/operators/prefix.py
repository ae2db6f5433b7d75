"""Running totals without a single-task window.

``Window.partitionBy(g).orderBy(x)`` puts each group ``g`` in one task; when a
group is a whole split or a whole table, that is all rows in one task.  Here
each row gets a bucket that rises with the order column, each bucket computes
local running totals, and a small table of bucket totals (one row per bucket
and group) supplies each bucket's offset.  The bucket is a plain expression of
the order column, so however often it is planned or recomputed, a row keeps
its bucket.  Rows are shuffled once, by bucket; no task holds more than one
bucket of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_count(df: DataFrame, buckets: int | None) -> int:
    """``buckets``, or as many as there are shuffle partitions.  Give it for
    tables whose buckets would not fit a task."""
    if buckets:
        return buckets
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(value: Column, cuts: Sequence) -> Column:
    """How many of the ascending ``cuts`` lie below ``value`` (two short scans)."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    some = F.array(*[F.lit(c) for c in cuts[::step]])
    every = F.array(*[F.lit(c) for c in cuts])
    block = F.greatest(F.size(F.filter(some, lambda c: c < value)) - 1, F.lit(0))
    return block * step + F.size(F.filter(F.slice(every, block * step + 1, step), lambda c: c < value))


def numeric_buckets(df: DataFrame, order: str, buckets: int | None = None) -> Column:
    """A bucket for a numeric order column: cut points are read once, one row
    with a number per bucket reaches the driver, and enter as literals."""
    nb = bucket_count(df, buckets)
    if nb < 2:
        return F.lit(0)
    row = df.agg(F.percentile_approx(F.col(order).cast("double"), [i / nb for i in range(1, nb)], 100 * nb)).first()
    return bucket_of(F.col(order).cast("double"), sorted(set(row[0] or [])))


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Sequence[str],
                   buckets: int | None = None, prev_of: str | None = None,
                   bucket: Column | None = None) -> DataFrame:
    """Add ``cum_<s>`` = inclusive running total of ``s`` along ``order`` within
    ``by`` for every ``s`` in ``sums``.  Rows must be unique on by + order
    (aggregate first).  ``bucket`` must not fall along the first order column;
    without it cut points of that (numeric) column are used.  With ``prev_of`` (one of the order columns) also add
    ``prev_<prev_of>``: its value on the previous row of the group (NULL on
    the first row).
    """
    by, order, sums = list(by), list(order), list(sums)
    r = df.withColumn("_b", numeric_buckets(df, order[0], buckets) if bucket is None else bucket)
    w_local = Window.partitionBy("_b", *by).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = r.select("*", *[F.sum(s).over(w_local).alias(f"_lc_{s}") for s in sums])
    if prev_of:
        local = local.withColumn(f"_lp_{prev_of}",
                                 F.lag(prev_of).over(Window.partitionBy("_b", *by).orderBy(*order)))
    agg = [F.sum(s).alias(f"_bt_{s}") for s in sums]
    if prev_of:
        agg.append(F.max(prev_of).alias("_bmax"))
    totals = r.groupBy(*by, "_b").agg(*agg)
    w_off = Window.partitionBy(*by).orderBy("_b")
    w_prior = w_off.rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*by, "_b",
                         *[F.coalesce(F.sum(f"_bt_{s}").over(w_prior), F.lit(0)).alias(f"_off_{s}")
                           for s in sums],
                         *([F.lag("_bmax").over(w_off).alias("_pbmax")] if prev_of else []))
    # one row per (group, bucket)
    if not by:
        offs = F.broadcast(offs)  # at most as many rows as buckets
    j = local.join(offs, by + ["_b"], "left")
    out = j.select(*df.columns,
                   *[(F.col(f"_lc_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
                   *([F.coalesce(F.col(f"_lp_{prev_of}"), F.col("_pbmax")).alias(f"prev_{prev_of}")]
                     if prev_of else []))
    return out


def global_rank(df: DataFrame, order: Sequence[str], buckets: int | None = None,
                bucket: Column | None = None) -> DataFrame:
    """Add ``rank0``: 0-based position of each row in the total order given by
    ``order`` (which must make rows unique)."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    out = running_totals(one, [], order, ["_one"], buckets, bucket=bucket)
    return out.withColumn("rank0", F.col("cum__one") - 1).drop("_one", "cum__one")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    buckets: int | None = None, names: Sequence[str] | None = None,
                    distinct_name: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (``quantile_cont`` / ``percentile``)
    of ``value`` per group, distributed.

    Values are first counted per distinct value (map-side combined), then
    running counts locate the ranks ``floor(h)`` and ``ceil(h)`` with
    ``h = (n - 1) q``; NULLs are ignored.  Returns ``by`` + one double column
    per probability (``names`` or ``q<percent>``), plus the number of
    distinct values as ``distinct_name`` if given.
    """
    by = list(by)
    if not by:
        out = exact_quantiles(df.withColumn("_g", F.lit(0)), ["_g"], value, probs, buckets, names,
                              distinct_name)
        return out.drop("_g")
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))
    return quantiles_from_counts(counts, by, value, "_c", probs, buckets, names, distinct_name)


def quantile_aggs(value: str, count: str, cum: str, total: str, probs: Sequence[float],
                  names: Sequence[str]) -> tuple[list, list]:
    """Aggregates over rows (value, count, running count, group total) that
    give exact quantiles; returns (aggregates, final column expressions)."""
    lo_prev = F.col(cum) - F.col(count)
    aggs, finals = [], []
    for p, nm in zip(probs, names):
        h = (F.col(total) - 1) * F.lit(float(p))
        lo = F.floor(h)
        hi = F.ceil(h)
        cov_lo = (lo >= lo_prev) & (lo < F.col(cum))
        cov_hi = (hi >= lo_prev) & (hi < F.col(cum))
        aggs += [F.max(F.when(cov_lo, F.col(value).cast("double"))).alias(f"_{nm}_lo"),
                 F.max(F.when(cov_hi, F.col(value).cast("double"))).alias(f"_{nm}_hi"),
                 F.max(h - lo).alias(f"_{nm}_d")]
        finals.append((F.col(f"_{nm}_lo") + (F.col(f"_{nm}_hi") - F.col(f"_{nm}_lo"))
                       * F.col(f"_{nm}_d")).alias(nm))
    return aggs, finals


def quantiles_from_counts(counts: DataFrame, by: Sequence[str], value: str, count: str,
                          probs: Sequence[float], buckets: int | None = None,
                          names: Sequence[str] | None = None,
                          distinct_name: str | None = None) -> DataFrame:
    """:func:`exact_quantiles` over a table already counted per (by, value)."""
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100))}" for p in probs]
    cum = running_totals(counts, by, [value], [count], buckets)
    n = counts.groupBy(*by).agg(F.sum(count).alias("_n"))
    j = cum.join(n, by, "inner")
    aggs, finals = quantile_aggs(value, count, f"cum_{count}", "_n", probs, names)
    if distinct_name:
        aggs.append(F.count(F.lit(1)).alias(distinct_name))
    g = j.groupBy(*by).agg(*aggs)
    return g.select(*by, *finals, *([distinct_name] if distinct_name else []))
