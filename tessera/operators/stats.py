"""Descriptive statistics and fitted lines.

Every statistic is one aggregation (partial aggregation map-side, one small
shuffle); nothing is collected except the final few rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def to_long(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value",
            keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` to (keep..., column, value double); a narrow map-side expand."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    return df.select(*keep, *[number(c).alias(c) for c in cols]) \
             .unpivot(list(keep), list(cols), name, value)


DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def describe(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
             accuracy: int = 10000) -> DataFrame:
    """A1 in long form (column, stat, value).  Missing values are ignored.

    Quartiles are exact by default (linear interpolation, distributed through
    running counts); ``approx=True`` uses ``percentile_approx`` in one pass.
    """
    cols = list(cols) if cols else numeric_columns(df)
    long = to_long(df, cols)
    base = long.groupBy("column").agg(
        F.count("value").cast("double").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"))
    if approx:
        q = long.groupBy("column").agg(
            F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy).alias("_q")).select(
            "column", *[F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    else:
        q = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75])
    wide = base.join(q, "column", "left")
    pairs = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
             ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "max")]
    stack = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(c).cast("double").alias("value"))
                                for s, c in pairs]))
    return wide.select("column", stack.alias("_s")).select("column", "_s.stat", "_s.value")


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A2: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def ols(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """One-feature least squares with intercept, from sufficient
    statistics (``regr_*``), per group if ``by`` is given."""
    yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*by).agg(
        F.regr_count(yc, xc).alias("n"),
        F.regr_slope(yc, xc).alias("slope"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.regr_r2(yc, xc).alias("r2"))


def pair_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For every ordered pair (x, y) of distinct columns, n, corr and the
    fitted line y = slope * x + intercept with its r2.

    One aggregate of centred co-moments per unordered pair (count, means,
    population variances, covariance over rows where both are present) serves
    both directions; few enough buffer fields to stay in generated code.
    """
    cols = list(cols)
    aggs, pairs = [], []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = cols[i], cols[j]
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x = F.when(both, F.col(a).cast("double"))
            y = F.when(both, F.col(b).cast("double"))
            k = f"{i}_{j}"
            pairs.append((a, b, k))
            aggs += [F.count(x).alias(f"n_{k}"), F.avg(x).alias(f"ma_{k}"), F.avg(y).alias(f"mb_{k}"),
                     F.var_pop(x).alias(f"va_{k}"), F.var_pop(y).alias(f"vb_{k}"),
                     F.covar_pop(x, y).alias(f"c_{k}")]
    wide = df.agg(*aggs)

    def direction(xc, yc, k, x_is_a):
        vx, vy = (F.col(f"va_{k}"), F.col(f"vb_{k}")) if x_is_a else (F.col(f"vb_{k}"), F.col(f"va_{k}"))
        mx, my = (F.col(f"ma_{k}"), F.col(f"mb_{k}")) if x_is_a else (F.col(f"mb_{k}"), F.col(f"ma_{k}"))
        cov = F.col(f"c_{k}")
        slope = F.when(vx != 0, cov / vx)
        corr = F.when((vx != 0) & (vy != 0), cov / (F.sqrt(vx) * F.sqrt(vy)))
        r2 = F.when(vx == 0, F.lit(None)).when(vy == 0, F.lit(1.0)).otherwise(corr * corr)
        return F.struct(F.lit(xc).alias("x"), F.lit(yc).alias("y"), F.col(f"n_{k}").alias("n"),
                        corr.alias("corr"), slope.alias("slope"), (my - slope * mx).alias("intercept"),
                        r2.cast("double").alias("r2"))

    rows = []
    for a, b, k in pairs:
        rows += [direction(a, b, k, True), direction(b, a, k, False)]
    return wide.select(F.explode(F.array(*rows)).alias("_p")).select("_p.*")


def linear_grid(lo: float, hi: float, n: int) -> list[float]:
    return [lo + (hi - lo) * i / (n - 1) for i in range(n)] if n > 1 else [lo]


def _with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as scalar
    subqueries (evaluated once, inlined as literals; no join)."""
    return df.select("*", *[scalars.select(c).scalar().alias(c) for c in scalars.columns])


def kde(df: DataFrame, col: str, grid: Sequence[float], bandwidth: float | None = None) -> DataFrame:
    """A8 (1-D): Gaussian kernel density at each grid point; (gi, x, density).

    The grid is the caller's, so each point is one sum over the scan, combined
    map-side; no row is copied and only one row per task is shuffled.
    Bandwidth: Scott's rule n^(-1/5) * sd unless given.
    """
    v = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    stats = vals.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("_sd"))
    h = (F.pow(F.col("n"), -0.2) * F.col("_sd")) if bandwidth is None else F.lit(float(bandwidth))
    stats = stats.select("n", h.alias("h"))
    sums = [F.sum(_kernel(F.col("v"), x, F.col("h"))) for x in grid]
    points = F.array(*[F.struct(F.lit(i).alias("gi"), F.lit(float(x)).alias("x"), s.alias("s"))
                       for i, (x, s) in enumerate(zip(grid, sums))])
    one = _with_scalars(vals, stats).agg(points.alias("_p"), F.max("n").alias("n"), F.max("h").alias("h"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (one.where(F.col("n") > 0).select("n", "h", F.explode("_p").alias("_p"))
            .select(F.col("_p.gi").cast("int").alias("gi"), "_p.x", (F.col("_p.s") / norm).alias("density")))


def _kernel(v: Column, x: float, h: Column) -> Column:
    z = (F.lit(float(x)) - v) / h
    return F.exp(-0.5 * z * z)


def kde2(df: DataFrame, x: str, y: str, grid_x: Sequence[float], grid_y: Sequence[float],
         bandwidth: tuple[float, float] | None = None) -> DataFrame:
    """A8 (2-D): product Gaussian kernel density on the grid_x x grid_y
    lattice; (gx, gy, x, y, density), as sums over the scan.  Scott's rule
    n^(-1/6) * sd per axis."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    vals = df.select(xv.alias("vx"), yv.alias("vy")).filter(
        F.col("vx").isNotNull() & F.col("vy").isNotNull())
    stats = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("vx").alias("_sx"),
                     F.stddev_samp("vy").alias("_sy"))
    if bandwidth is None:
        f = F.pow(F.col("n"), -1.0 / 6)
        stats = stats.select("n", (f * F.col("_sx")).alias("hx"), (f * F.col("_sy")).alias("hy"))
    else:
        stats = stats.select("n", F.lit(float(bandwidth[0])).alias("hx"),
                             F.lit(float(bandwidth[1])).alias("hy"))
    # the kernel is a product: a row per grid line of x with its factor, one sum
    # per grid line of y; few enough sums to stay in generated code
    d = _with_scalars(vals, stats)
    lines = F.array(*[F.struct(F.lit(i).alias("gx"), F.lit(float(u)).alias("x"), _kernel(F.col("vx"), u, F.col("hx")).alias("kx"))
                      for i, u in enumerate(grid_x)])
    d = d.select("n", "hx", "hy", "vy", F.explode(lines).alias("_l"))
    sums = [F.sum(F.col("_l.kx") * _kernel(F.col("vy"), v, F.col("hy"))) for v in grid_y]
    points = F.array(*[F.struct(F.col("_l.gx").alias("gx"), F.lit(j).alias("gy"), F.col("_l.x").alias("x"), F.lit(float(v)).alias("y"), s.alias("s"))
                       for j, (v, s) in enumerate(zip(grid_y, sums))])
    one = d.groupBy("_l.gx", "_l.x").agg(points.alias("_p"), F.max("n").alias("n"), F.max("hx").alias("hx"), F.max("hy").alias("hy"))
    norm = F.col("n") * F.col("hx") * F.col("hy") * F.lit(2 * math.pi)
    return (one.where(F.col("n") > 0).select("n", "hx", "hy", F.explode("_p").alias("_p"))
            .select(F.col("_p.gx").cast("int").alias("gx"), F.col("_p.gy").cast("int").alias("gy"),
                    "_p.x", "_p.y", (F.col("_p.s") / norm).alias("density")))


FAR = 9.0  # bandwidths; a kernel beyond them is below 3e-18


def _pieces(v: Column, lo: float, step: Column) -> Column:
    """A value's shares of the two nodes beside it: node 0 is ``lo``, nodes are
    ``step`` apart."""
    at = (v - F.lit(float(lo))) / step
    i = F.floor(at)
    return F.array(F.struct(i.alias("i"), (1 - (at - i)).alias("w")), F.struct((i + 1).alias("i"), (at - i).alias("w")))


def kde_binned(df: DataFrame, col: str, grid: Sequence[float], bandwidth: float | None = None, per_bandwidth: int = 32) -> DataFrame:
    """A8 (1-D) by linear binning: each value is shared out to the two nodes
    beside it on a grid of ``per_bandwidth`` nodes a bandwidth, and the kernel is
    summed over nodes; (gi, x, density).

    The rows are read once and leave as one row per node and task.  Against the
    exact sum a density is off by at most ``1 / (8 * per_bandwidth**2)`` of the
    kernel's peak ``1 / (h * sqrt(2 * pi))``: linear interpolation of a function
    whose second derivative is at most 1 / h**2.
    """
    v = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    stats = vals.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("_sd"))
    h = (F.pow(F.col("n"), -0.2) * F.col("_sd")) if bandwidth is None else F.lit(float(bandwidth))
    stats = stats.select("n", h.alias("h"))
    lo, hi = float(min(grid)), float(max(grid))
    near = _with_scalars(vals, stats).where((F.col("v") > lo - FAR * F.col("h")) & (F.col("v") < hi + FAR * F.col("h")))
    step = F.col("h") / per_bandwidth
    bins = near.select("n", "h", F.explode(_pieces(F.col("v"), lo, step)).alias("_b")).groupBy("n", "h", "_b.i").agg(F.sum("_b.w").alias("w"))
    at = F.lit(lo) + F.col("i") * step
    points = F.array(*[F.struct(F.lit(i).alias("gi"), F.lit(float(x)).alias("x"), F.sum(F.col("w") * _kernel(at, x, F.col("h"))).alias("s"))
                       for i, x in enumerate(grid)])
    one = bins.agg(points.alias("_p"), F.max("n").alias("n"), F.max("h").alias("h"))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (one.where(F.col("n") > 0).select("n", "h", F.explode("_p").alias("_p"))
            .select(F.col("_p.gi").cast("int").alias("gi"), "_p.x", (F.col("_p.s") / norm).alias("density")))


def kde2_binned(df: DataFrame, x: str, y: str, grid_x: Sequence[float], grid_y: Sequence[float],
                bandwidth: tuple[float, float] | None = None, per_bandwidth: int = 8) -> DataFrame:
    """A8 (2-D) by linear binning: each point is shared out to the four nodes
    around it, and the nodes are smoothed along x, then along y (the kernel is a
    product); (gx, gy, x, y, density).  One pass over the rows, then work by
    nodes: the cost does not grow with rows x grid.  Off by at most
    ``1 / (4 * per_bandwidth**2)`` of the kernel's peak ``1 / (2 * pi * hx * hy)``.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    vals = df.select(number(x).alias("vx"), number(y).alias("vy")).filter("vx is not null and vy is not null")
    stats = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("vx").alias("_sx"), F.stddev_samp("vy").alias("_sy"))
    f = F.pow(F.col("n"), -1.0 / 6)
    hx, hy = (f * F.col("_sx"), f * F.col("_sy")) if bandwidth is None else (F.lit(float(b)) for b in bandwidth)
    d = _with_scalars(vals, stats.select("n", hx.alias("hx"), hy.alias("hy")))
    lo = [float(min(g)) for g in (grid_x, grid_y)]
    for v, h, g in (("vx", "hx", grid_x), ("vy", "hy", grid_y)):
        d = d.where((F.col(v) > min(g) - FAR * F.col(h)) & (F.col(v) < max(g) + FAR * F.col(h)))
    sx, sy = F.col("hx") / per_bandwidth, F.col("hy") / per_bandwidth
    four = F.flatten(F.transform(_pieces(F.col("vx"), lo[0], sx), lambda a: F.transform(
        _pieces(F.col("vy"), lo[1], sy), lambda b: F.struct(a["i"].alias("i"), b["i"].alias("j"), (a["w"] * b["w"]).alias("w")))))
    keep = ["n", "hx", "hy"]
    nodes = d.select(*keep, F.explode(four).alias("_b")).groupBy(*keep, "_b.i", "_b.j").agg(F.sum("_b.w").alias("w"))
    at_x, at_y = F.lit(lo[0]) + F.col("i") * sx, F.lit(lo[1]) + F.col("j") * sy
    along_x = nodes.groupBy(*keep, "j").agg(F.array(*[
        F.struct(F.lit(g).alias("gx"), F.lit(float(u)).alias("x"), F.sum(F.col("w") * _kernel(at_x, u, F.col("hx"))).alias("s"))
        for g, u in enumerate(grid_x)]).alias("_l")).select(*keep, "j", F.explode("_l").alias("_l"))
    points = F.array(*[F.struct(F.lit(g).alias("gy"), F.lit(float(v)).alias("y"), F.sum(F.col("_l.s") * _kernel(at_y, v, F.col("hy"))).alias("s"))
                       for g, v in enumerate(grid_y)])
    out = along_x.groupBy(*keep, "_l.gx", "_l.x").agg(points.alias("_p")).select(*keep, "gx", "x", F.explode("_p").alias("_p"))
    norm = F.col("n") * F.col("hx") * F.col("hy") * F.lit(2 * math.pi)
    return out.select(F.col("gx").cast("int").alias("gx"), F.col("_p.gy").cast("int").alias("gy"), "x", "_p.y", (F.col("_p.s") / norm).alias("density"))
