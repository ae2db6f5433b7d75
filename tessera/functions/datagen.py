"""Generated data (G1-G6): the drifting hourly table, built in executors.

All randomness is seeded and keyed on the row's position, so a recomputed
partition regenerates the same rows.  ``scale`` multiplies the number of
series (each series is one copy of the three periods), which is how the
generator grows; rows are produced by ``range`` + ``explode(sequence)``, never
on the driver.

Fixed values of the monitored table (they define its drift):
- three periods of three days from 2024-11-01, hourly, last point excluded
  (72 rows each);
- period 1: location from NY, LA, SF; temperature from 70..79;
- period 2: location from NY, LA, NULL; temperature from 70..79, NULL with
  probability 0.2;
- period 3: location from NY, LA, SF, Chicago; temperature from 70..79 for the
  first 36 rows and 40..49 for the last 36.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash


def hourly(spark: SparkSession, start: str, end: str, series: int = 1) -> DataFrame:
    """G1: hourly timestamps in [start, end) (the end point is excluded), with
    their 0-based position, for each of ``series`` series."""
    seq = F.sequence(F.lit(start).cast("timestamp_ntz"),
                     F.lit(end).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR"),
                     F.expr("INTERVAL 1 HOUR"))
    return (spark.range(series).withColumnRenamed("id", "series")
            .select("series", F.posexplode(seq).alias("pos", "date")))


def uniform(key: Sequence[str | Column], seed: int) -> Column:
    """A uniform number in [0, 1) from the row key and a seed."""
    return unit_hash([F.lit(seed).cast("string"), *key], seed)


def choice(values: Sequence, key: Sequence[str | Column], seed: int) -> Column:
    """Uniform choice with replacement; ``None`` may be one of the values."""
    arr = F.array(*[F.lit(v) for v in values])
    idx = (F.floor(uniform(key, seed) * len(values)) + 1).cast("int")
    return F.element_at(arr, idx)


def randint(lo: int, hi: int, key: Sequence[str | Column], seed: int) -> Column:
    """Integer in [lo, hi)."""
    return (F.lit(lo) + F.floor(uniform(key, seed) * (hi - lo))).cast("int")


def with_nulls(col: Column, p: float, key: Sequence[str | Column], seed: int) -> Column:
    """Keep the value where a uniform draw exceeds ``p``, else NULL."""
    return F.when(uniform(key, seed) > F.lit(p), col)


def regime(pos: Column, k: int, first: Column, second: Column) -> Column:
    """``first`` for positions below ``k``, ``second`` from there on."""
    return F.when(pos < k, first).otherwise(second)


PERIODS = [("2024-11-01", "2024-11-04"), ("2024-11-04", "2024-11-07"), ("2024-11-07", "2024-11-10")]


def drift_table(spark: SparkSession, seed: int = 42, scale: int = 1) -> DataFrame:
    """The drifting table: 216 rows per series (3 x 72, hourly)."""
    frames = []
    for i, (start, end) in enumerate(PERIODS, start=1):
        h = hourly(spark, start, end, scale)
        key = [F.col("series").cast("string"), F.col("pos").cast("string"), F.lit(str(i))]
        if i == 1:
            loc = choice(["NY", "LA", "SF"], key, seed)
            temp = randint(70, 80, key, seed + 1)
        elif i == 2:
            loc = choice(["NY", "LA", None], key, seed)
            temp = with_nulls(randint(70, 80, key, seed + 1), 0.2, key, seed + 2)
        else:
            loc = choice(["NY", "LA", "SF", "Chicago"], key, seed)
            temp = regime(F.col("pos"), 36, randint(70, 80, key, seed + 1),
                          randint(40, 50, key, seed + 1))
        frames.append(h.select("series", "date", loc.cast("string").alias("location"),
                               temp.cast("double").alias("temperature")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)  # O3
    return out
