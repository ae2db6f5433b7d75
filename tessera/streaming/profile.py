"""Streaming window profile.

Event-time tumbling windows with a watermark: rows later than ``delay``
behind the largest event time seen are dropped and a window's state is
evicted once the watermark passes its end.  The aggregate is D1 (count, nulls,
min, max, mean, std); with ``sketches`` also distinct counts and quartiles, as
sketches in the streaming state: the relative standard error of a distinct
count is 1 %, the rank error of a quartile 1e-4.  Exact ones need all values of
a window and stay in the batch profile.

What the watermark drops is not lost unseen: :func:`late_rows` counts the late
rows of every micro-batch.

Output runs in update mode through ``foreachBatch``: every micro-batch writes
its updated rows under ``batch=<id>`` (overwritten if the batch is replayed,
so a restart is idempotent), and :func:`latest_by_key` keeps the last
version of each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.drift import _micros
from ..operators.stats import NUMERIC


def _start_offset(width: str, origin: str) -> str:
    w = _micros(width) // 1_000_000
    epoch = int((dt.datetime.fromisoformat(origin) - dt.datetime(1970, 1, 1)).total_seconds())
    return f"{epoch % w} seconds"


def stream_profile(sdf: DataFrame, ts: str, width: str, origin: str, columns: Sequence[str],
                   delay: str = "1 day", sketches: bool = False) -> DataFrame:
    """Streaming (window, column) profile of ``columns``; with ``sketches`` also
    distinct, p25, p50 and p75 (quartiles are NULL for non-numeric columns)."""
    num = [c for c in columns if isinstance(sdf.schema[c].dataType, NUMERIC)]
    cat = [c for c in columns if c not in num]
    # Watermarks need TIMESTAMP; with the session zone pinned to UTC the cast
    # keeps the wall-clock value of a TIMESTAMP_NTZ column.
    et = "_event_time"
    sdf = sdf.withColumn(et, F.col(ts).cast("timestamp"))
    w = F.window(F.col(et), width, startTime=_start_offset(width, origin))
    # Categorical columns have no numeric stats: theirs are NULL.
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in num}
    vals = [F.struct(F.lit(c).alias("column"), number[c].alias("value"), number[c].isNull().alias("isnull"),
                     F.xxhash64(number[c]).alias("key")) for c in num]
    vals += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("value"), F.col(c).isNull().alias("isnull"),
                      F.xxhash64(F.col(c).cast("string")).alias("key")) for c in cat]
    long = (sdf.withWatermark(et, delay)
            .select(w.alias("w"), F.explode(F.array(*vals)).alias("_v"))
            .select("w", "_v.column", "_v.value", "_v.isnull", "_v.key"))
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if("isnull").alias("nulls"),
            F.min("value").alias("min"), F.max("value").alias("max"),
            F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")]
    if not sketches:
        return long.groupBy("w", "column").agg(*aggs)
    out = long.groupBy("w", "column").agg(
        *aggs, F.approx_count_distinct(F.when(~F.col("isnull"), F.col("key")), 0.01).alias("distinct"),
        F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).alias("_q"))
    return out.select("*", *[F.col("_q")[i].alias(q) for i, q in enumerate(("p25", "p50", "p75"))]).drop("_q")


def late_rows(spark: SparkSession, sdf: DataFrame, ts: str, width: str, origin: str, out_path: str, checkpoint: str,
              delay: str = "1 day") -> DataFrame:
    """Runs the stream and counts, per micro-batch, its rows and those that a
    watermarked window aggregate over it drops: (batch, n, late, max_event).

    A row is late if the end of its window is not behind the watermark that the
    batch before ran with: the largest event time up to two batches ago, less
    ``delay``.  (A query that idles between batches moves its watermark on by
    empty ones; the counts hold for batches that follow each other, as here.)
    Every batch writes one row under ``batch=<id>`` and reads those of earlier
    batches, so a replayed batch counts the same.
    """
    et = F.col(ts).cast("timestamp")
    end = F.window(et, width, startTime=_start_offset(width, origin))["end"]

    def sink(batch: DataFrame, batch_id: int) -> None:
        seen = None
        if batch_id > 1:
            before = spark.read.parquet(out_path).where(F.col("batch") < batch_id - 1)  # a row per batch
            seen = before.agg(F.max("max_event")).first()[0]
        # a watermark in milliseconds, as the engine keeps it
        mark = F.lit(None).cast("bigint") if seen is None else F.lit(seen // 1000 - _micros(delay) // 1000)
        late = F.unix_micros(end) <= mark * 1000
        one = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"), F.max(F.unix_micros(et)).alias("max_event"))
        one.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    q = (sdf.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def run_available_now(agg: DataFrame, out_path: str, checkpoint: str,
                      output_mode: str = "update", transform: Callable[[DataFrame], DataFrame] | None = None
                      ) -> None:
    """Process everything available, writing each micro-batch under
    ``out_path/batch=<id>``, and wait for the end."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        b.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    q = (agg.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def latest_by_key(spark: SparkSession, out_path: str, keys: Sequence[str]) -> DataFrame:
    """Upsert view of an update-mode output: the row of the last batch per key."""
    df = spark.read.parquet(out_path)
    w = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn", "batch"))
