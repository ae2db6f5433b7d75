"""Streaming scoring of JSON key-list requests.

Requests arrive as text rows; each micro-batch is parsed (S12), left-joined
to the static feature table (stream-static join: the stream side is not
shuffled against state, there is no state) and scored.  Stateless, so the
output can be written in append mode.

:func:`run_requests` also takes every request once, though clients and queues
send some again, and keeps those that do not parse: each micro-batch has two
outputs, scores and errors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.requests import read_requests, request_errors


def stream_score(requests: DataFrame, features: DataFrame, key: str,
                 score: Callable[[DataFrame], DataFrame], value_col: str = "body",
                 id_col: str = "request_id") -> DataFrame:
    """requests (streaming, with ``id_col`` and ``value_col``) -> one scored
    row per input key, unknown keys included with NULL features."""
    parsed = read_requests(requests, value_col, key, id_col)
    return score(parsed.join(features, key, "left"))


def run_requests(requests: DataFrame, features: DataFrame, key: str, score: Callable[[DataFrame], DataFrame],
                 out_path: str, checkpoint: str, ts: str = "sent_at", delay: str = "1 day",
                 value_col: str = "body", id_col: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """Runs the stream of requests to its end: (scores, errors), each with the
    ``batch`` that wrote it.

    A request that comes again within ``delay`` of its ``ts`` is dropped: the
    state holds the ids of that span, not all ids ever seen.  Both outputs of a
    micro-batch go to ``batch=<id>`` folders, overwritten if the batch is
    replayed, so a restart writes no request twice.  Scores have one row per key
    of a well-formed request; errors are the requests that are malformed or name
    no key, as they came.
    """
    spark: SparkSession = requests.sparkSession
    once = requests.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by both outputs
        stream_score(batch, features, key, score, value_col, id_col).write.mode("overwrite").parquet(f"{out_path}/scores/batch={batch_id}")
        request_errors(batch, value_col, key).write.mode("overwrite").parquet(f"{out_path}/errors/batch={batch_id}")
        batch.unpersist()

    q = once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{out_path}/scores"), spark.read.parquet(f"{out_path}/errors")
