"""JSON key-list requests, e.g. ``{"inputs": [{"user_id": "..."}, ...]}``.

Parsing is ``from_json`` + ``posexplode``: one output row per input key, in
input order, duplicates kept.  A text that does not parse, has no ``inputs``
array or an empty one goes to the error output instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def request_schema(key: str = "user_id") -> T.StructType:
    return T.StructType([T.StructField("inputs", T.ArrayType(
        T.StructType([T.StructField(key, T.StringType())])))])


def _parsed(df: DataFrame, value_col: str, key: str) -> DataFrame:
    return df.withColumn("_req", F.from_json(F.col(value_col), request_schema(key),
                                             {"mode": "PERMISSIVE"}))


def read_requests(df: DataFrame, value_col: str = "body", key: str = "user_id",
                  id_col: str = "request_id") -> DataFrame:
    """Rows (id_col, pos, key) for every key of every well-formed request."""
    p = _parsed(df, value_col, key).filter(F.col("_req.inputs").isNotNull())
    return p.select(id_col, F.posexplode("_req.inputs").alias("pos", "_item")) \
            .select(id_col, F.col("pos").cast("int").alias("pos"), F.col(f"_item.{key}").alias(key))


def request_errors(df: DataFrame, value_col: str = "body", key: str = "user_id") -> DataFrame:
    """The input rows whose text is malformed or names no key."""
    p = _parsed(df, value_col, key)
    return p.filter(F.col("_req.inputs").isNull() | (F.size("_req.inputs") == 0)).drop("_req")
