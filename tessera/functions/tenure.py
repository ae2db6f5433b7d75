"""The tenure feature function.

``tenure = floor((as_of - created) / 24 h)`` in whole days, NULL -> -1, INT.
It floors, so a creation date up to a day in the future gives -1; the
built-in day differences truncate instead and are not used.  The body is a
Catalyst expression, so it folds constants and stays inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _ts(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")  # P10: '2024-11-01' is accepted as a timestamp


def tenure_days(created: str | Column, as_of=None) -> Column:
    """Whole days from ``created`` (a column name or Column) to ``as_of``
    (a Column, or a literal timestamp/string; default: the query's current
    local time, one value per query), floored; NULL becomes -1."""
    if as_of is None:
        as_of_c = F.localtimestamp()
    else:
        as_of_c = _ts(as_of if isinstance(as_of, Column) else F.lit(as_of))
    diff = F.timestamp_diff("MICROSECOND", _ts(created), as_of_c)
    floored = F.floor(diff / F.lit(DAY_MICROS).cast("double"))
    return F.coalesce(floored.cast("int"), F.lit(-1))


def tenure_sql(created_sql: str, as_of_sql: str) -> str:
    """DuckDB form of the same expression."""
    return (f"coalesce(CAST(floor(date_diff('microsecond', CAST({created_sql} AS TIMESTAMP), "
            f"CAST({as_of_sql} AS TIMESTAMP)) / {DAY_MICROS}.0) AS INTEGER), -1)")


def register_functions(spark: SparkSession) -> None:
    """make ``user_tenure(creation_date_in [, as_of])`` callable from SQL."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION user_tenure("
        "creation_date_in TIMESTAMP_NTZ, as_of TIMESTAMP_NTZ DEFAULT localtimestamp()) "
        "RETURNS INT "
        "COMMENT '[Feature Function] user tenure in days from the creation date' "
        f"RETURN coalesce(CAST(floor(timestampdiff(MICROSECOND, creation_date_in, as_of) "
        f"/ {DAY_MICROS}D) AS INT), -1)")
