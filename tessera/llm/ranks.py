"""Ranks within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def salted(df: DataFrame) -> DataFrame:
    """Adds ``salt``, different for equal rows too.  Write the result before
    use: the salt belongs to the written row."""
    return df.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))


def numbered_copies(df: DataFrame, per_task: int = 50_000) -> DataFrame:
    """``df``, written, with a ``salt`` that depends on a row's values and on
    its number among equal rows alone: neither files nor partitions decide, and
    equal rows of any number lie apart.  Equal rows are counted map-side;
    many copies of one row are dealt to tasks in blocks of ``per_task``."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    rows = written(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")), "distinct")
    few = rows.where(F.col("_c") <= per_task).withColumn("_from", F.lit(0).cast("bigint")).withColumn("_to", F.col("_c") - 1)
    many = (rows.where(F.col("_c") > per_task)
            .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_c") - 1, F.lit(per_task).cast("bigint"))))
            .withColumn("_to", F.least(F.col("_from") + per_task, F.col("_c")) - 1).repartition(*cols, "_from"))
    every = few.unionByName(many).withColumn("_copy", F.explode(F.sequence("_from", "_to")))
    return written(every.select(*cols, F.xxhash64(*cols, "_copy").alias("salt")), "copies")


def rank_in_group(df: DataFrame, group: str, per_cell: int = 50_000) -> DataFrame:
    """Adds ``rank``, gapless from 0 within each value of ``group``.

    ``df`` is a written frame with a ``salt``.  A group is cut into cells of
    about ``per_cell`` rows by the salt; ranks are the cell's offset in its
    group plus the row's number in its cell, so no task holds more than cells.
    """
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / per_cell).alias("_n"))
    # callers' groups are few by construction (lengths up to a limit, arcs of a ring)
    d = df.join(F.broadcast(sizes), group).withColumn("_cell", F.pmod(F.col("salt"), F.col("_n")))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (d.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_c"))
             .select(group, "_cell", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy(group, "_cell").orderBy("salt")
    return (d.withColumn("_row", F.row_number().over(within)).join(cells, [group, "_cell"])
            .withColumn("rank", F.col("_offset") + F.col("_row") - 1).drop("_n", "_cell", "_row", "_offset"))
