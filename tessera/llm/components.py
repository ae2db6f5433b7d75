"""Union-find as joins: connected components by contraction.

Each round hangs every vertex on the least vertex among itself and its
neighbours, follows these pointers to their ends by doubling, and replaces the
links by links between the ends.  Only vertices less than all their neighbours
remain.  When no link is left, the rounds' steps are followed from first to
last.  A round is an aggregation with map-side combine and a few joins; a
vertex with a third of all links leaves one aggregated row per task, and its
links are split by the engine's skewed-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (v, root): every vertex that has a link, with the
    smallest vertex of its component.  No edges give an empty result."""
    edges = written(edges.where("a <> b").select("a", "b"), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")),
                                              F.struct(F.col("b").alias("v"), F.col("a").alias("w")))).alias("e")).select("e.*")
        step = written(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("up")), "step")
        while True:  # until every pointer leads to an end
            up = step.select(F.col("v").alias("up"), F.col("up").alias("top"))
            far = written(step.join(up, "up").select("v", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved")), "step")
            step = far.select("v", "up")
            if far.where("moved").isEmpty():
                break
        steps.append(step)
        a = step.select(F.col("v").alias("a"), F.col("up").alias("ua"))
        b = step.select(F.col("v").alias("b"), F.col("up").alias("ub"))
        edges = written(edges.join(a, "a").join(b, "b").where("ua <> ub").select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    out = steps[0].withColumnRenamed("up", "root")
    for step in steps[1:]:
        out = out.join(step.withColumnsRenamed({"v": "root", "up": "_up"}), "root", "left").select("v", F.coalesce("_up", "root").alias("root"))
    return written(out, "components")
