"""Mixing sources to target weights by hierarchical budgets.

The tree is domain - language - source.  A budget of tokens is handed down by
weight.  A node can take at most its supply times ``max_epochs``; what it cannot
take goes to its siblings by their weights, and only what all siblings cannot
take leaves their parent: a parent's capacity is the sum of its children's, so
its own budget is cut one level up, among its siblings.

Each level is one closed form over sorted children: with capacities c and
weights w in order of c / w, a child is full if c * (weights from it on) is at
most w * (budget less the capacities before it).  All numbers are integers, so
both engines and repeated tasks agree.

A source's documents are read in epochs, each in an order seeded by the epoch's
number.  Whole epochs come first, then a prefix of the next: documents as long
as half of each still fits the budget.  The prefix's end is found from token
sums of cells of the order and the documents of one cell; the documents
themselves are then filtered where they are, by one number per source.

A token here is a word, plus one end per document.

Edge cases: null or empty text is one token; null language or source is a leaf
of its own; a null doc_id is ordered by its text, and rows equal in it are
taken together; a repeated row counts as often as it is there; weights not given are 1; weight 0 gets nothing; an empty table
gives an empty result; columns named like those used here are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, written

LEVELS = ["domain", "lang", "source"]
UNITS = 1 << 52


def domain_of(source: Column, domains: int = 3) -> Column:
    """Default domains: sources dealt by checksum."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.coalesce(source, F.lit("")).cast("binary")), F.lit(domains)).cast("string"))


def n_tokens(text: Column) -> Column:
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(t == "", F.lit(1)).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+")) + 1).cast("bigint")


def place(seed: int, epoch: Column, doc_id: Column, text: Column) -> Column:
    """The document's place in an epoch's order: 52 bits of an md5."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    word = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key)
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, 13), 16, 10).cast("bigint")


def share_out(nodes: DataFrame, parents: list[str], weights: Column) -> DataFrame:
    """``nodes`` with _budget (of the parent) and _cap to _alloc."""
    d = nodes.withColumn("_w", weights.cast("bigint")).withColumn("_by", F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w")))
    w = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    w = w.orderBy(F.col("_by").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in LEVELS if c in nodes.columns])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    usable = F.when(F.col("_w") > 0, F.col("_cap")).otherwise(0)
    d = d.withColumns({"_c": F.coalesce(F.sum(usable).over(before), F.lit(0)),
                       "_rest": F.sum("_w").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    full = F.col("_cap") * F.col("_rest") <= F.col("_w") * (F.col("_budget") - F.col("_c"))
    # of the full ones only: those after the first that is not full share what is left
    d = d.withColumn("_full", (F.col("_w") > 0) & full)
    all_rows = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns({"_fc": F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(all_rows), F.lit(0)),
                       "_fw": F.coalesce(F.sum(F.when(~F.col("_full"), F.col("_w"))).over(all_rows), F.lit(0))})
    alloc = F.when(F.col("_w") <= 0, F.lit(0)).when(F.col("_full"), F.col("_cap")).otherwise(
        F.expr("_w * (_budget - _fc) div _fw"))
    d = d.withColumns({"_alloc": alloc.cast("bigint"), "_open": ((F.col("_w") > 0) & ~F.col("_full")).cast("int")})
    # what the whole shares leave goes to the first that are not full, a token each: they have room for it
    d = d.withColumns({"_left": F.col("_budget") - F.sum("_alloc").over(all_rows),
                       "_nth": F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    more = (F.col("_open") == 1) & (F.col("_nth") <= F.col("_left"))
    return d.withColumn("_alloc", F.col("_alloc") + more.cast("int")).drop(
        "_w", "_by", "_c", "_rest", "_full", "_fc", "_fw", "_open", "_left", "_nth")


def weight_of(column: str, weights: dict[str, int] | None) -> Column:
    if not weights:
        return F.lit(1)
    expr = F.lit(1)
    for name, w in weights.items():
        expr = F.when(F.col(column) == name, w).otherwise(expr)
    return expr


def budgets(leaves: DataFrame, percent: int, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """``leaves`` (domain, lang, source, _supply) with _alloc, their budget:
    ``percent`` of all tokens are handed down."""
    leaves = leaves.withColumn("_cap", F.col("_supply") * max_epochs)
    # a node can place what its children with a weight can
    usable = lambda level: F.sum(F.when(weight_of(level, weights.get(level)) > 0, F.col("_cap")).otherwise(0))
    langs = leaves.groupBy("domain", "lang").agg(usable("source").alias("_cap"), F.sum("_supply").alias("_supply"))
    tops = langs.groupBy("domain").agg(usable("lang").alias("_cap"), F.sum("_supply").alias("_supply"))
    langs = langs.drop("_supply")
    tops = tops.withColumn("_budget", F.floor(F.sum("_supply").over(Window.partitionBy(F.lit(1))) * percent / 100).cast("bigint"))
    tops = share_out(tops.drop("_supply"), [], weight_of("domain", weights.get("domain")))
    langs = share_out(langs.join(tops.select(F.col("domain").alias("_p"), F.col("_alloc").alias("_budget")),
                                 F.col("domain") == F.col("_p")).drop("_p"), ["domain"], weight_of("lang", weights.get("lang")))
    up = langs.select(F.col("domain").alias("_p"), F.col("lang").alias("_q"), F.col("_alloc").alias("_budget"))
    leaves = leaves.join(up, (F.col("domain") == F.col("_p")) & F.col("lang").eqNullSafe(F.col("_q"))).drop("_p", "_q")
    return share_out(leaves, ["domain", "lang"], weight_of("source", weights.get("source")))


def mixed(docs: DataFrame, percent: int = 80, max_epochs: int = 2, weights: dict[str, dict[str, int]] | None = None,
          seed: int = 7, domain: Column | None = None, per_cell: int = 20_000) -> DataFrame:
    """(row, domain, lang, source, n_tokens, epoch): the documents taken, one
    row per epoch; ``row`` is the document itself."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    (domain_of(F.col("source")) if domain is None else domain).alias("domain"), F.col("lang").cast("string").alias("lang"),
                    F.col("source").cast("string").alias("source"), n_tokens(F.col("text")).alias("n_tokens"))
    # a read of the texts each: sums by leaf, then places of the epochs that are cut
    leaves = written(d.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("_supply"), F.count(F.lit(1)).alias("_docs")), "leaves")
    plan = budgets(leaves, percent, max_epochs, weights or {})
    plan = plan.withColumns({"_epochs": F.expr("_alloc div _supply"), "_left": F.expr("_alloc % _supply"),
                             "_cells": F.ceil(F.col("_docs") / per_cell)}).select(*LEVELS, "_epochs", "_left", "_cells")
    plan = written(plan, "plan")

    def to_plan(x: DataFrame, p: DataFrame) -> DataFrame:
        p = p.withColumnsRenamed({c: f"_{c}" for c in LEVELS})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
        return x.join(p, same[0] & same[1] & same[2]).drop(*[f"_{c}" for c in LEVELS])
    d = to_plan(d, plan).withColumn("_u", place(seed, F.col("_epochs"), F.col("row.doc_id"), F.col("row.text")))
    narrow = written(d.where("_left > 0").select(*LEVELS, "n_tokens", "_left", "_u", F.floor(
        F.col("_u") / F.lit(float(UNITS)) * F.col("_cells")).alias("_cell")), "places")
    by_leaf = Window.partitionBy(*LEVELS)
    cells = narrow.groupBy(*LEVELS, "_left", "_cell").agg(F.sum("n_tokens").alias("_sum"))
    start = F.coalesce(F.sum("_sum").over(by_leaf.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the cell in which the prefix ends: the last that begins within the budget
    edge = (cells.withColumn("_start", start).where("_start < _left").groupBy(*LEVELS)
            .agg(F.max_by(F.struct("_cell", "_start"), "_cell").alias("_e")))
    edge = written(edge.select(*LEVELS, F.col("_e._cell").alias("_edge"), F.col("_e._start").alias("_start")), "edges")
    last = to_plan(narrow, edge).where("_cell = _edge")
    # equal places are equal rows: taken or left together
    sofar = F.sum("n_tokens").over(by_leaf.orderBy("_u").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    mine = F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "_u"))
    cut = (last.withColumns({"_sofar": sofar, "_mine": mine}).groupBy(*LEVELS, "_edge")
           .agg(F.max(F.when(2 * (F.col("_start") + F.col("_sofar")) - F.col("_mine") <= 2 * F.col("_left"), F.col("_u"))).alias("_cut")))
    # without a document of the cell: all before it
    cut = written(cut.select(*LEVELS, "_edge", "_cut"), "cuts")
    p = cut.withColumnsRenamed({c: f"_{c}" for c in LEVELS})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    d = d.join(p, same[0] & same[1] & same[2], "left")
    cell = F.floor(F.col("_u") / F.lit(float(UNITS)) * F.col("_cells"))
    more = F.coalesce((cell < F.col("_edge")) | ((cell == F.col("_edge")) & (F.col("_u") <= F.col("_cut"))), F.lit(False))
    d = d.withColumn("_copies", F.col("_epochs") + more.cast("int")).where("_copies > 0")
    return d.select("row", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)).alias("epoch"))


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents taken, a row for each epoch, with the columns of ``docs``."""
    return mixed(docs, **kw).select("row.*")
