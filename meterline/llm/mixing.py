"""Mixing sources to target weights by budgets that flow down a tree.

The tree's levels are columns of the documents, from the widest down; its leaves are the sources. The budget
of the root, in words, is divided among its children by their weights, theirs among their children, and so
on. No node gets more than its leaves
can give in ``epochs`` passes; leaves with weight 0, or below a node of weight 0, give nothing. What a node cannot take goes to
its siblings by their weights, as far as they can take it; since a node's limit is the sum of its
children's, shortages reach the siblings of an ancestor only when all siblings below are full.

A leaf with budget A and supply S is read A // S times as a whole, and of the next epoch a prefix is
taken: documents in the order of a hash of seed, epoch and id, as long as the words before them are fewer
than what is left of A. A leaf thus exceeds its budget by less than one document.

Only DataFrame functions are used. The order is cut into 2**16 ranges of the hash; their sums by leaf
decide all ranges but the one in which the budget ends, and only that one is sorted. So a leaf with a
third of all documents needs no large window. Node tables are as long as the list of sources.

Defined cases: rows that repeat an id in a leaf are chosen together, as are rows without id of equal text;
null level values are a node of their own; null and empty texts count no words and come with
their place in the order. Nodes without a weight have weight 1; with weight 0, no budget. Other columns pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.storage import stored

SEED, EPOCHS = 17, 2
_BITS, _RANGE_BITS = 60, 16
NULL_NODE = "(null)"


def _level(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_NODE))


def _hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


def _unit() -> Column:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(text)))


def _weight(path: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():  # as many as the caller wrote down
        out = F.when(path == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def divided(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Adds ``budget`` to nodes with cap and weight: the parent's ``amount`` by weight, none above its cap.

    There is one level of budget per unit of weight at which the parts add up; nodes that it would lift above
    their caps are full. In the order of cap per weight the full ones come first.
    """
    ratio = F.col("cap") / F.col("weight")
    order = Window.partitionBy(*parent).orderBy(ratio, "path")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.where("weight > 0").withColumn("level", (F.col("amount") - before) / from_here)
    fits = F.max(F.when(F.col("level") <= ratio, F.col("level"))).over(Window.partitionBy(*parent))
    nodes = nodes.withColumn("level", fits)
    part = F.floor(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).cast("long")
    return nodes.withColumn("budget", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.greatest(part, F.lit(0)))).drop("level")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, int], percent: int, epochs: int) -> DataFrame:
    """Leaves (level columns, supply) with their budgets; the root's is ``percent`` of all words."""
    # What stands below a node of weight 0 gives nothing, so no node above counts on it.
    closed = F.lit(False)
    for depth in range(1, len(levels) + 1):
        closed = closed | (_weight(F.concat_ws("/", *levels[:depth]), weights) == 0)
    leaves = leaves.withColumn("cap", F.when(closed, F.lit(0)).otherwise(F.col("supply") * F.lit(epochs)).cast("long"))
    top = leaves.agg(F.floor(F.sum("supply") * F.lit(percent) / F.lit(100)).cast("long").alias("amount"))
    parents = top.withColumn("root", F.lit(0))
    for depth in range(1, len(levels) + 1):
        own, above = list(levels[:depth]), list(levels[: depth - 1]) or ["root"]
        nodes = leaves.withColumn("root", F.lit(0)).groupBy("root", *own).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
        path = F.concat_ws("/", *own)
        nodes = nodes.withColumn("path", path).withColumn("weight", _weight(path, weights)).join(parents, above)
        parents = divided(nodes, above).select(*own, F.col("budget").alias("amount"), "supply")
        if depth < len(levels):
            parents = parents.drop("supply")
    return parents.withColumnRenamed("amount", "budget")


def chosen(
    docs: DataFrame, levels: Sequence[str], weights: Mapping[str, int], percent: int, epochs: int = EPOCHS, seed: int = SEED
) -> DataFrame:
    """unit (id as text, or a hash for rows without), level columns, epoch: one row for each copy to take."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    names = [f"level{i}" for i in range(len(levels))]
    units = docs.select(*(_level(c).alias(n) for c, n in zip(levels, names)), _unit().alias("unit"), words.alias("words"))
    units = stored(units.groupBy(*names, "unit").agg(F.sum("words").cast("long").alias("words")), "units")
    leaves = stored(
        budgets(units.groupBy(*names).agg(F.sum("words").alias("supply")), names, weights, percent, epochs)
        # A leaf without words has nothing to be counted by: it is taken once.
        .withColumn("whole", F.when(F.col("supply") > 0, F.expr("budget div supply")).otherwise(1))
        .withColumn("rest", F.when(F.col("supply") > 0, F.expr("budget % supply")).otherwise(0)),
        "leaves",
    )
    placed = units.join(leaves.select(*names, "whole", "rest"), names)
    all_of_it = placed.where("whole > 0").select(*names, "unit", F.explode(F.sequence(F.lit(1).cast("long"), "whole")).alias("epoch"))
    open_ = placed.where("rest > 0").withColumn("epoch", F.col("whole") + 1)
    order = _hash60(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), "unit"))
    open_ = open_.withColumn("order", order).withColumn("span", F.shiftright("order", _BITS - _RANGE_BITS))
    spans = open_.groupBy(*names, "span", "rest").agg(F.sum("words").alias("words"))
    before = F.sum("words").over(Window.partitionBy(*names).orderBy("span"))
    spans = spans.withColumn("before", before - F.col("words")).where("before < rest")
    inside = open_.drop("rest").join(spans.select(*names, "span", "rest", "before", F.col("words").alias("in_span")), [*names, "span"])
    sure = inside.where("before + in_span <= rest").select(*names, "unit", "epoch")
    last = inside.where("before + in_span > rest")
    ahead = F.sum("words").over(
        Window.partitionBy(*names).orderBy("order", "unit").rowsBetween(Window.unboundedPreceding, -1)
    )
    last = last.withColumn("ahead", F.col("before") + F.coalesce(ahead, F.lit(0))).where("ahead < rest")
    return all_of_it.unionByName(sure).unionByName(last.select(*names, "unit", "epoch")).select("unit", *names, "epoch")


def mixed(
    docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, int], percent: int, epochs: int = EPOCHS, seed: int = SEED
) -> DataFrame:
    """row (all columns as they came) and epoch, for each copy of a document that is taken."""
    names = [f"level{i}" for i in range(len(levels))]
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *(c.alias(n) for c, n in zip(levels.values(), names)),
    )
    copies = chosen(rows.drop("row"), names, weights, percent, epochs, seed)
    rows = rows.select("row", _unit().alias("unit"), *(_level(n).alias(n) for n in names))
    return rows.join(copies, ["unit", *names]).select("row", "epoch")
