"""Connected components of a large graph by min-label propagation with pointer jumping; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import few_tasks, scratch


def components(edges: DataFrame) -> DataFrame:
    """Row for each node of ``edges`` (columns x, y): node, label (the smallest node it reaches). No edges: no rows.

    Each round takes the smallest label among a node's neighbours (summed up before the shuffle, so a node with very many
    neighbours is no hot key) and then the label of that label. The rounds end when no label changes; on a path of n nodes
    their number grows with log n. Repeated edges do no harm but are read in every round.
    """
    ways = F.array(F.struct(F.col("x").alias("u"), F.col("y").alias("v")), F.struct(F.col("y").alias("u"), F.col("x").alias("v")))
    both = scratch(edges.where("x <> y").select(F.explode(ways).alias("e")).select("e.u", "e.v"), "edges")
    tasks = few_tasks(both)
    labels = scratch(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node").coalesce(tasks), "labels")
    if labels.isEmpty():
        return labels
    while True:
        near = both.join(labels.withColumnRenamed("node", "u"), "u").groupBy("v").agg(F.min("label").alias("near")).withColumnRenamed("v", "node")
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        root = labels.select(F.col("node").alias("next"), F.col("label").alias("root"))
        step = scratch(step.join(root, "next").select("node", F.least("next", "root").alias("label"), (F.least("next", "root") < F.col("label")).alias("moved")).coalesce(tasks), "labels")
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels


def joined(found: DataFrame, tops: DataFrame) -> DataFrame:
    """Components ``found`` of a graph with more edges, between labels (or nodes that had no edge), whose own components are ``tops``."""
    least = tops.select(F.col("node").alias("label"), F.col("label").alias("least"))
    out = found.join(least, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    return out.unionByName(tops.join(found, "node", "left_anti").select("node", "label"))


def thinned(edges: DataFrame) -> DataFrame:
    """Edges (columns x, y) with the same nodes and components, but one for each y, to its smallest x, and one from there to each other
    x of that y. Where few x have many y in common, that is about an edge a node. All x of one y come into one row: they must be few.
    """
    near = edges.groupBy("y").agg(F.array_sort(F.collect_set("x")).alias("xs"))
    least = F.element_at("xs", 1)
    pairs = F.transform("xs", lambda x: F.struct(least.alias("x"), F.when(x == least, F.col("y")).otherwise(x).alias("y")))
    return near.select(F.explode(pairs).alias("e")).select("e.x", "e.y").distinct()
