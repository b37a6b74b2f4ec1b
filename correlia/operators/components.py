"""Connected components by iterative minimum-label propagation over a bipartite graph (node, ent)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable, lookup_join


def _roots(step: DataFrame) -> DataFrame:
    """Double the pointers of (node, label), label < node, until every label is a root."""
    while True:
        onward = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = durable(lookup_join(step, onward, "label"))
        if jumped.where("further is not null").isEmpty():
            return step
        step = durable(jumped.select("node", F.coalesce("further", "label").alias("label")))


def propagate(edges: DataFrame) -> DataFrame:
    """(node, label) of every node whose component has a smaller node; label is the smallest.

    An entity takes the smallest label of its nodes, a node that of its entities; pointers are doubled to
    roots and the graph contracted to them, which at least halves the labels of an unfinished component in each
    round. Entities and labels that hold many edges go through `lookup_join`. Null nodes or entities tie nothing.
    """
    edges = durable(edges.where("node is not null and ent is not null").distinct())
    maps: list[DataFrame] = []
    while True:
        ents = edges.groupBy("ent").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("ent", "lo")
        live = durable(lookup_join(edges, ents, "ent", "inner"))
        if live.isEmpty():
            break
        step = live.groupBy("node").agg(F.min("lo").alias("label")).where("label < node")
        step = _roots(durable(step))
        maps.append(step)
        moved = lookup_join(live.drop("lo"), step, "node")
        edges = durable(moved.select(F.coalesce("label", "node").alias("node"), "ent").distinct())
    if not maps:
        return edges.select("node", F.col("node").alias("label")).limit(0)

    def compose(later: DataFrame, earlier: DataFrame) -> DataFrame:
        end = later.select(F.col("node").alias("label"), F.col("label").alias("end"))
        return durable(lookup_join(earlier, end, "label").select("node", F.coalesce("end", "label").alias("label")).unionByName(later))

    return reduce(compose, reversed(maps))
