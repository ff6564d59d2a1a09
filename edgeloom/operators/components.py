"""Weakly connected components by contraction.

Each round every node points to the highest of its closed neighbourhood in some order, and on
from there once more; then edges are redrawn between the nodes pointed to. Whatever the order,
nodes stay in their component and neighbours stay neighbours, so the small graph has the same
components. Rounds take turns between two orders: highest degree, which folds hubs and trees
at once, and a fresh random one, under which the expected number of nodes falls by a constant
factor on every graph. So the rounds are logarithmic in the nodes whatever the diameter, and
the first ones do most of the work. The labels are then handed back down the rounds.
(After Boegeholz, Brand, Todor: In-database connected component analysis, 2020.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import canonicalize, endpoints, neighbour_pairs, symmetrize, whole_edges
from edgeloom.model import Graph, NodeMap
from edgeloom.plans.rounds import Rounds, written
from edgeloom.plans.skew import HotKeys, hot_keys, lookup, measured_hot_keys


def connected_components(graph: Graph, include_isolated: bool = False) -> NodeMap:
    """Label every node with the smallest id of its component.

    Nodes without an edge are left out unless ``include_isolated``.
    """
    with Rounds(graph.edges.sparkSession) as rounds:
        count = F.count("*")
        edges, _ = rounds.written(canonicalize(whole_edges(graph.edges.select("src", "dst"))).distinct(), rows=count)
        touched = graph.nodes.select("id").distinct() if include_isolated else endpoints(edges)
        nodes, _ = rounds.written(touched.select("id", F.col("id").alias("low")), rows=count)
        pairs = edges.where("src <> dst")
        levels = [_Level(nodes)]
        left = {"rows": 1}
        while left["rows"]:
            ends = symmetrize(pairs)
            degrees, found = rounds.written(
                ends.groupBy(F.col("src").alias("id")).agg(count.alias("n")),
                nodes=count, ends=F.sum("n"),
            )
            size = found["nodes"]
            if size == 0:
                break
            hot = hot_keys(degrees, "id", found["ends"])
            order = F.xxhash64("id", F.lit(len(levels)))
            if len(levels) % 2:
                ranked = degrees.select("id", F.struct(F.col("n"), order).alias("order"))
            else:
                ranked = degrees.select("id", F.struct(order).alias("order"))
            first, _ = rounds.written(_highest(ends, ranked, hot, size))
            popular = measured_hot_keys(first, "rep", size)
            onward = first.select("id", F.col("rep").alias("next"))
            rep, _ = rounds.written(
                lookup(first, "rep", onward, popular, "id", rows=size)
                .select("id", F.col("next").alias("rep"))
            )
            src, dst = (rep.withColumnRenamed("rep", name) for name in ("a", "b"))
            moved = lookup(pairs, "src", src, hot, "dst", rows=size)
            moved = lookup(moved, "dst", dst, hot, "src", rows=size)
            drawn = neighbour_pairs(moved.select(F.col("a").alias("src"), F.col("b").alias("dst")))
            pairs, left = rounds.written(drawn, rows=count)
            merged, facts = rounds.written(
                levels[-1].nodes.join(rep, "id").groupBy("rep")
                .agg(F.min("low").alias("low"), count.alias("n")),
                reps=count, rows=F.sum("n"),
            )
            levels[-1].rep, levels[-1].reps = rep, facts["reps"]
            levels[-1].hot = hot_keys(merged.select("rep", "n"), "rep", facts["rows"])
            levels.append(_Level(merged.select(F.col("rep").alias("id"), "low")))
        labels = levels.pop().nodes.select("id", F.col("low").alias("weight"))
        for level in reversed(levels[1:]):
            labels, _ = rounds.written(level.hand_down(labels))
        return NodeMap(written(levels[0].hand_down(labels) if levels else labels)[0])


def _highest(ends: DataFrame, ranked: DataFrame, hot: HotKeys, size: int) -> DataFrame:
    """``id, rep``: of each node and its neighbours, the one highest in the order."""
    near = lookup(ends, "dst", ranked, hot, "src", rows=size)
    best = near.groupBy(F.col("src").alias("id")).agg(
        F.max(F.struct("order", F.col("dst").alias("id"))).alias("near")
    )
    own = F.struct("order", "id")
    return best.join(ranked, "id").select("id", F.greatest("near", own)["id"].alias("rep"))


class _Level:
    """Nodes of one round with the smallest original id each stands for."""

    def __init__(self, nodes: DataFrame):
        self.nodes = nodes  # id, low
        self.rep: DataFrame | None = None  # id, rep: nodes that had an edge
        self.reps = 0  # distinct reps
        self.hot = HotKeys()  # reps that very many nodes chose

    def hand_down(self, labels: DataFrame) -> DataFrame:
        """Labels of this round's nodes from those of the next; a finished node keeps its own."""
        from_rep = lookup(self.rep, "rep", labels, self.hot, "id", rows=self.reps).select("id", "weight")
        known = self.nodes.join(from_rep, "id", "left")
        return known.select("id", F.coalesce("weight", "low").alias("weight"))
