"""Projection of a bipartite graph onto one side."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeloom.functions.edges import symmetrize, whole_edges
from edgeloom.model import BipartiteGraph, Graph
from edgeloom.plans.partners import partners_within
from edgeloom.plans.rounds import Rounds, free_shuffles, setting
from edgeloom.plans.skew import lookup, sampled_hot_keys


def graph_projection(graph: BipartiteGraph, nodes_retained: int = 0) -> Graph:
    """Undirected graph of the retained nodes, joined where they share a neighbour.

    All retained nodes stay, with their weights. The result itself can be quadratic in the
    neighbours of a popular node; its work is cut into ranges of nodes, to which neighbours travel as packed lists.
    """
    kept = graph.side(nodes_retained)
    spark = kept.sparkSession
    with Rounds(spark) as rounds:
        edges, facts = rounds.written(whole_edges(graph.edges.select("src", "dst").distinct()), rows=F.count("*"))
        if facts["rows"] > setting(spark, "hotRows"):
            free_shuffles(spark)
        ids, span = rounds.written(kept.select("id").distinct(), n=F.count("id"), low=F.min("id"), high=F.max("id"))
        # Ends beyond the retained ids need not be looked up.
        both = symmetrize(edges).where(F.col("src").between(span["low"], span["high"]))
        hot = sampled_hot_keys(both, "src", facts["rows"])
        rows = lookup(both, "src", ids, hot, "dst", rows=span["n"])
        pairs = partners_within(rows, "dst", "src", facts["rows"])
    edges = pairs.select(F.col("first").alias("src"), F.col("second").alias("dst"))
    weighted = graph.has_node1_weights if nodes_retained else graph.has_node0_weights
    return Graph(edges, kept, is_directed=False, has_node_weights=weighted)
