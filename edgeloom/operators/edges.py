"""Operators on edge tables and whole graphs that do not iterate."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, functions as F

from edgeloom.functions.edges import symmetrize
from edgeloom.functions.values import ValueFunction, apply_function
from edgeloom.model import EdgeMap, EdgeSet, Graph, NodeMap, NodeSet
from edgeloom.operators.checks import require_valid


def edge_map_from_edge_set(edges: EdgeSet, default_value) -> EdgeMap:
    weight = F.lit(default_value).alias("weight")
    return EdgeMap(edges.df.select("src", "dst", weight), edges.is_directed)


def edge_set_from_map(edges: EdgeMap) -> EdgeSet:
    return EdgeSet(edges.df.select("src", "dst"), edges.is_directed)


def assign_uniform_weight(graph: Graph, weight) -> Graph:
    edges = graph.edges.select("src", "dst", F.lit(weight).alias("weight"))
    return replace(graph, edges=edges)


def build_graph(
    edges: EdgeSet | EdgeMap, nodes: NodeSet | NodeMap | None = None, validate: bool = True
) -> Graph:
    """Edges and nodes as one graph; a node map gives node weights, no nodes the edges' ends."""
    if nodes is None:
        return Graph(edges.df, is_directed=edges.is_directed)
    graph = Graph(edges.df, nodes.df, edges.is_directed, isinstance(nodes, NodeMap))
    return require_valid(graph) if validate else graph


def filter_edges(
    graph: Graph, func: ValueFunction, scalar: bool = False, batch: bool = False
) -> Graph:
    """Keep the edges whose weight passes ``func``, and all nodes."""
    passes = apply_function(graph.edges, "weight", func, "boolean", scalar, batch)
    return replace(graph, edges=graph.edges.where(passes))


# Named folds: how the edges of one node combine, and how the start value joins in.
FOLDS = {
    "sum": (F.sum, lambda start, value: start + value),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
    "product": (F.product, lambda start, value: start * value),
}


def aggregate_edges(
    graph: Graph, how: str, initial_value, in_edges: bool = False, out_edges: bool = True
) -> NodeMap:
    """Fold the weights of each node's edges, from ``initial_value``; every node has a row."""
    if not graph.is_weighted:
        raise ValueError("the graph has no weights")
    edges = graph.edges
    if not graph.is_directed:
        edges, ends = symmetrize(edges), ["src"]
    else:
        ends = ["src"] * out_edges + ["dst"] * in_edges
    if not ends:
        raise ValueError("choose in_edges, out_edges or both")
    fold, join = FOLDS[how]
    opened = edges.select(F.explode(F.array(*ends)).alias("id"), "weight")
    folded = opened.groupBy("id").agg(fold("weight").alias("_folded"))
    start: Column = F.lit(initial_value)
    weight = F.coalesce(join(start, F.col("_folded")), start).alias("weight")
    return NodeMap(graph.nodes.select("id").join(folded, "id", "left").select("id", weight))
