"""Graph analytics on Spark: graphs are node and edge DataFrames, algorithms DataFrame programs."""

from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector

__all__ = ["BipartiteGraph", "EdgeMap", "EdgeSet", "Graph", "NodeMap", "NodeSet", "Vector"]
