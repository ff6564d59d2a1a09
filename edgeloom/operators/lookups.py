"""Membership, reads by key and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import endpoints
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector


def _key(x: Vector | NodeSet | NodeMap) -> str:
    return "pos" if isinstance(x, Vector) else "id"


def _asked(ids: DataFrame, key: str) -> DataFrame:
    # Each asked id once: repeats would only load one task.
    return ids.select(F.col(ids.columns[0]).cast("bigint").alias(key)).distinct()


def _table(x: Vector | NodeSet | NodeMap, ids: DataFrame | list[int]) -> DataFrame:
    """Asked ids as a table; a list of any length doesn't become part of the plan."""
    if isinstance(ids, DataFrame):
        return ids
    return x.df.sparkSession.createDataFrame([(int(i),) for i in ids], "id bigint")


def contains(x: Vector | NodeSet | NodeMap, ids: DataFrame | list[int]) -> DataFrame:
    """The asked ids that are in ``x``, each once. A table's first column holds the ids."""
    key = _key(x)
    known = x.df.select(key)
    return _asked(_table(x, ids), key).join(known, key, "left_semi")


def get(x: Vector | NodeMap, ids: DataFrame | list[int]) -> DataFrame:
    """The rows of the asked ids or positions; absent ones are left out."""
    key = _key(x)
    return x.df.join(_asked(_table(x, ids), key), key, "left_semi")


def vector_length(x: Vector) -> DataFrame:
    """One row: the highest position plus one, 0 when empty."""
    return x.df.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("length"))


def num_nodes(x: NodeSet | NodeMap | EdgeSet | EdgeMap | Graph | BipartiteGraph) -> DataFrame:
    """One row: ids listed, on both sides if there are two, or the distinct ids that an edge table touches."""
    if isinstance(x, BipartiteGraph):
        both = x.nodes0.select("id").union(x.nodes1.select("id"))
        return both.agg(F.count("*").alias("num_nodes"))
    if isinstance(x, (EdgeSet, EdgeMap)):
        ids = endpoints(x.df)
    else:
        ids = x.nodes if isinstance(x, Graph) else x.df
    return ids.agg(F.count("*").alias("num_nodes"))


def num_edges(x: EdgeSet | EdgeMap | Graph | BipartiteGraph) -> DataFrame:
    edges = x.df if isinstance(x, (EdgeSet, EdgeMap)) else x.edges
    return edges.agg(F.count("*").alias("num_edges"))
