"""Profiles: the properties of a model object as a one-row table.

Properties that a schema or a flag answers become literals. The others come out of a single
aggregation over the tables of the object.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.functions.edges import endpoints
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector


def _flag(value: str | bool | None) -> Column:
    return F.lit(value) if value is not None else F.lit(None).cast("string")


def _kind(weighted: bool) -> str:
    return "map" if weighted else "set"


def _tagged(name: str, df: DataFrame, negative: Column | None = None) -> DataFrame:
    flag = F.lit(None).cast("boolean") if negative is None else negative
    return df.select(F.lit(name).alias("_table"), flag.alias("_negative"))


def _one_row(
    facts: dict[str, Column], tables: dict[str, DataFrame], negative: str | None = None,
    dtype: str | None = None, edges: DataFrame | None = None,
) -> DataFrame:
    """Literals, a row count per table and, for numeric weights, whether any is negative."""
    below = F.col("weight") < 0 if dtype in ("int", "float") else None
    parts = [
        _tagged(name, df, below if df is edges else None) for name, df in tables.items()
    ]
    counts = [
        F.count(F.when(F.col("_table") == name, True)).alias(name) for name in tables
    ]
    if negative is not None:
        any_negative = F.bool_or("_negative")
        if below is not None:
            any_negative = F.coalesce(any_negative, F.lit(False))
        counts.append(any_negative.alias(negative))
    row = reduce(DataFrame.union, parts).agg(*counts)
    return row.select(*[value.alias(name) for name, value in facts.items()], *row.columns)


def profile(
    x: Vector | NodeSet | NodeMap | EdgeSet | EdgeMap | Graph | BipartiteGraph, slow: bool = True
) -> DataFrame:
    """All properties of ``x``; without ``slow`` only those that need no data."""
    if not slow:
        return _schema_facts(x)
    if isinstance(x, Vector):
        length = F.coalesce(F.max("pos") + 1, F.lit(0)).alias("length")
        return x.df.agg(length).select(_flag(x.dtype).alias("dtype"), "length")
    facts = _facts(x)
    if isinstance(x, (NodeSet, NodeMap)):
        return _one_row(facts, {"num_nodes": x.df})
    if isinstance(x, (EdgeSet, EdgeMap)):
        tables = {"num_nodes": endpoints(x.df), "num_edges": x.df}
        if isinstance(x, EdgeSet):
            return _one_row(facts, tables)
        return _one_row(facts, tables, "has_negative_weights", x.dtype, x.df)
    if isinstance(x, Graph):
        tables = {"num_nodes": x.nodes, "num_edges": x.edges}
    else:
        tables = {"num_nodes0": x.nodes0, "num_nodes1": x.nodes1, "num_edges": x.edges}
    return _one_row(facts, tables, "edge_has_negative_weights", x.edge_dtype, x.edges)


def _schema_facts(x) -> DataFrame:
    df = x.edges if isinstance(x, (Graph, BipartiteGraph)) else x.df
    one = df.sparkSession.range(1)
    return one.select(*[value.alias(name) for name, value in _facts(x).items()])


def _facts(x) -> dict[str, Column]:
    """What the schema and the flags of ``x`` tell."""
    if isinstance(x, NodeSet):
        return {}
    if isinstance(x, (Vector, NodeMap)):
        return {"dtype": _flag(x.dtype)}
    if isinstance(x, EdgeSet):
        return {"is_directed": _flag(x.is_directed)}
    if isinstance(x, EdgeMap):
        return {"is_directed": _flag(x.is_directed), "dtype": _flag(x.dtype)}
    facts = {
        "is_directed": _flag(x.is_directed),
        "edge_type": _flag(_kind(x.is_weighted)),
        "edge_dtype": _flag(x.edge_dtype),
    }
    if isinstance(x, Graph):
        facts["node_type"] = _flag(_kind(x.has_node_weights))
        facts["node_dtype"] = _flag(x.node_dtype)
    else:
        for side, weighted in ((0, x.has_node0_weights), (1, x.has_node1_weights)):
            facts[f"node{side}_type"] = _flag(_kind(weighted))
            dtype = NodeMap(x.side(side)).dtype if weighted else None
            facts[f"node{side}_dtype"] = _flag(dtype)
    return facts
