"""Equality as a table of differences: two objects are equal when the table is empty.

Keys without values are counted in tasks of a bounded number of rows. Keys with values
are numbered where they repeat, so a key meets its like once and not all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeloom.functions.edges import canonicalize
from edgeloom.functions.values import simple_type, values_differ
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector
from edgeloom.plans.positions import dense_positions
from edgeloom.plans.rounds import even, setting, written
from edgeloom.plans.skew import lookup, measured_hot_keys

REL_TOL, ABS_TOL = 1e-9, 0.0


def _value_diff(
    left: DataFrame, right: DataFrame, keys: list[str], value: str, rel_tol: float, abs_tol: float,
    rank: str = "_rank",
) -> DataFrame:
    """Full outer join on ``keys``: absent rows, values that differ, and values of another type.

    Rows that share a key are compared in the order of their values; a null key equals a null key.
    Values of different simple types are never equal: the issue is ``type``.
    """
    types = [simple_type(df.schema[value].dataType) for df in (left, right)]
    sides = []
    for df, name, there in ((left, "left_value", "_l"), (right, "right_value", "_r")):
        ranked = _ranked(df.select(*keys, value), keys, value, rank)
        sides.append(ranked.select(*keys, rank, F.col(value).alias(name), F.lit(True).alias(there)))
    a, b = sides
    if types[0] != types[1]:
        apart, word = F.lit(True), "type"
    else:
        dtype = left.schema[value].dataType
        apart, word = values_differ(F.col("left_value"), F.col("right_value"), dtype, rel_tol, abs_tol), "value"
    issue = (
        F.when(F.col("_r").isNull(), "only_left")
        .when(F.col("_l").isNull(), "only_right")
        .when(apart, word)
    )
    renamed = b.select(*[F.col(k).alias(f"_other_{k}") for k in (*keys, rank)], "right_value", "_r")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in (*keys, rank)])
    joined = a.join(renamed, same, "full").withColumn("issue", issue)
    named = [
        F.when(F.col("_l").isNull(), F.col(f"_other_{k}")).otherwise(F.col(k)).alias(k) for k in (*keys, rank)
    ]
    found = joined.where(F.col("issue").isNotNull()).select(*named, "issue", "left_value", "right_value")
    return found.drop("_rank")


def _ranked(df: DataFrame, keys: list[str], value: str, rank: str) -> DataFrame:
    """Number the rows of each key by value.

    A window numbers ordinary keys. If a key has more rows than a task should hold, all rows are
    numbered over the whole table instead, and counted from the first one of their key.
    """
    df, _ = written(df)  # counted first, then compared
    size = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("top"), F.sum("n").alias("rows")).first()
    if (size["top"] or 0) <= 1:
        return df.withColumn(rank, F.lit(0).cast("bigint"))
    if size["top"] <= setting(df.sparkSession, "hotRows"):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(value)) - 1
        return df.withColumn(rank, place.cast("bigint"))
    # The row id only breaks ties between equal rows, so that a range can end among them.
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    numbered = dense_positions(tagged, [*keys, value, "_tie"], "_pos").drop("_tie")
    key = F.struct(*keys).alias("_key_of")
    first = numbered.groupBy(key).agg(F.min("_pos").alias("_first"))
    facts = numbered.select(key, value, "_pos")
    hot = measured_hot_keys(facts, "_key_of", size["rows"])
    placed = lookup(facts, "_key_of", first.withColumnRenamed("_key_of", "id"), hot, "_pos")
    return placed.select("_key_of.*", value, (F.col("_pos") - F.col("_first")).alias(rank))


def _count_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that the two sides hold a different number of times."""
    sides, facts = written(
        left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .union(right.select(*keys, F.lit(0), F.lit(1))),
        rows=F.count("*"),
    )
    both = even(sides, facts["rows"], *keys).groupBy(*keys).agg(F.sum("_l").alias("left_n"), F.sum("_r").alias("right_n"))
    issue = (
        F.when(F.col("right_n") == 0, "only_left")
        .when(F.col("left_n") == 0, "only_right")
        .otherwise("count")
    )
    return both.where("left_n <> right_n").select(*keys, issue.alias("issue"), "left_n", "right_n")


def vector_diff(left: Vector, right: Vector, rel_tol: float = 0.0, abs_tol: float = 0.0) -> DataFrame:
    """By position; exact unless tolerances are given: ``pos, issue, left_value, right_value``."""
    return _value_diff(left.df, right.df, ["pos"], "value", rel_tol, abs_tol)


def node_map_diff(
    left: NodeMap, right: NodeMap, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL
) -> DataFrame:
    """By id: ``id, issue, left_value, right_value``."""
    return _value_diff(left.df, right.df, ["id"], "weight", rel_tol, abs_tol)


def node_set_diff(left: NodeSet, right: NodeSet) -> DataFrame:
    """``id, issue``."""
    return _count_diff(left.df, right.df, ["id"]).select("id", "issue")


def _plain(edges: DataFrame, directed: bool) -> DataFrame:
    return edges if directed else canonicalize(edges)


def _same_direction(left, right) -> None:
    if left.is_directed != right.is_directed:
        raise ValueError("one side is directed, the other is not")


def edge_set_diff(left: EdgeSet, right: EdgeSet) -> DataFrame:
    """Edges held a different number of times: ``src, dst, issue, left_n, right_n``."""
    _same_direction(left, right)
    a, b = (_plain(x.df.select("src", "dst"), x.is_directed) for x in (left, right))
    return _count_diff(a, b, ["src", "dst"])


def edge_map_diff(
    left: EdgeMap, right: EdgeMap, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL
) -> DataFrame:
    """By edge: ``src, dst, rank, issue, left_value, right_value``.

    Parallel edges are compared in the order of their weights; ``rank`` counts them from 0.
    """
    _same_direction(left, right)
    a, b = (_plain(x.df.select("src", "dst", "weight"), x.is_directed) for x in (left, right))
    return _value_diff(a, b, ["src", "dst"], "weight", rel_tol, abs_tol, rank="rank")


def _edge_part(left, right, rel_tol: float, abs_tol: float) -> DataFrame:
    if left.is_weighted != right.is_weighted:
        raise ValueError("one side has edge weights, the other has not")
    if left.is_weighted:
        diff = edge_map_diff(
            EdgeMap(left.edges, left.is_directed), EdgeMap(right.edges, right.is_directed),
            rel_tol, abs_tol,
        )
    else:
        diff = edge_set_diff(
            EdgeSet(left.edges, left.is_directed), EdgeSet(right.edges, right.is_directed)
        )
    return diff.select(F.lit("edge").alias("part"), "src", "dst", "issue")


def _node_part(
    name: str, left: DataFrame, right: DataFrame, weighted: tuple[bool, bool],
    rel_tol: float, abs_tol: float,
) -> DataFrame:
    if weighted[0] != weighted[1]:
        raise ValueError(f"{name}: one side has node weights, the other has not")
    if weighted[0]:
        diff = node_map_diff(NodeMap(left), NodeMap(right), rel_tol, abs_tol)
    else:
        diff = _count_diff(left, right, ["id"])
    none = F.lit(None).cast("bigint").alias("dst")
    return diff.select(F.lit(name).alias("part"), F.col("id").alias("src"), none, "issue")


def graph_diff(
    left: Graph, right: Graph, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL
) -> DataFrame:
    """Nodes, node weights and edges: ``part, src, dst, issue``; a node stands in ``src``."""
    weighted = (left.has_node_weights, right.has_node_weights)
    nodes = _node_part("node", left.nodes, right.nodes, weighted, rel_tol, abs_tol)
    return nodes.union(_edge_part(left, right, rel_tol, abs_tol))


def bipartite_diff(
    left: BipartiteGraph, right: BipartiteGraph, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL
) -> DataFrame:
    """As :func:`graph_diff`, with one part per side."""
    w0 = (left.has_node0_weights, right.has_node0_weights)
    w1 = (left.has_node1_weights, right.has_node1_weights)
    return (
        _node_part("node0", left.nodes0, right.nodes0, w0, rel_tol, abs_tol)
        .union(_node_part("node1", left.nodes1, right.nodes1, w1, rel_tol, abs_tol))
        .union(_edge_part(left, right, rel_tol, abs_tol))
    )
