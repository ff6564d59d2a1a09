"""Operators on node sets, node maps and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.values import ValueFunction, apply_function
from edgeloom.model import NodeMap, NodeSet, Vector
from edgeloom.plans.positions import first_positions

# Aggregates that a node map can be reduced by.
REDUCERS = {"sum": F.sum, "min": F.min, "max": F.max, "product": F.product, "count": F.count}


def node_set_from_vector(x: Vector) -> NodeSet:
    """The values as ids; they must be whole numbers by type."""
    if x.dtype != "int":
        raise TypeError(f"values of type {x.dtype} are no ids")
    return NodeSet(x.df.select(F.col("value").cast("bigint").alias("id")))


class AbsentNodes(KeyError):
    """``count`` ids are not in a node map; ``nodes`` is a table of all of them."""

    def __init__(self, count: int, nodes: DataFrame):
        super().__init__(f"{count} ids are not in the node map; see the attribute nodes")
        self.nodes = nodes


def node_set_from_map(x: NodeMap) -> NodeSet:
    return NodeSet(x.df.select("id"))


def choose_random(x: NodeSet, k: int, seed: int = 0) -> NodeSet:
    """``k`` ids drawn without replacement; the same seed draws the same ids."""
    drawn = x.df.withColumn("_draw", F.xxhash64("id", F.lit(seed)))
    return NodeSet(first_positions(drawn, ["_draw", "id"], k).select("id"))


def sort(x: NodeMap, ascending: bool = True, limit: int | None = None) -> Vector:
    """Ids in the order of their values. Equal values go by id; descending is the reverse."""
    way = F.asc if ascending else F.desc
    placed = first_positions(x.df.select("id", "weight"), [way("weight"), way("id")], limit)
    return Vector(placed.select("pos", F.col("id").alias("value")))


def select(x: NodeMap, nodes: NodeSet, strict: bool = False) -> NodeMap:
    """The part of the map on ``nodes``; ``strict`` raises if one of them is not in the map."""
    if strict:
        absent = nodes.df.join(x.df.select("id"), "id", "left_anti")
        if count := absent.count():
            raise AbsentNodes(count, absent)
    return NodeMap(x.df.join(nodes.df, "id", "left_semi"))


def filter_nodes(x: NodeMap, func: ValueFunction, scalar: bool = False, batch: bool = False) -> NodeSet:
    """Ids whose value passes ``func``."""
    passes = apply_function(x.df, "weight", func, "boolean", scalar, batch)
    return NodeSet(x.df.where(passes).select("id"))


def apply(
    x: NodeMap, func: ValueFunction, return_type: str | None = None, scalar: bool = False,
    batch: bool = False,
) -> NodeMap:
    """Every value mapped by ``func``."""
    mapped = apply_function(x.df, "weight", func, return_type, scalar, batch)
    return NodeMap(x.df.select("id", mapped.alias("weight")))


def reduce(x: NodeMap, how: str) -> DataFrame:
    """One row ``value``: all values folded by a named aggregate."""
    return x.df.agg(REDUCERS[how]("weight").alias("value"))
