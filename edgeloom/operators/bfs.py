"""Breadth-first search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import symmetrize, whole_edges
from edgeloom.model import Graph, Vector
from edgeloom.plans.adjacency import Adjacency
from edgeloom.plans.positions import dense_positions
from edgeloom.plans.rounds import Rounds, setting


def bfs_levels(graph: Graph, source: int, depth_limit: int | None, rounds: Rounds) -> DataFrame:
    """``id, distance`` of every node within ``depth_limit`` hops of ``source``."""
    edges = whole_edges(graph.edges.select("src", "dst")).where(F.col("src") != F.col("dst"))
    edges = edges if graph.is_directed else symmetrize(edges)
    links = Adjacency(rounds, edges.distinct())
    if links.edges.where(F.col("src") == source).isEmpty():
        if graph.nodes.where(F.col("id") == source).isEmpty():
            raise ValueError(f"the graph has no node {source}")
    spark = graph.edges.sparkSession
    start = spark.range(1).select(F.lit(source).cast("bigint").alias("id"), F.lit(0).alias("distance"))
    distance, reached, frontier, levels, recent = 0, 1, start, [start], [start]
    while reached and (depth_limit is None or distance < depth_limit):
        distance += 1
        # In an undirected graph a neighbour is at most one level away, so older levels need no look.
        known = levels if graph.is_directed else recent
        visited = reduce(DataFrame.union, known).select("id")
        near = links.reach(frontier.select("id"), reached).select(F.col("dst").alias("id"))
        fresh = near.distinct().join(visited, "id", "left_anti")
        frontier, facts = rounds.written(
            fresh.select("id", F.lit(distance).alias("distance")), rows=F.count("*")
        )
        reached = facts["rows"]
        levels.append(frontier)
        recent = [recent[-1], frontier]
        if len(levels) > setting(spark, "unionFrames"):
            levels = [rounds.written(reduce(DataFrame.union, levels))[0]]
    return reduce(DataFrame.union, levels)


def bfs_iter(graph: Graph, source: int, depth_limit: int | None = None) -> Vector:
    """Nodes reachable from ``source`` by number of hops, equal ones by id."""
    with Rounds(graph.edges.sparkSession) as rounds:
        reached = bfs_levels(graph, source, depth_limit, rounds)
        placed = dense_positions(reached, ["distance", "id"])
        return Vector(placed.select("pos", F.col("id").alias("value")))
