"""Betweenness centrality by shortest paths from all or from given nodes (Brandes, 2001).

Many sources advance together: a round extends every source's search by one level and adds up the numbers of
shortest paths. Then the levels are walked back, and every node passes its share on to the
nodes before it. A round is one job; its state has a row per source and node of the level. Sources are
taken in batches whose searches reach a bounded number of rows in all: a source without an edge ahead
reaches nothing, any other at most the nodes of its weak component.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import symmetrize, whole_edges
from edgeloom.model import Graph, NodeMap, NodeSet
from edgeloom.operators.components import connected_components
from edgeloom.plans.adjacency import Adjacency
from edgeloom.plans.rounds import Rounds, setting, written
from edgeloom.plans.skew import hot_keys, lookup


def betweenness(graph: Graph, sources: NodeSet | None = None, normalize: bool = False) -> NodeMap:
    """Per node, the shares it has in the shortest paths from ``sources`` to all other nodes, ends not counted.

    Without ``sources`` all nodes are, and in an undirected graph every pair counts once. With given sources,
    paths count as seen from each of them, so a pair of two sources counts twice there. ``normalize`` divides
    by the pairs that a node can lie between, ``(n - 1) (n - 2)`` ordered ones for n nodes, and scales k given sources
    up to n, so that they estimate what all would give. Parallel edges and loops don't count; sources that
    are no nodes of an edge reach nothing; without any source all scores are 0.
    """
    spark = graph.edges.sparkSession
    with Rounds(spark) as rounds:
        edges = whole_edges(graph.edges.select("src", "dst")).where("src <> dst")
        edges = edges if graph.is_directed else symmetrize(edges)
        links = Adjacency(rounds, edges.distinct())
        every, found = rounds.written(graph.nodes.select("id").distinct(), rows=F.count("*"))
        starts, n, k = every, found["rows"], found["rows"]
        if sources is not None:
            given = sources.df.select("id").distinct().join(every, "id", "left_semi")
            starts, found = rounds.written(given, rows=F.count("*"))
            k = found["rows"]
        starts, found = rounds.written(_reaching(links, starts), rows=F.sum("most"))
        batches = math.ceil((found["rows"] or 0) / setting(spark, "stateRows"))
        total = None
        for batch in range(batches):
            mine = F.pmod(F.xxhash64("id"), F.lit(batches)) == batch
            with Rounds(spark) as inner:
                shares = _shares(inner, links, starts.where(mine), graph.is_directed)
                shares = shares if total is None else total.union(shares)
                total, _ = rounds.written(shares.groupBy("id").agg(F.sum("share").alias("share")))
        if total is None:
            return NodeMap(written(every.select("id", F.lit(0.0).alias("weight")))[0])
        scale = 1.0
        if normalize:
            scale = (1.0 if sources is None else n / k) / max(1, (n - 1) * (n - 2))
        elif sources is None and not graph.is_directed:
            scale = 0.5
        weight = F.coalesce("share", F.lit(0.0)) * F.lit(scale)
        return NodeMap(written(every.join(total, "id", "left").select("id", weight.alias("weight")))[0])


def _reaching(links: Adjacency, starts: DataFrame) -> DataFrame:
    """``id, most``: the starts with an edge ahead, and how many nodes their weak component holds."""
    labels = connected_components(Graph(links.edges.select("src", "dst"))).df
    sizes = labels.groupBy("weight").agg(F.count("*").alias("most"))
    large = hot_keys(sizes.withColumnRenamed("most", "n"), "weight", links.rows * 2)
    ahead = starts.join(links.edges.select(F.col("src").alias("id")), "id", "left_semi")
    sources, table = labels.join(ahead, "id", "left_semi"), sizes.withColumnRenamed("weight", "id")
    return lookup(sources, "weight", table, large, "id").select("id", "most")


def _shares(rounds: Rounds, links: Adjacency, sources: DataFrame, is_directed: bool) -> DataFrame:
    """``id, share``: a row per source and node that it reaches, but the source."""
    start = sources.select(F.col("id").alias("root"), "id", F.lit(1.0).alias("paths"))
    level, facts = rounds.written(start, rows=F.count("*"))
    levels, sizes, seen = [level], [facts["rows"]], [level.select("root", "id")]
    while sizes[-1]:
        # In an undirected graph a neighbour is at most one level away, so older levels need no look.
        known = reduce(DataFrame.union, seen if is_directed else seen[-2:])
        ahead = links.reach(levels[-1], sizes[-1]).groupBy("root", F.col("dst").alias("id")).agg(
            F.sum("paths").alias("paths")
        )
        level, facts = rounds.written(ahead.join(known, ["root", "id"], "left_anti"), rows=F.count("*"))
        levels.append(level)
        sizes.append(facts["rows"])
        seen.append(level.select("root", "id"))
        if is_directed and len(seen) > setting(level.sparkSession, "unionFrames"):
            seen = [rounds.written(reduce(DataFrame.union, seen))[0]]
    # The share of a node: what the nodes after it hold, by the part of their paths that lead through it.
    shares, held = [], levels[-1].withColumn("share", F.lit(0.0))
    for level, size in reversed(list(zip(levels[:-1], sizes))):
        later = held.select("root", F.col("id").alias("dst"), ((1 + F.col("share")) / F.col("paths")).alias("part"))
        passed = links.reach(level, size).join(later, ["root", "dst"]).groupBy("root", F.col("src").alias("id")).agg(
            F.sum(F.col("paths") * F.col("part")).alias("share")
        )
        joined = level.join(passed, ["root", "id"], "left").fillna(0.0, ["share"])
        held, _ = rounds.written(joined.select("root", "id", "paths", "share"))
        shares.append(held.where("root <> id").groupBy("id").agg(F.sum("share").alias("share")))
        if len(shares) > setting(level.sparkSession, "unionFrames"):
            shares = [rounds.written(reduce(DataFrame.union, shares))[0]]
    return reduce(DataFrame.union, shares, levels[0].where("false").select("id", F.col("paths").alias("share")))
