"""Strongly connected components by colouring in both directions.

Every node learns the smallest id that reaches it (``fore``) and the smallest it reaches
(``back``). If the two agree, that id and the node reach each other: the node is settled under
it, and it is the smallest id of the component. Nodes of one component always agree on both
values, so edges between nodes that differ in either are cut, and the rest goes on. In every
remaining class the smallest id settles its own component, so each turn makes progress.
(After Orzan's colouring, 2004; trimming after McLendon and others, 2005.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.functions.edges import endpoints, whole_edges
from edgeloom.model import Graph, NodeMap
from edgeloom.plans.adjacency import Adjacency
from edgeloom.plans.rounds import Rounds, setting, written
from edgeloom.plans.skew import hot_keys, lookup


def strongly_connected_components(graph: Graph, include_isolated: bool = False) -> NodeMap:
    """Label every node with the smallest id of its strong component.

    In an undirected graph these are the connected components. Nodes without an edge are left
    out unless ``include_isolated``.
    """
    if not graph.is_directed:
        from edgeloom.operators.components import connected_components

        return connected_components(graph, include_isolated)
    count = F.count("*")
    edges, facts = written(whole_edges(graph.edges.select("src", "dst")).distinct(), rows=count)
    ids = graph.nodes.select("id").distinct() if include_isolated else endpoints(edges)
    open_nodes, left = written(ids, rows=count)
    edges, rows, settled = edges.where("src <> dst"), facts["rows"], []
    while left["rows"]:
        seen = _seen(edges)
        core, size = written(seen.where("out > 0 and in > 0"), rows=count)
        alone = open_nodes.join(core.select("id"), "id", "left_anti")
        if len(settled) > setting(edges.sparkSession, "unionFrames"):
            settled = [written(reduce(DataFrame.union, settled))[0]]
        settled.append(written(alone.select("id", F.col("id").alias("weight")))[0])
        if size["rows"] == 0:
            break
        inner = edges
        if size["rows"] < left["rows"]:
            inner = _among(edges, core, size["rows"], rows)
        with Rounds(graph.edges.sparkSession) as rounds:
            links, colours = _colour(inner, core.select("id"), size["rows"], rounds)
            done = colours.where("fore = back")
            settled.append(written(done.select("id", F.col("fore").alias("weight")))[0])
            rest, left = written(
                colours.where("fore <> back").select("id", "fore", "back"), rows=count
            )
            open_nodes = rest.select("id")
            if left["rows"]:
                edges, facts = written(_inside_classes(links, rest, left["rows"]), rows=count)
                rows = facts["rows"]
    if not settled:
        return NodeMap(open_nodes.select("id", F.col("id").alias("weight")))
    return NodeMap(reduce(DataFrame.union, settled))


def _seen(edges: DataFrame) -> DataFrame:
    """``id, out, in``: the number of edges out of and into every node."""
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("in")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("in")),
    ))
    return edges.select(ends.alias("e")).select("e.*").groupBy("id").agg(
        F.sum("out").alias("out"), F.sum("in").alias("in")
    )


def _among(edges: DataFrame, core: DataFrame, size: int, rows: int) -> DataFrame:
    """The edges between core nodes; a node that lacks one direction is a component of its own."""
    by_src = hot_keys(core.select("id", F.col("out").alias("n")), "id", rows)
    by_dst = hot_keys(core.select("id", F.col("in").alias("n")), "id", rows)
    ids = core.select("id")
    met = lookup(edges, "src", ids, by_src, "dst", rows=size)
    return lookup(met, "dst", ids, by_dst, "src", rows=size).select("src", "dst")


def _colour(
    edges: DataFrame, nodes: DataFrame, size: int, rounds: Rounds
) -> tuple[Adjacency, DataFrame]:
    """Spread both colours until nothing changes; only changed nodes send theirs on."""
    here = F.struct(F.col("src").alias("s"), F.col("dst").alias("d"), F.lit(True).alias("ahead"))
    back = F.struct(F.col("dst").alias("s"), F.col("src").alias("d"), F.lit(False).alias("ahead"))
    both = edges.select(F.explode(F.array(here, back)).alias("e")).select(
        F.col("e.s").alias("src"), F.col("e.d").alias("dst"), F.col("e.ahead").alias("ahead")
    )
    links = Adjacency(rounds, both)
    state = nodes.select(
        "id", F.col("id").alias("fore"), F.col("id").alias("back"),
        F.lit(True).alias("fore_new"), F.lit(True).alias("back_new"),
    )
    changed = size
    while changed:
        senders = state.where("fore_new or back_new")
        ahead = F.col("ahead")
        new = F.when(ahead, F.col("fore_new")).otherwise(F.col("back_new"))
        # The state travels with the messages, so one aggregation joins them.
        sent = links.reach(senders, changed).where(new).select(
            F.col("dst").alias("id"), F.when(ahead, F.col("fore")).alias("fore"),
            F.when(~ahead, F.col("back")).alias("back"), *_unknown("old_fore", "old_back"),
        )
        kept = state.select(
            "id", "fore", "back", F.col("fore").alias("old_fore"), F.col("back").alias("old_back")
        )
        least = sent.union(kept).groupBy("id").agg(
            F.min("fore").alias("fore"), F.min("back").alias("back"),
            F.max("old_fore").alias("old_fore"), F.max("old_back").alias("old_back"),
        )
        heard = least.select(
            "id", "fore", "back", (F.col("fore") < F.col("old_fore")).alias("fore_new"),
            (F.col("back") < F.col("old_back")).alias("back_new"),
        )
        moved = F.count(F.when(F.col("fore_new") | F.col("back_new"), 1))
        state, facts = rounds.written(heard, changed=moved)
        changed = facts["changed"]
    return links, state


def _unknown(*names: str) -> list[Column]:
    return [F.lit(None).cast("bigint").alias(name) for name in names]


def _inside_classes(links: Adjacency, rest: DataFrame, size: int) -> DataFrame:
    """The edges whose two ends are unsettled and agree on both colours."""
    tagged = links.reach(rest, size).where("ahead").select("src", "dst", "fore", "back")
    other = rest.select("id", F.col("fore").alias("fore_b"), F.col("back").alias("back_b"))
    met = lookup(tagged, "dst", other, links.hot, "src", rows=size)
    return met.where("fore = fore_b and back = back_b").select("src", "dst")
