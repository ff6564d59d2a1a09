"""Louvain communities (Blondel and others, 2008) with synchronous moves.

Each round a random three quarters of the nodes may move, each to the neighbouring community with the
highest gain; two single nodes never swap, as only the larger label may join the smaller one
(Lu, Halappanavar, Kalyanaraman, 2015). If the joint moves lower the modularity, they are taken
back and half as many nodes are asked, until a gain lets twice as many be asked again. A level ends when all nodes were asked and none moved, or when that
gained no more than ``tolerance``. Communities then become the nodes of the next level. Before the first
level, nodes with a single neighbour follow it (vertex following, in the same paper), which no move could better.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import canonicalize, symmetrize, whole_edges
from edgeloom.model import Graph, NodeMap
from edgeloom.plans.adjacency import Adjacency
from edgeloom.plans.rounds import Rounds, written
from edgeloom.plans.skew import hot_keys, lookup, measured_hot_keys


def _weighted(graph: Graph) -> DataFrame:
    weight = F.col("weight").cast("double") if graph.is_weighted else F.lit(1.0)
    return whole_edges(graph.edges.select("src", "dst", weight.alias("weight")))


@dataclass
class _Level:
    """A graph of one level: links without loops in both directions, and its nodes."""

    links: DataFrame  # src, dst, weight
    nodes: DataFrame  # id, loop: twice the weight inside the node
    size: int  # number of nodes


def louvain_community(graph: Graph, tolerance: float = 1e-5) -> tuple[NodeMap, float]:
    """A community label per node, and the modularity of the partition.

    Directions are ignored, parallel edges add up, edges without a weight count 1. The label
    is the smallest id of the community; a node without an edge is its own. ``tolerance`` is
    the gain in modularity that a round over all nodes, and a level, must exceed to go on.
    """
    merged = canonicalize(_weighted(graph)).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    merged, facts = written(merged, weight=F.sum("weight"))
    loops = merged.where("src = dst").select(F.col("src").alias("id"), (2 * F.col("weight")).alias("loop"))
    nodes = graph.nodes.select("id").distinct().join(loops, "id", "left").fillna(0.0, ["loop"])
    nodes, size = written(nodes, rows=F.count("*"))
    level = _Level(symmetrize(merged.where("src <> dst")), nodes, size["rows"])
    members = level.nodes.select("id", F.col("id").alias("community"))
    total = 2.0 * (facts["weight"] or 0.0)
    score, better = 0.0, total > 0
    if better:
        with Rounds(graph.edges.sparkSession) as rounds:
            links, best = _follow(rounds, level)
            level = _contract(links, best, level.size)
            members, _ = written(best.select("id", "community"))
    while better:
        with Rounds(graph.edges.sparkSession) as rounds:
            links, best, score, better = _settle(rounds, level, total, tolerance)
            if better:
                before, level = level.size, _contract(links, best, level.size)
                members, _ = written(_hand_on(members, best, size["rows"], before))
    return NodeMap(_name(members, size["rows"])), score


def _follow(rounds: Rounds, level: _Level) -> tuple[Adjacency, DataFrame]:
    """Nodes without a loop and with one neighbour, by a positive weight, join it; of two such the larger joins."""
    links = Adjacency(rounds, level.links)
    ends = links.edges.groupBy(F.col("src").alias("id")).agg(
        F.count("*").alias("n"), F.max("dst").alias("to"), F.min("weight").alias("least")
    )
    single, facts = rounds.written(
        ends.where("n = 1 and least > 0").join(level.nodes.where("loop = 0"), "id").select("id", "to"), rows=F.count("*")
    )
    # Whose neighbour is single as well is one of a pair.
    popular = measured_hot_keys(single, "to", facts["rows"])
    other = single.select("id", F.lit(True).alias("paired"))
    known = lookup(single, "to", other, popular, "id", how="left", rows=facts["rows"])
    target = known.where("paired is null or id > to").select("id", "to")
    joined = level.nodes.join(target, "id", "left")
    best, _ = rounds.written(joined.select("id", "loop", F.coalesce("to", "id").alias("community")))
    return links, best


def _settle(rounds: Rounds, level: _Level, total: float, tolerance: float):
    """Move nodes until the modularity stops rising; returns the best partition and its score."""
    links = Adjacency(rounds, level.links)
    degree = links.edges.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("out"))
    nodes = level.nodes.join(degree, "id", "left")
    strength = (F.coalesce("out", F.lit(0.0)) + F.col("loop")).alias("strength")
    state, _ = rounds.written(
        nodes.select("id", "loop", strength, F.col("id").alias("community"))
    )
    first = best_score = None
    best, turn, parts, all_asked, was_all = state, 0, 1, False, False
    while True:
        before = state
        state, facts = rounds.written(
            _move(links, state, level.size, total, turn, parts, all_asked),
            inside=F.sum(F.col("own") + F.col("loop")),
            square=F.sum(F.col("strength") * F.col("tot")),
            moved=F.count(F.when(F.col("community") != F.col("was"), 1)),
        )
        # The score is that of ``before``: what the last round's moves have led to.
        score = facts["inside"] / total - facts["square"] / total**2
        first = score if first is None else first
        turn += 1
        if best_score is not None and score < best_score:
            # The moves spoilt each other: back, and ask ever fewer nodes at once.
            state, parts, all_asked, was_all = best, parts * 2, False, False
            if parts > max(1, level.size):
                break  # even one node at a time gains nothing that numbers can show
            continue
        small = best_score is not None and score - best_score <= tolerance
        if best_score is not None and not small:
            parts = max(1, parts // 2)
        best, best_score = before, score
        if facts["moved"] == 0 and all_asked or small and was_all:
            break
        # After a round of little gain every node is asked before the level may end.
        was_all = all_asked
        all_asked = facts["moved"] == 0 or small
    better = best_score > first + tolerance
    return links, best, best_score if better else first, better


def _move(
    links: Adjacency, state: DataFrame, count: int, total: float, turn: int, parts: int, all_asked: bool
) -> DataFrame:
    """One round. The new state also carries what the score of the old one needs.

    A part in ``parts`` of the nodes is asked, or three quarters if that is one; or all.
    """
    sums = state.groupBy("community").agg(F.sum("strength").alias("tot"), F.count("*").alias("n"))
    crowded = measured_hot_keys(state, "community", count)
    now = lookup(
        state.select("id", "loop", "strength", "community"), "community",
        sums.withColumnRenamed("community", "id"), crowded, "id", rows=count,
    )
    offers = (
        links.reach(now.select("id", F.col("community").alias("to"), F.col("tot").alias("to_tot"),
                               F.col("n").alias("to_n")), count)
        .groupBy(F.col("dst").alias("id"), "to")
        .agg(F.sum("weight").alias("w"), F.max("to_tot").alias("to_tot"), F.max("to_n").alias("to_n"))
    )
    is_own = F.col("to") == F.col("community")
    swap = (F.col("n") == 1) & (F.col("to_n") == 1) & (F.col("to") > F.col("community"))
    worth = F.col("w") - F.col("strength") * F.col("to_tot") / F.lit(total)
    # The smaller label wins a tie, so it is compared as a negative number.
    offer = F.struct(worth.alias("worth"), (-F.col("to")).alias("minus"))
    judged = lookup(offers, "id", now, links.hot, "to", rows=count).groupBy("id").agg(
        F.max(F.when(~is_own & ~swap, offer)).alias("best"),
        F.sum(F.when(is_own, F.col("w"))).alias("own"),
    )
    own = F.coalesce("own", F.lit(0.0))
    stay = own - F.col("strength") * (F.col("tot") - F.col("strength")) / F.lit(total)
    draw = F.xxhash64("id", F.lit(turn))
    in_turn = F.pmod(draw, F.lit(4)) != 0 if parts == 1 else F.pmod(draw, F.lit(parts)) == 0
    in_turn = F.lit(True) if all_asked else in_turn
    moves = in_turn & (F.col("best.worth") > stay + F.lit(1e-12 * total))
    return now.join(judged.hint("merge"), "id", "left").select(
        "id", "loop", "strength",
        F.when(moves, -F.col("best.minus")).otherwise(F.col("community")).alias("community"),
        F.col("community").alias("was"), "tot", own.alias("own"),
    )


def _contract(links: Adjacency, best: DataFrame, size: int) -> _Level:
    """Communities as nodes; the weight inside one becomes its loop."""
    label = best.select("id", "community")
    half = links.reach(label.withColumnRenamed("community", "a"), size)
    other = label.withColumnRenamed("community", "b")
    both = lookup(half, "dst", other, links.hot, "src", rows=size)
    edges, _ = written(both.groupBy("a", "b").agg(F.sum("weight").alias("weight")))
    inside = edges.where("a = b").select(F.col("a").alias("id"), "weight")
    loops = best.groupBy(F.col("community").alias("id")).agg(F.sum("loop").alias("loop"))
    loop = (F.col("loop") + F.coalesce("weight", F.lit(0.0))).alias("loop")
    nodes, facts = written(
        loops.join(inside, "id", "left").select("id", loop), rows=F.count("*")
    )
    crossing = edges.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight")
    return _Level(crossing, nodes, facts["rows"])


def _hand_on(members: DataFrame, best: DataFrame, rows: int, size: int) -> DataFrame:
    """The community of every original node after one more level."""
    hot = measured_hot_keys(members, "community", rows)
    step = best.select("id", F.col("community").alias("next"))
    moved = lookup(members, "community", step, hot, "id", rows=size)
    return moved.select("id", F.col("next").alias("community"))


def _name(members: DataFrame, rows: int) -> DataFrame:
    """Label each community with its smallest original id."""
    least = members.groupBy("community").agg(F.min("id").alias("weight"), F.count("*").alias("n"))
    hot = hot_keys(least.select("community", "n"), "community", rows)
    table = least.select(F.col("community").alias("id"), "weight")
    named = lookup(members, "community", table, hot, "id", rows=rows)
    return written(named.select("id", "weight"))[0]


def modularity_table(graph: Graph, labels: NodeMap) -> DataFrame:
    """One row ``modularity`` of the communities that ``labels`` gives to the ends of all edges."""
    edges, facts = written(_weighted(graph), rows=F.count("*"))
    by_src, by_dst = (measured_hot_keys(edges, end, facts["rows"]) for end in ("src", "dst"))
    named = lookup(edges, "src", labels.df.withColumnRenamed("weight", "a"), by_src, "dst")
    named = lookup(named, "dst", labels.df.withColumnRenamed("weight", "b"), by_dst, "src")
    inside = F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(F.lit(0.0))
    ends = F.explode(F.array(
        F.struct(F.col("a").alias("c"), F.col("weight").alias("k"), inside.alias("inside")),
        F.struct(F.col("b").alias("c"), F.col("weight").alias("k"), F.lit(0.0).alias("inside")),
    ))
    sums = named.select(ends.alias("e")).groupBy("e.c").agg(
        F.sum("e.k").alias("k"), F.sum("e.inside").alias("inside")
    )
    double_m = F.sum("k")
    value = 2 * F.sum("inside") / double_m - F.sum(F.col("k") * F.col("k")) / (double_m * double_m)
    return sums.agg(value.alias("modularity"))
