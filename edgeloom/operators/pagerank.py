"""PageRank by power iteration."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.functions.edges import symmetrize, whole_edges
from edgeloom.model import Graph, NodeMap
from edgeloom.plans.blocks import Blocks, total
from edgeloom.plans.rounds import Rounds, written

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "group bigint, out binary, rank binary, share binary, change double, lost double"


def pagerank(
    graph: Graph, damping: float = 0.85, maxiter: int = 50, tolerance: float = 1e-5,
    include_isolated: bool = False,
) -> NodeMap:
    """Rank of every node with an edge, over distinct edges without weights.

    The rank of nodes without out-edges is shared by all. Stops after ``maxiter`` rounds, or
    when the ranks change by less than ``tolerance`` in sum. A round shuffles the ranks and the partially
    summed contributions, packed by groups of nodes; the edges stay where they are.
    """
    with Rounds(graph.edges.sparkSession) as rounds:
        edges = whole_edges(graph.edges.select("src", "dst"))
        edges = edges if graph.is_directed else symmetrize(edges)
        edges, facts = rounds.written(edges.distinct(), rows=F.count("*"))
        nodes = _degrees(edges)
        if include_isolated:
            listed = graph.nodes.select("id").distinct().withColumn("listed", F.lit(True))
            nodes = nodes.withColumn("listed", F.lit(False)).join(listed.withColumnRenamed("listed", "here"), "id", "full")
            nodes = nodes.select("id", _zero("sent"), _zero("met"), F.col("here").isNotNull().alias("listed"))
        else:
            nodes = nodes.withColumn("listed", F.lit(True))
        count_if = lambda which: F.count(F.when(which, 1))
        nodes, size = rounds.written(
            nodes, all=F.count("*"), nodes=count_if(F.col("listed")), dangling=count_if(F.col("listed") & (F.col("sent") == 0)),
        )
        n = size["nodes"]
        if n == 0:
            return NodeMap(written(nodes.where("listed").select("id", F.lit(0.0).alias("weight")))[0])
        blocks = Blocks(rounds, nodes, size["all"], edges, facts["rows"])
        first, _ = rounds.written(blocks.grouped(_start(1.0 / n), f"{STATE}, ids array<bigint>"))
        state, mass = first.drop("ids"), size["dangling"] / n
        for _ in range(maxiter):
            moved = _round(blocks, state, n, damping, mass)
            state, facts = rounds.written(moved, change=F.sum("change"), lost=F.sum("lost"))
            mass = facts["lost"]
            if facts["change"] < tolerance:
                break
        named = first.select("group", "ids").groupBy("group").cogroup(state.select("group", "rank").groupBy("group"))
        return NodeMap(written(named.applyInArrow(_named, "id bigint, weight double"))[0])


def _degrees(edges: DataFrame) -> DataFrame:
    """``id, sent, met``: the number of edges from and to each node, from one pass over the edges."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = F.array(
        F.struct(F.col("src").alias("id"), one.alias("sent"), none.alias("met")),
        F.struct(F.col("dst").alias("id"), none.alias("sent"), one.alias("met")),
    )
    opened = edges.select(F.explode(ends).alias("_end")).select("_end.*")
    return opened.groupBy("id").agg(F.sum("sent").alias("sent"), F.sum("met").alias("met"))


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("bigint")).alias(name)


def _state(group: int, out: np.ndarray, rank: np.ndarray, change: float, **more: pa.Array) -> pa.Table:
    """A row of a group: out-degrees (NaN if not listed), ranks (NaN if none), and the share for each out-edge."""
    share = np.divide(rank, out, out=np.zeros(len(rank)), where=out > 0)
    columns = {name: pa.array([a.astype("<f8").tobytes()], pa.binary()) for name, a in (("out", out), ("rank", rank), ("share", share))}
    lost = float(rank[out == 0].sum())
    return pa.table({"group": pa.array([group]), **columns, "change": pa.array([change]), "lost": pa.array([lost]), **more})


def _start(rank: float) -> Callable[[pa.Table], pa.Table]:
    def start(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        listed = nodes["listed"].to_numpy()
        out = np.where(listed, nodes["sent"].to_numpy(), np.nan)
        ids = pa.array([nodes["id"].combine_chunks()], pa.list_(pa.int64()))
        return _state(nodes["group"][0].as_py(), out, np.where(listed, rank, np.nan), 0.0, ids=ids)

    return start


def _round(blocks: Blocks, state: DataFrame, n: int, damping: float, mass: float) -> DataFrame:
    """One step. The old ranks travel with the contributions, so one grouping brings them together."""
    sent = blocks.sums(state.select("group", F.col("share").alias("value")))
    none = F.lit(None).cast("binary")
    kept = state.select("group", none.alias("dst"), F.col("rank").alias("value"), "out")
    both = sent.withColumn("out", none).union(kept)

    def step(rows: pa.Table) -> pa.Table:
        is_state = pc.is_null(rows["dst"])
        known = rows.filter(is_state)
        out, old = (np.frombuffer(known[name][0].as_buffer(), "<f8") for name in ("out", "value"))
        received = total(rows.filter(pc.invert(is_state)), len(out))
        rank = (1.0 - damping) / n + damping * (received + mass / n)
        # An end that isn't listed has a rank once it has received one, and passes nothing on.
        rank = np.where(np.isnan(old) & (received == 0), np.nan, rank)
        return _state(known["group"][0].as_py(), out, rank, float(np.nansum(np.abs(rank - old))))

    return both.groupBy("group").applyInArrow(step, STATE)


def _named(nodes: pa.Table, ranks: pa.Table) -> pa.Table:
    ids = pa.concat_arrays([c.values for c in nodes["ids"].chunks])
    rank = np.frombuffer(ranks["rank"][0].as_buffer(), "<f8")
    return pa.table({"id": ids, "weight": pa.array(rank)}).filter(pa.array(~np.isnan(rank)))
