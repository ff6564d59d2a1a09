"""Triangle counting over a degree-ordered orientation (Schank and Wagner, 2005)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import neighbour_pairs, whole_edges
from edgeloom.model import Graph
from edgeloom.plans.rounds import Rounds, written
from edgeloom.plans.skew import hot_keys, lookup, pairs_within


def triangle_table(graph: Graph) -> DataFrame:
    """One row ``triangles``: distinct triangles, directions and self-loops ignored.

    Every edge points to its end of higher degree, which leaves no node with more than
    sqrt(2 * edges) outgoing edges: hubs have almost none. Each triangle is then met once, as
    two edges out of its lowest node that the third edge closes.
    """
    with Rounds(graph.edges.sparkSession) as rounds:
        count = F.count("*")
        pairs, facts = rounds.written(neighbour_pairs(whole_edges(graph.edges.select("src", "dst"))), rows=count)
        ends = pairs.select(F.explode(F.array("src", "dst")).alias("id"))
        degrees, nodes = rounds.written(ends.groupBy("id").agg(count.alias("n")), rows=count)
        hot = hot_keys(degrees, "id", 2 * facts["rows"])
        src, dst = (degrees.withColumnRenamed("n", name) for name in ("src_n", "dst_n"))
        ranked = lookup(pairs, "src", src, hot, "dst", rows=nodes["rows"])
        ranked = lookup(ranked, "dst", dst, hot, "src", rows=nodes["rows"])
        up = F.struct("src_n", "src") < F.struct("dst_n", "dst")
        oriented, _ = rounds.written(ranked.select(
            F.when(up, F.col("src")).otherwise(F.col("dst")).alias("low"),
            F.when(up, F.col("dst")).otherwise(F.col("src")).alias("high"),
        ))
        wedges = (
            pairs_within(oriented, "low", "high")
            .groupBy(F.col("first").alias("src"), F.col("second").alias("dst")).agg(count.alias("n"))
        )
        closed = wedges.join(pairs, ["src", "dst"])
        return written(closed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("triangles")))[0]


def triangle_count(graph: Graph) -> int:
    return triangle_table(graph).first()["triangles"]
