"""Sums along the edges of a loop, with nodes and edges packed in blocks.

Nodes are numbered in the order of a hash of their ids and cut into groups of one size, so that a group's
values travel as one row of bytes. The edges that leave a group are one bin, packed by the groups that they enter, and a
group that has far more edges than others has several bins. Bins stay where they are. Each round the
values of a group come to its bins, a bin adds up what it sends to each node, and the sums go to the groups of these nodes:
the shuffled bytes are at most 12 for an edge.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from edgeloom.plans.positions import dense_positions
from edgeloom.plans.rounds import Rounds, setting, shuffle_partitions
from edgeloom.plans.skew import HotKeys, hot_keys, lookup

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _bytes(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _numbers(column: pa.ChunkedArray, row: int, kind: str) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), kind)


class Blocks:
    """Groups of the ``nodes(id, out, ...)`` and bins of the ``edges(src, dst)``.

    ``nodes`` and ``edges`` are written tables of the given measured rows. Nodes are distinct and hold all ends of edges, which
    ``sent`` and ``met`` count for each node. Edges are distinct.
    """

    def __init__(self, rounds: Rounds, nodes: DataFrame, n: int, edges: DataFrame, rows: int):
        spark = edges.sparkSession
        per_task = min(shuffle_partitions(spark), math.ceil(rows / setting(spark, "taskRows")))
        self.count = max(1, min(n, max(math.ceil(rows / setting(spark, "rowsPerPartition")), per_task)))
        self.width = max(1, math.ceil(n / self.count))
        self.nodes = dense_positions(nodes, [F.xxhash64("id"), "id"])
        group = F.floor(F.col("pos") / self.width)
        self.hot = self._several_bins(self.nodes.groupBy(group.alias("group")).agg(F.sum("sent").alias("n")), rows)
        places = self.nodes.select("id", "pos")
        by_src, by_dst = (
            hot_keys(nodes.select(F.col("id").alias(end), F.col(name).alias("n")), end, rows)
            for end, name in (("src", "sent"), ("dst", "met"))
        )
        placed = lookup(edges, "src", places.withColumnRenamed("pos", "row"), by_src, "dst", rows=n)
        placed = lookup(placed, "dst", places.withColumnRenamed("pos", "col"), by_dst, "row", rows=n)
        cells = placed.select(
            F.floor(F.col("row") / self.width).alias("group"), F.pmod("row", F.lit(self.width)).cast("int").alias("src"), "col",
        )
        binned = self.hot.spread(cells, "group", F.col("col")).select(self._bin(), "src", "col")
        packed = binned.groupBy("bin").applyInArrow(_packer(self.width), "bin bigint, group bigint, src binary, starts binary, dst binary")
        # Dealt again, as rows that Python hands back aren't known to be partitioned.
        self.bins = rounds.keep(packed.repartition(max(self.count, min(shuffle_partitions(spark), 2 * self.count)), "bin"))

    def _several_bins(self, counts: DataFrame, rows: int) -> HotKeys:
        """Groups with more than twice the edges of an average one, which are fewer than half of the groups."""
        most = max(1, 2 * math.ceil(rows / self.count))
        listed = counts.where(F.col("n") > most).select(
            F.col("group").alias("_key"), F.ceil(F.col("n") / most).alias("_parts")
        )
        found = listed.collect()
        return HotKeys(counts.sparkSession.createDataFrame(found, listed.schema)) if found else HotKeys()

    def _bin(self):
        return (F.col("group") + F.lit(self.count).cast("bigint") * F.col("_part")).alias("bin")

    def grouped(self, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        """``work`` over the nodes of each group, with their ``pos``, in any order."""
        group = F.floor(F.col("pos") / self.width)
        return self.nodes.withColumn("group", group).groupBy("group").applyInArrow(work, schema)

    def sums(self, values: DataFrame) -> DataFrame:
        """``group, dst, value``: what the bins send, from ``values(group, value)`` of float64 for each node of a group.

        A row holds the places of nodes within their group, each once, and the sums of the values over the edges from one bin.
        """
        sent = self.hot.replicate(values, "group").select(self._bin(), "value")
        met = self.bins.groupBy("bin").cogroup(sent.groupBy("bin"))
        return met.applyInArrow(_add, "group bigint, dst binary, value binary")


def _packer(width: int) -> Callable[[pa.Table], pa.Table]:
    def pack(edges: pa.Table) -> pa.Table:
        src, col = edges["src"].to_numpy(), edges["col"].to_numpy()
        order = np.argsort(col, kind="stable")
        src, col = src[order], col[order]
        first = np.flatnonzero(np.diff(col, prepend=-1))  # of each node's edges
        nodes = col[first]
        cuts = np.flatnonzero(np.diff(nodes // width, prepend=-1))  # first node of each group
        ends = [*cuts[1:], len(nodes)]
        stops = np.append(first, len(col))
        groups = nodes[cuts] // width
        return pa.table({
            "bin": pa.array(np.full(len(cuts), edges["bin"][0].as_py())),
            "group": pa.array(groups),
            "src": _bytes([src[stops[a]:stops[b]].astype("<i4") for a, b in zip(cuts, ends)]),
            "starts": _bytes([(first[a:b] - first[a]).astype("<i4") for a, b in zip(cuts, ends)]),
            "dst": _bytes([(nodes[a:b] % width).astype("<i4") for a, b in zip(cuts, ends)]),
        })

    return pack


def _add(bins: pa.Table, sent: pa.Table) -> pa.Table:
    values = _numbers(sent["value"], 0, "<f8") if bins.num_rows else None
    sums = [
        np.add.reduceat(values[_numbers(bins["src"], row, "<i4")], _numbers(bins["starts"], row, "<i4"))
        for row in range(bins.num_rows)
    ]
    return pa.table({"group": bins["group"], "dst": bins["dst"], "value": _bytes(sums)})


def total(found: pa.Table, width: int) -> np.ndarray:
    """For each node of a group, the sum of what the bins sent to it, from rows of :meth:`Blocks.sums`."""
    out = np.zeros(width)
    for row in range(found.num_rows):
        out[_numbers(found["dst"], row, "<i4")] += _numbers(found["value"], row, "<f8")
    return out
