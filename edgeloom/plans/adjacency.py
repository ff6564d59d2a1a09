"""Edges laid out for a loop: written once, split at hub nodes, kept partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgeloom.plans.rounds import Rounds, partitions_for, setting
from edgeloom.plans.skew import measured_hot_keys


class Adjacency:
    """Edges partitioned by ``key``, the end at which a state table meets them each round.

    The edges themselves do not move again; only the state, a row per node, comes to them.
    The edges of a hub are spread over several partitions by ``by``. They are written first,
    so a lost block is read again rather than derived again.
    """

    def __init__(self, rounds: Rounds, edges: DataFrame, key: str = "src", by: str = "dst"):
        edges, facts = rounds.written(edges, rows=F.count("*"))
        self.key = key
        self.rows = facts["rows"]
        self.hot = measured_hot_keys(edges, key, self.rows)
        self._on = [key]
        if self.hot.frame is not None:
            self._on = [key, "_part"]
            edges = self.hot.spread(edges, key, F.col(by))
        laid = edges.repartition(partitions_for(edges.sparkSession, self.rows), *self._on)
        # Sorted as well, so that a merge join only sorts the state.
        self.edges = rounds.keep(laid.sortWithinPartitions(*self._on))

    def reach(self, state: DataFrame, rows: int) -> DataFrame:
        """Join ``state(id, ...)``, of at most ``rows`` rows, to the edges that start at its ids.

        A small state is broadcast; otherwise it is shuffled to where the edges are.
        """
        renamed = state.withColumnRenamed("id", self.key)
        if rows <= setting(state.sparkSession, "broadcastRows"):
            return self.edges.join(F.broadcast(renamed), self.key)
        if self.hot.frame is not None:
            renamed = self.hot.replicate(renamed, self.key)
        return self.edges.join(renamed.hint("merge"), self._on)
