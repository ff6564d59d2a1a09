"""The data model: node and edge tables with the few facts Spark cannot read off a schema.

Every class holds DataFrames with fixed column names: ``id``, ``src``, ``dst`` (BIGINT),
``pos`` (BIGINT), ``weight`` and ``value`` (any simple type). Building one checks columns and
types only; checks that must read data are in :mod:`edgeloom.operators.checks`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from edgeloom.functions.edges import endpoints
from edgeloom.functions.values import simple_type


def _require(df: DataFrame, *columns: str) -> None:
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def _require_ids(df: DataFrame, *columns: str) -> None:
    _require(df, *columns)
    for column in columns:
        if not isinstance(df.schema[column].dataType, T.LongType):
            raise TypeError(f"column {column} must be BIGINT, not {df.schema[column].dataType}")


@dataclass(frozen=True)
class Vector:
    """Values by position; positions may have gaps."""

    df: DataFrame  # pos, value

    def __post_init__(self) -> None:
        _require_ids(self.df, "pos")
        _require(self.df, "value")

    @property
    def dtype(self) -> str:
        return simple_type(self.df.schema["value"].dataType)


@dataclass(frozen=True)
class NodeSet:
    """Distinct node ids."""

    df: DataFrame  # id

    def __post_init__(self) -> None:
        _require_ids(self.df, "id")
        object.__setattr__(self, "df", self.df.select("id").distinct())


@dataclass(frozen=True)
class NodeMap:
    """One value per node id."""

    df: DataFrame  # id, weight

    def __post_init__(self) -> None:
        _require_ids(self.df, "id")
        _require(self.df, "weight")

    @property
    def dtype(self) -> str:
        return simple_type(self.df.schema["weight"].dataType)


@dataclass(frozen=True)
class EdgeSet:
    """Edges; duplicates are kept. An undirected table holds each edge in one direction."""

    df: DataFrame  # src, dst
    is_directed: bool = True

    def __post_init__(self) -> None:
        _require_ids(self.df, "src", "dst")


@dataclass(frozen=True)
class EdgeMap:
    """Edges with a weight; duplicates are kept."""

    df: DataFrame  # src, dst, weight
    is_directed: bool = True

    def __post_init__(self) -> None:
        _require_ids(self.df, "src", "dst")
        _require(self.df, "weight")

    @property
    def dtype(self) -> str:
        return simple_type(self.df.schema["weight"].dataType)


class _WithEdges:
    """Facts shared by the two graph classes."""

    edges: DataFrame

    @property
    def is_weighted(self) -> bool:
        return "weight" in self.edges.columns

    @property
    def edge_dtype(self) -> str | None:
        return simple_type(self.edges.schema["weight"].dataType) if self.is_weighted else None


@dataclass(frozen=True)
class Graph(_WithEdges):
    """Nodes and edges. Nodes may include isolated ones; without nodes, all edge ends are taken."""

    edges: DataFrame  # src, dst[, weight]
    nodes: DataFrame | None = None  # id[, weight]
    is_directed: bool = True
    has_node_weights: bool = False

    def __post_init__(self) -> None:
        _require_ids(self.edges, "src", "dst")
        if self.nodes is None:
            if self.has_node_weights:
                raise ValueError("node weights not given")
            object.__setattr__(self, "nodes", endpoints(self.edges))
        _require_ids(self.nodes, "id")
        if self.has_node_weights:
            _require(self.nodes, "weight")

    @property
    def node_dtype(self) -> str | None:
        return simple_type(self.nodes.schema["weight"].dataType) if self.has_node_weights else None


@dataclass(frozen=True)
class BipartiteGraph(_WithEdges):
    """A graph whose nodes fall in two disjoint sides; edges cross between them.

    A side that is not given is made of the ends that the other side doesn't list, whichever way
    the edges are written. Without any side, side 0 is the edges' ``src`` column and side 1 their ``dst``
    column; :func:`edgeloom.operators.checks.violations` lists ids that stand in both.
    """

    edges: DataFrame  # src, dst[, weight]
    nodes0: DataFrame | None = None  # id[, weight]
    nodes1: DataFrame | None = None  # id[, weight]
    is_directed: bool = False
    has_node0_weights: bool = False
    has_node1_weights: bool = False

    def __post_init__(self) -> None:
        _require_ids(self.edges, "src", "dst")
        given = (self.nodes0, self.nodes1)
        for name, end, weighted in (
            ("nodes0", "src", self.has_node0_weights), ("nodes1", "dst", self.has_node1_weights)
        ):
            if getattr(self, name) is None:
                if weighted:
                    raise ValueError(f"weights of {name} not given")
                other = given[1 if name == "nodes0" else 0]
                if other is None:
                    ends = self.edges.select(F.col(end).alias("id")).distinct()
                else:
                    ends = endpoints(self.edges).join(other.select("id"), "id", "left_anti")
                object.__setattr__(self, name, ends)
            _require_ids(getattr(self, name), "id")
            if weighted:
                _require(getattr(self, name), "weight")

    def side(self, number: int) -> DataFrame:
        if number not in (0, 1):
            raise ValueError("a bipartite graph has sides 0 and 1")
        return self.nodes1 if number else self.nodes0
