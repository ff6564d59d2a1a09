"""Property graphs: node and edge tables with weights, read and written as Parquet folders.

A graph is a folder with ``edges``, ``nodes`` (or ``nodes0`` and ``nodes1``) and ``facts``,
a one-row table of the flags that the schemas cannot show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from edgeloom.functions.values import SPARK_TYPES, simple_type
from edgeloom.model import BipartiteGraph, Graph
from edgeloom.operators.checks import require_valid
from edgeloom.sources.tables import edges_from_table


def _nodes(df: DataFrame | None, key: str, weight: str | None) -> DataFrame | None:
    if df is None:
        return None
    columns = [F.col(key).cast("bigint").alias("id")]
    columns += [F.col(weight).alias("weight")] if weight else []
    return df.select(*columns)


def load_graph(
    edges: DataFrame, nodes: DataFrame | None = None, src: str = "src", dst: str = "dst",
    weight: str | None = None, node: str = "id", node_weight: str | None = None,
    directed: bool = True, validate: bool = True,
) -> Graph:
    """A graph from an edge table and, optionally, a node table that may list isolated nodes."""
    graph = Graph(
        edges_from_table(edges, src, dst, weight, directed).df,
        _nodes(nodes, node, node_weight), directed, node_weight is not None,
    )
    return require_valid(graph) if validate else graph


def load_bipartite(
    edges: DataFrame, nodes0: DataFrame | None = None, nodes1: DataFrame | None = None,
    src: str = "src", dst: str = "dst", weight: str | None = None, node: str = "id",
    node0_weight: str | None = None, node1_weight: str | None = None,
    directed: bool = False, validate: bool = True,
) -> BipartiteGraph:
    graph = BipartiteGraph(
        edges_from_table(edges, src, dst, weight, directed).df,
        _nodes(nodes0, node, node0_weight), _nodes(nodes1, node, node1_weight),
        directed, node0_weight is not None, node1_weight is not None,
    )
    return require_valid(graph) if validate else graph


def _dtype(nodes: DataFrame) -> str | None:
    return simple_type(nodes.schema["weight"].dataType) if "weight" in nodes.columns else None


def _typed(df: DataFrame, dtype: str | None) -> DataFrame:
    if dtype is None:
        return df.drop("weight")
    return df.withColumn("weight", F.col("weight").cast(SPARK_TYPES[dtype]))


def save_graph(graph: Graph, path: str, mode: str = "error") -> None:
    """Write all edges and all nodes, weights widened to their simple type."""
    spark = graph.edges.sparkSession
    _typed(graph.edges, graph.edge_dtype).write.mode(mode).parquet(f"{path}/edges")
    _typed(graph.nodes, _dtype(graph.nodes)).write.mode(mode).parquet(f"{path}/nodes")
    facts = Row(is_directed=graph.is_directed, has_node_weights=graph.has_node_weights)
    spark.createDataFrame([facts]).write.mode(mode).parquet(f"{path}/facts")


def read_graph(spark: SparkSession, path: str) -> Graph:
    facts = spark.read.parquet(f"{path}/facts").first().asDict()
    return Graph(
        spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/nodes"), **facts
    )


def save_bipartite(graph: BipartiteGraph, path: str, mode: str = "error") -> None:
    spark = graph.edges.sparkSession
    _typed(graph.edges, graph.edge_dtype).write.mode(mode).parquet(f"{path}/edges")
    _typed(graph.nodes0, _dtype(graph.nodes0)).write.mode(mode).parquet(f"{path}/nodes0")
    _typed(graph.nodes1, _dtype(graph.nodes1)).write.mode(mode).parquet(f"{path}/nodes1")
    facts = Row(
        is_directed=graph.is_directed, has_node0_weights=graph.has_node0_weights,
        has_node1_weights=graph.has_node1_weights,
    )
    spark.createDataFrame([facts]).write.mode(mode).parquet(f"{path}/facts")


def read_bipartite(spark: SparkSession, path: str) -> BipartiteGraph:
    facts = spark.read.parquet(f"{path}/facts").first().asDict()
    return BipartiteGraph(
        spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/nodes0"),
        spark.read.parquet(f"{path}/nodes1"), **facts,
    )
