"""Matrix forms of a graph: coordinate rows and compressed rows, as tables.

``coo(row, col, value)`` and ``csr`` (``offsets(pos, offset)``, ``indices(pos, dst, value)``)
refer to nodes by position in a ``node_list(pos, id)``, the ids in ascending order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeloom.functions.edges import endpoints, symmetrize, whole_edges
from edgeloom.functions.values import SPARK_TYPES
from edgeloom.model import EdgeMap, EdgeSet, Graph
from edgeloom.plans.positions import bucket_width, dense_positions, running_totals
from edgeloom.plans.rounds import written
from edgeloom.plans.skew import lookup, measured_hot_keys


@dataclass(frozen=True)
class Coordinates:
    """Nonzero cells, the node list, and node values where the graph has them."""

    cells: DataFrame  # row, col, value
    node_list: DataFrame  # pos, id
    node_values: DataFrame | None = None  # id, weight


@dataclass(frozen=True)
class CompressedRows:
    """Row ``i`` owns the cells at positions ``offset[i]`` up to ``offset[i + 1]``."""

    offsets: DataFrame  # pos, offset; one row more than there are nodes
    indices: DataFrame  # pos, dst, value
    node_list: DataFrame  # pos, id


def _cells(
    edges: DataFrame, node_list: DataFrame, directed: bool, value: Column, merge: bool = False
) -> DataFrame:
    """Edges as cells; ``merge`` adds up parallel ones first, so fewer rows look up positions."""
    whole = whole_edges(edges)
    whole = whole if directed else symmetrize(whole)
    whole = whole.select("src", "dst", value.alias("value"))
    if merge:
        is_bool = whole.schema["value"].dataType.typeName() == "boolean"
        total = F.max("value") if is_bool else F.sum("value")
        whole = whole.groupBy("src", "dst").agg(total.alias("value"))
    whole, facts = written(whole, rows=F.count("*"))
    places = node_list.select("id", "pos")
    by_src = measured_hot_keys(whole, "src", facts["rows"])
    placed = lookup(whole, "src", places.withColumnRenamed("pos", "row"), by_src, "dst", how="left")
    by_dst = measured_hot_keys(whole, "dst", facts["rows"])
    placed = lookup(placed, "dst", places.withColumnRenamed("pos", "col"), by_dst, "row", how="left")
    unlisted = F.col("row").isNull() | F.col("col").isNull()
    fail = F.raise_error(F.lit("an edge ends at a node that is not listed")).cast("bigint")
    return placed.select(F.when(unlisted, fail).otherwise(F.col("row")).alias("row"), "col", "value")


def edges_to_coo(edges: EdgeSet | EdgeMap, merge: bool = False) -> Coordinates:
    """Cells over the edges' own ends; an edge without a weight becomes 1.0."""
    value = F.col("weight") if isinstance(edges, EdgeMap) else F.lit(1.0)
    table, _ = written(whole_edges(edges.df))  # read for the nodes and for the cells
    node_list = dense_positions(endpoints(table), ["id"])
    return Coordinates(_cells(table, node_list, edges.is_directed, value, merge), node_list)


def graph_to_coo(graph: Graph, merge: bool = False) -> Coordinates:
    """Cells over all nodes, isolated ones too; an edge without a weight becomes true."""
    value = F.col("weight") if graph.is_weighted else F.lit(True)
    node_list = dense_positions(graph.nodes.select("id"), ["id"])
    cells = _cells(graph.edges, node_list, graph.is_directed, value, merge)
    return Coordinates(cells, node_list, graph.nodes if graph.has_node_weights else None)


def edges_from_coo(
    coo: Coordinates, directed: bool = True, weighted: bool = True
) -> EdgeSet | EdgeMap:
    """Positions back to ids. An undirected matrix holds each edge twice: one is kept."""
    cells, facts = written(coo.cells, rows=F.count("*"))
    ids = coo.node_list.select(F.col("pos").alias("key"), F.col("id").alias("node"))
    by_row = measured_hot_keys(cells, "row", facts["rows"])
    by_col = measured_hot_keys(cells, "col", facts["rows"])
    src = ids.select(F.col("key").alias("id"), F.col("node").alias("src"))
    dst = ids.select(F.col("key").alias("id"), F.col("node").alias("dst"))
    edges = lookup(cells, "row", src, by_row, "col")
    edges = lookup(edges, "col", dst, by_col, "row")
    if not directed:
        edges = edges.where(F.col("src") <= F.col("dst"))
    if not weighted:
        return EdgeSet(edges.select("src", "dst"), directed)
    return EdgeMap(edges.select("src", "dst", F.col("value").alias("weight")), directed)


def graph_from_coo(
    coo: Coordinates, directed: bool = True, weighted: bool = True, edge_dtype: str | None = None
) -> Graph:
    """As :func:`edges_from_coo` with a cast to ``edge_dtype`` and all listed nodes kept."""
    edges = edges_from_coo(coo, directed, weighted).df
    if weighted and edge_dtype is not None:
        cast = F.col("weight").cast(SPARK_TYPES[edge_dtype])
        edges = edges.select("src", "dst", cast.alias("weight"))
    if coo.node_values is None:
        return Graph(edges, coo.node_list.select("id"), directed)
    return Graph(edges, coo.node_values, directed, has_node_weights=True)


def edges_to_csr(edges: EdgeSet | EdgeMap) -> CompressedRows:
    """Compressed rows; parallel edges become one cell with their sum (bool: any)."""
    return _compress(edges_to_coo(edges, merge=True))


def graph_to_csr(graph: Graph) -> CompressedRows:
    return _compress(graph_to_coo(graph, merge=True))


def _compress(coo: Coordinates) -> CompressedRows:
    """From merged cells. Numbering all of them by (row, col) also serves a row that holds most."""
    placed = dense_positions(coo.cells, ["row", "col"])
    indices = placed.select("pos", F.col("col").alias("dst"), "value")
    nodes = coo.node_list.count()
    per_row = placed.groupBy(F.col("row").alias("pos")).agg(F.count("*").alias("n"))
    spark = coo.node_list.sparkSession
    counted = (
        coo.node_list.select("pos").join(per_row, "pos", "left").fillna(0, ["n"])
        .union(spark.range(nodes, nodes + 1).select("id", F.lit(0).cast("bigint")))
    )
    offsets = running_totals(counted, "pos", "n", "offset", nodes + 1)
    return CompressedRows(offsets.select("pos", "offset"), indices, coo.node_list)


def edges_from_csr(
    offsets: DataFrame, indices: DataFrame, node_list: DataFrame | None = None,
    directed: bool = True,
) -> EdgeSet | EdgeMap:
    """Give every cell its row: the last non-empty row that starts at or before it.

    No row is opened into a sequence, so one row may own any share of the cells. Cells and
    row starts are cut into buckets of positions and filled forward inside a bucket; the last
    start of each earlier bucket, one row per bucket, carries over.
    """
    upper = offsets.select((F.col("pos") - 1).alias("pos"), F.col("offset").alias("next"))
    starts = (
        offsets.join(upper, "pos").where(F.col("offset") < F.col("next"))
        .select(F.col("offset").alias("pos"), F.col("pos").alias("row"))
    )
    width = bucket_width(indices, indices.count())
    bucket = F.floor(F.col("pos") / width).alias("_bucket")
    starts = starts.select("*", bucket)
    cells = indices.select("*", bucket).join(starts.drop("_bucket"), "pos", "left")

    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Grouped by cells, so that buckets inside one long row are listed as well.
    carried = (
        cells.groupBy("_bucket").agg(F.max("row").alias("_last"))
        .select("_bucket", F.max("_last").over(before).alias("_carried"))
    )
    inside = Window.partitionBy("_bucket").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        cells.withColumn("_filled", F.last("row", ignorenulls=True).over(inside))
        .join(F.broadcast(carried), "_bucket")
        .withColumn("src", F.coalesce("_filled", "_carried"))
    )
    weighted = "value" in indices.columns
    columns = [F.col("src"), F.col("dst")]
    columns += [F.col("value").alias("weight")] if weighted else []
    edges = filled.select(*columns)
    if node_list is not None:
        names = ["row", "col"] + (["value"] if weighted else [])
        return edges_from_coo(Coordinates(edges.toDF(*names), node_list), directed, weighted)
    if not directed:
        edges = edges.where(F.col("src") <= F.col("dst"))
    return EdgeMap(edges, directed) if weighted else EdgeSet(edges, directed)
