"""The registered queries: each takes a session and the folder of the tables."""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from edgeloom.functions.edges import endpoints
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet
from edgeloom.operators import checks, diff, edges as edge_ops, lookups, nodes as node_ops
from edgeloom.operators.betweenness import betweenness
from edgeloom.operators.bfs import bfs_iter
from edgeloom.operators.components import connected_components
from edgeloom.operators.louvain import louvain_community, modularity_table
from edgeloom.operators.pagerank import pagerank
from edgeloom.operators.profile import profile
from edgeloom.operators.projection import graph_projection
from edgeloom.operators.strong import strongly_connected_components
from edgeloom.operators.triangles import triangle_table
from edgeloom.sources import matrices, tables
from edgeloom.sources.property_graphs import (
    load_bipartite, load_graph, read_bipartite, read_graph, save_bipartite, save_graph,
)
from edgeloom.plans.positions import dense_positions
from edgeloom.plans.rounds import shared_folder
from queries import graphs as g

QUERIES = {}


def query(func):
    QUERIES[func.__name__] = func
    return func


def _succession_set(spark: SparkSession, folder: str) -> EdgeSet:
    return edge_ops.edge_set_from_map(g.succession(spark, folder))


def _part_ids(spark: SparkSession, folder: str) -> NodeSet:
    return tables.node_set_from_table(g.table(spark, folder, "lineitem"), "l_partkey")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return tables.vector_from_array(g.table(spark, folder, "embeddings"), "embedding", ["vec_id"])


# Sources and sinks


@query
def edges_from_lines(spark, folder):
    edges = tables.edges_from_table(
        g.table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", "l_quantity"
    )
    return tables.edges_to_table(edges, "order_id", "part_id", "quantity")


@query
def edge_set_from_orders(spark, folder):
    edges = tables.edges_from_table(g.table(spark, folder, "orders"), "o_custkey", "o_orderkey")
    return tables.edges_to_table(edges, "customer", "order_id")


@query
def node_map_typed_sizes(spark, folder):
    sizes = tables.node_map_from_table(g.table(spark, folder, "part"), "p_partkey", "p_size")
    return tables.node_map_to_table(sizes, "part", "size", typed=True)


@query
def node_set_ordered_parts(spark, folder):
    return tables.node_set_to_table(_part_ids(spark, folder), "part")


@query
def vector_from_embedding(spark, folder):
    return _vectors(spark, folder).withColumn("value", F.round("value", 6).cast("double"))


@query
def dense_positions_of_prices(spark, folder):
    placed = dense_positions(g.prices(spark, folder).df, ["weight", "id"])
    return placed.select("pos", "id")


@query
def coo_of_succession(spark, folder):
    return matrices.edges_to_coo(g.succession(spark, folder)).cells


@query
def coo_of_places_undirected(spark, folder):
    graph = g.places(spark, folder)
    cells = matrices.graph_to_coo(Graph(graph.edges, graph.nodes, is_directed=False)).cells
    return cells.withColumnRenamed("value", "is_edge")


@query
def coo_roundtrip(spark, folder):
    graph = g.transitions(spark, folder)
    back = matrices.graph_from_coo(matrices.graph_to_coo(graph), edge_dtype="int")
    return back.edges


@query
def csr_offsets(spark, folder):
    return matrices.edges_to_csr(g.succession(spark, folder)).offsets


@query
def csr_indices(spark, folder):
    return matrices.edges_to_csr(g.succession(spark, folder)).indices


@query
def csr_roundtrip(spark, folder):
    csr = matrices.edges_to_csr(g.succession(spark, folder))
    return matrices.edges_from_csr(csr.offsets, csr.indices, csr.node_list).df


@query
def property_graph_nodes(spark, folder):
    graph = load_graph(
        g.succession(spark, folder).df, g.table(spark, folder, "part"), weight="weight",
        node="p_partkey", node_weight="p_retailprice",
    )
    return graph.nodes


@query
def bipartite_sides(spark, folder):
    bought = g.purchases(spark, folder)
    graph = load_bipartite(bought.edges, bought.nodes0, bought.nodes1)
    side0 = graph.nodes0.select("id", F.lit(0).alias("side"))
    return side0.union(graph.nodes1.select("id", F.lit(1)))


# Constructors, checks, lookups, profiles


@query
def graph_build_nodes(spark, folder):
    return edge_ops.build_graph(g.succession(spark, folder)).nodes


@query
def graph_violations(spark, folder):
    """Customers of orders are no order numbers with lines unless the numbers coincide."""
    orders = tables.edges_from_table(g.table(spark, folder, "orders"), "o_custkey", "o_orderkey")
    known = tables.node_set_from_table(g.table(spark, folder, "lineitem"), "l_orderkey")
    return checks.violations(Graph(orders.df, known.df))


@query
def bipartite_violations(spark, folder):
    """Customer and part numbers overlap when they are used as they are."""
    bought = g.purchases(spark, folder)
    parts = bought.nodes1.select((-F.col("id") - 1).alias("id"))
    edges = bought.edges.select("src", (-F.col("dst") - 1).alias("dst"))
    return checks.violations(load_bipartite(edges, bought.nodes0, parts, validate=False))


@query
def vector_violations(spark, folder):
    """Line numbers as positions repeat; events numbered by id do not."""
    lines = tables.vector_from_table(
        g.table(spark, folder, "lineitem"), "l_linenumber", "l_quantity"
    )
    events = tables.vector_from_table(g.table(spark, folder, "events"), "event_id", "value")
    return checks.violations(lines).union(checks.violations(events))


@query
def contains_batch(spark, folder):
    asked = g.table(spark, folder, "lineitem").select("l_orderkey")
    return lookups.contains(g.prices(spark, folder), asked)


@query
def node_map_get(spark, folder):
    return lookups.get(g.prices(spark, folder), g.table(spark, folder, "lineitem").select("l_orderkey"))


@query
def vector_length(spark, folder):
    events = tables.vector_from_table(g.table(spark, folder, "events"), "event_id", "value")
    return lookups.vector_length(events)


@query
def num_nodes(spark, folder):
    sizes = {
        "edges": _succession_set(spark, folder),
        "map": g.prices(spark, folder),
        "set": _part_ids(spark, folder),
        "graph": g.places(spark, folder),
    }
    rows = [lookups.num_nodes(x).select(F.lit(name).alias("of"), "num_nodes") for name, x in sizes.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query
def edge_properties(spark, folder):
    return profile(g.succession(spark, folder))


@query
def node_map_properties(spark, folder):
    return profile(g.prices(spark, folder))


@query
def graph_properties(spark, folder):
    balance = tables.edges_from_table(
        g.table(spark, folder, "customer"), "c_custkey", "c_nationkey", "c_acctbal"
    )
    return profile(Graph(balance.df))


@query
def bipartite_properties(spark, folder):
    return profile(g.purchases(spark, folder))


# Differences


@query
def vector_diff(spark, folder):
    """Event values against whole-number values of all but the clicks."""
    events = g.table(spark, folder, "events")
    left = tables.vector_from_table(events, "event_id", "value")
    right = tables.vector_from_table(
        events.where("event_type <> 'click'").withColumn("value", F.floor("value").cast("double")),
        "event_id", "value",
    )
    return diff.vector_diff(left, right)


@query
def node_map_diff(spark, folder):
    """Prices against prices with a rounding error far below and, for large parts, above tolerance."""
    prices = g.prices(spark, folder)
    part = g.table(spark, folder, "part")
    factor = F.when(F.col("p_size") > 25, 1.5).otherwise(1.0 + 1e-12)
    other = NodeMap(part.select(
        F.col("p_partkey").alias("id"), (F.col("p_retailprice") * factor).alias("weight")
    ))
    return diff.node_map_diff(prices, other).select("id", "issue", "left_value", "right_value")


@query
def node_set_diff(spark, folder):
    orders = tables.node_set_from_table(g.table(spark, folder, "orders"), "o_orderkey")
    return diff.node_set_diff(orders, tables.node_set_from_table(
        g.table(spark, folder, "lineitem"), "l_orderkey"))


@query
def edge_set_diff(spark, folder):
    """Order lines as they are against distinct ones."""
    lines = tables.edges_from_table(g.table(spark, folder, "lineitem"), "l_suppkey", "l_partkey").df
    return diff.edge_set_diff(EdgeSet(lines), EdgeSet(lines.distinct()))


@query
def edge_map_diff(spark, folder):
    """Parallel edges: quantities between suppliers and parts, with and without returned lines."""
    lines = g.table(spark, folder, "lineitem")
    left = tables.edges_from_table(lines, "l_suppkey", "l_partkey", "l_quantity")
    right = tables.edges_from_table(
        lines.where("l_returnflag <> 'R'"), "l_suppkey", "l_partkey", "l_quantity"
    )
    return diff.edge_map_diff(left, right)


@query
def graph_diff(spark, folder):
    """The succession of all lines against that of edges seen once."""
    graph = g.succession_graph(spark, folder)
    return diff.graph_diff(graph, Graph(graph.edges.where("weight = 1")))


@query
def bipartite_diff(spark, folder):
    """All purchases against those not returned; undirected edges are listed smaller id first."""
    bought = g.purchases(spark, folder)
    kept = g.purchases(spark, folder, "l_returnflag <> 'R'")
    return diff.bipartite_diff(bought, load_bipartite(kept.edges, validate=False))


# Node and edge operators


@query
def nodeset_from_vector(spark, folder):
    parts = tables.vector_from_table(g.table(spark, folder, "lineitem"), "l_orderkey", "l_partkey")
    return node_ops.node_set_from_vector(parts).df


@query
def nodemap_sort(spark, folder):
    return node_ops.sort(g.prices(spark, folder)).df


@query
def nodemap_sort_topk(spark, folder):
    """The ten dearest parts."""
    return node_ops.sort(g.prices(spark, folder), ascending=False, limit=10).df


@query
def nodemap_select(spark, folder):
    orders = tables.node_set_from_table(g.table(spark, folder, "orders"), "o_custkey")
    return node_ops.select(g.prices(spark, folder), orders).df


@query
def nodemap_filter(spark, folder):
    return node_ops.filter_nodes(g.prices(spark, folder), lambda price: price >= 950).df


@query
def nodemap_apply(spark, folder):
    mapped = node_ops.apply(g.prices(spark, folder), lambda price: F.round(price * 1.19, 4))
    return mapped.df


@query
def nodemap_apply_scalar(spark, folder):
    """The same operator with a Python function over single values."""
    mapped = node_ops.apply(
        g.prices(spark, folder), lambda price: int(price) % 7, return_type="bigint", scalar=True
    )
    return mapped.df


@query
def nodemap_reduce(spark, folder):
    return node_ops.reduce(g.prices(spark, folder), "max")


@query
def nodemap_to_nodeset(spark, folder):
    return node_ops.node_set_from_map(g.prices(spark, folder)).df


@query
def choose_random(spark, folder):
    """Which ids are drawn is chance; how many, that they differ, and that they are members is not."""
    drawn = node_ops.choose_random(_part_ids(spark, folder), 100, seed=7).df
    known = _part_ids(spark, folder).df.withColumn("member", F.lit(1))
    return drawn.join(known, "id", "left").agg(
        F.count("*").alias("drawn"), F.count_distinct("id").alias("distinct_ids"), F.count("member").alias("members")
    )


@query
def edgemap_from_edgeset(spark, folder):
    return edge_ops.edge_map_from_edge_set(_succession_set(spark, folder), 2.5).df


@query
def edgemap_to_edgeset(spark, folder):
    return _succession_set(spark, folder).df


@query
def assign_uniform_weight(spark, folder):
    return edge_ops.assign_uniform_weight(g.transitions(spark, folder), 1).edges


@query
def filter_edges(spark, folder):
    return edge_ops.filter_edges(g.transitions(spark, folder), lambda w: w >= 3).edges


@query
def filter_edges_scalar(spark, folder):
    kept = edge_ops.filter_edges(g.transitions(spark, folder), lambda w: w < 3, scalar=True)
    return kept.edges


@query
def aggregate_edges(spark, folder):
    return edge_ops.aggregate_edges(g.succession_graph(spark, folder), "sum", 0.0, in_edges=True).df


# Algorithms


def _labels(labels: NodeMap) -> DataFrame:
    return labels.df.select("id", F.col("weight").alias("component"))


@query
def connected_components_succession(spark, folder):
    return _labels(connected_components(g.succession_graph(spark, folder)))


@query
def connected_components_places(spark, folder):
    return _labels(connected_components(g.places(spark, folder)))


@query
def connected_components_transitions(spark, folder):
    return _labels(connected_components(g.transitions(spark, folder), include_isolated=True))


@query
def strong_components_succession(spark, folder):
    return _labels(strongly_connected_components(g.succession_graph(spark, folder)))


@query
def strong_components_repeated(spark, folder):
    """Strong components of the steps seen more than once."""
    graph = edge_ops.filter_edges(g.succession_graph(spark, folder), "weight >= 2")
    return _labels(strongly_connected_components(graph))


@query
def strong_components_transitions(spark, folder):
    return _labels(strongly_connected_components(g.transitions(spark, folder)))


@query
def strong_components_places(spark, folder):
    return _labels(strongly_connected_components(g.places(spark, folder)))


def _ranks(ranks: NodeMap) -> DataFrame:
    return ranks.df.select("id", F.round("weight", 9).alias("rank"))


@query
def pagerank_succession(spark, folder):
    return _ranks(pagerank(g.succession_graph(spark, folder), 0.85, 10, 0.0))


@query
def pagerank_places(spark, folder):
    return _ranks(pagerank(g.places(spark, folder), 0.85, 4, 0.0))


@query
def bfs_succession(spark, folder):
    return bfs_iter(g.succession_graph(spark, folder), 0).df


@query
def bfs_places_undirected(spark, folder):
    """From the first region outwards over its nations to all orders."""
    graph = g.places(spark, folder)
    return bfs_iter(Graph(graph.edges, graph.nodes, is_directed=False), 4).df


@query
def bfs_places_depth(spark, folder):
    graph = g.places(spark, folder)
    return bfs_iter(Graph(graph.edges, graph.nodes, is_directed=False), 4, depth_limit=2).df


@query
def triangle_count_succession(spark, folder):
    return triangle_table(g.succession_graph(spark, folder))


@query
def triangle_count_transitions(spark, folder):
    return triangle_table(g.transitions(spark, folder))


@query
def projection_customers(spark, folder):
    return graph_projection(g.purchases(spark, folder), 0).edges


@query
def projection_parts(spark, folder):
    return graph_projection(g.purchases(spark, folder), 1).edges


@query
def modularity_of_users(spark, folder):
    """The states of one user as a community."""
    users = g.event_states(spark, folder)
    labels = NodeMap(users.select(F.col("pos").alias("id"), F.col("user_id").alias("weight")))
    table = modularity_table(g.transitions(spark, folder), labels)
    return table.select(F.round("modularity", 9).alias("modularity"))


@query
def modularity_of_part_sizes(spark, folder):
    sizes = tables.node_map_from_table(g.table(spark, folder, "part"), "p_partkey", "p_size")
    table = modularity_table(g.succession_graph(spark, folder), sizes)
    return table.select(F.round("modularity", 9).alias("modularity"))


def _louvain_quality(spark, graph: Graph, other: NodeMap) -> DataFrame:
    """One row on the outcome: sizes and whether it keeps what the operator promises.

    Labels depend on the order of moves, so the promises are compared: labels are the smallest ids
    of their communities, the score is that of the labels and not below that of the partition ``other``.
    """
    labels, score = louvain_community(graph)
    own = modularity_table(graph, labels).first()["modularity"]
    least = modularity_table(graph, other).first()["modularity"]
    smallest = labels.df.groupBy("weight").agg(F.min("id").alias("low"))
    unnamed = smallest.where("low <> weight").count()
    touched = endpoints(graph.edges)
    joined = labels.df.join(touched, "id", "left_anti").where("id <> weight").count()
    return labels.df.agg(
        F.count("*").alias("labelled"), F.count_distinct("id").alias("distinct_ids"),
        F.lit(unnamed).cast("bigint").alias("misnamed"), F.lit(joined).cast("bigint").alias("isolated_joined"),
        F.lit(abs(score - own) < 1e-9).alias("score_is_own"), F.lit(score >= least - 1e-9).alias("score_is_high"),
    )


@query
def louvain_transitions_quality(spark, folder):
    """Not below the partition by users."""
    users = g.event_states(spark, folder)
    by_user = NodeMap(users.select(F.col("pos").alias("id"), F.col("user_id").alias("weight")))
    return _louvain_quality(spark, g.transitions(spark, folder), by_user)


@query
def louvain_places_quality(spark, folder):
    """Not below the partition in which each node is with the nation or region it belongs to, or alone."""
    graph = g.places(spark, folder)
    up = graph.edges.select(F.col("src").alias("id"), F.col("dst").alias("weight"))
    roots = graph.nodes.select("id").join(up.select("id"), "id", "left_anti").select("id", F.col("id").alias("weight"))
    return _louvain_quality(spark, graph, NodeMap(up.union(roots)))


# Further sources, checks and profiles


def _weighted_purchases(spark, folder):
    """Purchases with balances and prices as node weights."""
    bought = g.purchases(spark, folder)
    customers = g.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("weight"))
    parts = g.table(spark, folder, "part").select((-F.col("p_partkey") - 1).alias("id"), F.col("p_retailprice").alias("weight"))
    return BipartiteGraph(bought.edges, customers, parts, False, True, True)


def _orders_of_all_customers(spark, folder) -> DataFrame:
    """Customers with their orders; one without any has a null order."""
    orders = g.table(spark, folder, "orders")
    return g.table(spark, folder, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")


def _suppliers_by_customer(spark, folder) -> DataFrame:
    """Customers with the supplier of the same number, null if there is none."""
    suppliers = g.table(spark, folder, "supplier")
    return g.table(spark, folder, "customer").join(suppliers, F.col("c_custkey") == F.col("s_suppkey"), "left")


def _saved(spark) -> str:
    return f"{shared_folder(spark)}/saved-{uuid.uuid4().hex}"


@query
def property_graph_saved(spark, folder):
    path = _saved(spark)
    graph = load_graph(
        g.succession(spark, folder).df, g.table(spark, folder, "part"), weight="weight",
        node="p_partkey", node_weight="p_retailprice",
    )
    save_graph(graph, path)
    back = read_graph(spark, path)
    return back.edges.join(back.nodes.select(F.col("id").alias("src"), F.col("weight").alias("price")), "src")


@query
def bipartite_saved(spark, folder):
    path = _saved(spark)
    save_bipartite(_weighted_purchases(spark, folder), path)
    back = read_bipartite(spark, path)
    side0 = back.nodes0.select("id", "weight", F.lit(back.has_node0_weights).alias("weighted"))
    return side0.union(back.nodes1.select("id", "weight", F.lit(back.has_node1_weights)))


@query
def coo_roundtrip_undirected(spark, folder):
    graph = g.places(spark, folder)
    whole = matrices.graph_to_coo(Graph(graph.edges, graph.nodes, is_directed=False))
    return matrices.edges_from_coo(whole, directed=False, weighted=False).df


@query
def coo_node_values(spark, folder):
    graph = edge_ops.build_graph(g.succession(spark, folder), g.prices(spark, folder))
    return matrices.graph_from_coo(matrices.graph_to_coo(graph)).nodes


@query
def graph_build_weighted_nodes(spark, folder):
    return edge_ops.build_graph(g.succession(spark, folder), g.prices(spark, folder)).nodes


@query
def edge_violations(spark, folder):
    """Customers whose number no supplier has give edges without an end."""
    edges = tables.edges_from_table(_suppliers_by_customer(spark, folder), "c_custkey", "s_suppkey", "c_acctbal")
    return checks.violations(edges)


@query
def node_map_violations(spark, folder):
    """Supplier numbers that are missing; customer numbers that repeat."""
    by_supplier = tables.node_map_from_table(_suppliers_by_customer(spark, folder), "s_suppkey", "c_acctbal")
    by_customer = tables.node_map_from_table(_orders_of_all_customers(spark, folder), "c_custkey", "o_totalprice")
    return checks.violations(by_supplier).union(checks.violations(by_customer))


@query
def bipartite_uncovered(spark, folder):
    """Purchases where only parts of more than medium size are listed."""
    bought = g.purchases(spark, folder)
    large = g.table(spark, folder, "part").where("p_size > 25").select((-F.col("p_partkey") - 1).alias("id"))
    return checks.violations(BipartiteGraph(bought.edges, bought.nodes0, large))


@query
def bipartite_other_side(spark, folder):
    """The side that isn't given, from edges that are written either way."""
    bought = g.purchases(spark, folder)
    turned = F.pmod(F.col("src"), F.lit(2)) == 0
    edges = bought.edges.select(
        F.when(turned, F.col("dst")).otherwise(F.col("src")).alias("src"),
        F.when(turned, F.col("src")).otherwise(F.col("dst")).alias("dst"),
    )
    return BipartiteGraph(edges, bought.nodes0).nodes1


@query
def vector_get(spark, folder):
    events = tables.vector_from_table(g.table(spark, folder, "events"), "event_id", "value")
    return lookups.get(events, g.table(spark, folder, "orders").select("o_orderkey"))


@query
def bipartite_sizes(spark, folder):
    bought = g.purchases(spark, folder)
    nodes = lookups.num_nodes(bought).select(F.lit("nodes").alias("of"), F.col("num_nodes").alias("n"))
    return nodes.union(lookups.num_edges(bought).select(F.lit("edges"), "num_edges"))


@query
def vector_properties(spark, folder):
    return profile(tables.vector_from_table(g.table(spark, folder, "events"), "event_id", "value"))


@query
def edge_set_properties(spark, folder):
    return profile(_succession_set(spark, folder))


@query
def bipartite_properties_weighted(spark, folder):
    """Customers and orders with totals less a threshold as weights, some of them negative."""
    orders = g.table(spark, folder, "orders")
    edges = orders.select(
        F.col("o_custkey").alias("src"), (-F.col("o_orderkey") - 1).alias("dst"),
        (F.col("o_totalprice") - 100000).alias("weight"),
    )
    customers = g.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("weight"))
    return profile(BipartiteGraph(edges, customers, has_node0_weights=True))


@query
def vector_table(spark, folder):
    events = tables.vector_from_table(g.table(spark, folder, "events"), "event_id", "value")
    return tables.vector_to_table(events, "event", "amount")


# Differences and functions on rows that repeat or are null


@query
def node_map_diff_repeated(spark, folder):
    """Quantities by order, which repeat, with and without returned lines."""
    lines = g.table(spark, folder, "lineitem")
    left = tables.node_map_from_table(lines, "l_orderkey", "l_quantity")
    right = tables.node_map_from_table(lines.where("l_returnflag <> 'R'"), "l_orderkey", "l_quantity")
    return diff.node_map_diff(left, right)


@query
def node_map_diff_of_types(spark, folder):
    """Sizes as whole numbers against the same as floats."""
    part = g.table(spark, folder, "part")
    sizes = tables.node_map_from_table(part, "p_partkey", "p_size")
    floats = tables.node_map_from_table(part.withColumn("p_size", F.col("p_size").cast("double")), "p_partkey", "p_size")
    return diff.node_map_diff(sizes, floats).select("id", "issue")


@query
def nodemap_apply_large(spark, folder):
    """A Python function on numbers beyond 2 ** 53, with nulls among them."""
    rows = _orders_of_all_customers(spark, folder).select(
        "c_custkey", (F.col("o_orderkey") + F.lit(9007199254740993)).alias("big")
    )
    nodes = tables.node_map_from_table(rows, "c_custkey", "big")
    return node_ops.apply(nodes, lambda v: -1 if v is None else v + 1, "bigint", scalar=True).df


@query
def nodemap_apply_batch(spark, folder):
    """A function over whole Arrow batches."""
    return node_ops.apply(
        g.prices(spark, folder), lambda prices: pc.floor(pc.multiply(prices, 2.0)), "bigint", batch=True
    ).df


@query
def nodemap_reduce_all(spark, folder):
    sizes = tables.node_map_from_table(g.table(spark, folder, "part"), "p_partkey", "p_size")
    folds = [
        node_ops.reduce(sizes, how).select(F.lit(how).alias("how"), F.col("value").cast("bigint").alias("value"))
        for how in ("sum", "min", "max", "count")
    ]
    return reduce(DataFrame.union, folds)


@query
def aggregate_edges_least(spark, folder):
    """The least weight into each part, from 3 down."""
    return edge_ops.aggregate_edges(
        g.succession_graph(spark, folder), "min", 3.0, in_edges=True, out_edges=False
    ).df


@query
def pagerank_converged(spark, folder):
    """Ranks to convergence."""
    ranks = pagerank(g.succession_graph(spark, folder), 0.85, 200, 1e-13)
    return ranks.df.select("id", F.round("weight", 8).alias("rank"))


@query
def projection_nodes(spark, folder):
    return graph_projection(_weighted_purchases(spark, folder), 1).nodes


@query
def betweenness_places(spark, folder):
    """Over the undirected forest of places, from the regions."""
    graph = g.places(spark, folder)
    regions = g.table(spark, folder, "region").select((F.col("r_regionkey").cast("bigint") * 5 + 4).alias("id"))
    both_ways = Graph(graph.edges, graph.nodes, is_directed=False)
    return betweenness(both_ways, tables.node_set_from_table(regions, "id")).df


@query
def betweenness_repeated(spark, folder):
    """Of all nodes, by the steps seen more than once, as a share of the pairs that they can lie between."""
    graph = edge_ops.filter_edges(g.succession_graph(spark, folder), "weight >= 2")
    return betweenness(graph, normalize=True).df.select("id", F.round("weight", 12).alias("weight"))
