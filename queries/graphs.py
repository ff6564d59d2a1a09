"""Graphs that Spark derives from whole tables.

* succession: part -> part, how often the second is the next line of the same order.
* purchases: customers and parts, joined where the customer ordered the part.
* places: a forest of orders, customers, suppliers, nations and regions, each pointing to what
  it belongs to. Nations and regions are hubs.
* transitions: per user, from the type of one event to the type of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from edgeloom.model import BipartiteGraph, EdgeMap, Graph, NodeMap
from edgeloom.plans.positions import dense_positions
from edgeloom.plans.rounds import even
from edgeloom.plans.skew import lookup, sampled_hot_keys
from edgeloom.sources.tables import edges_from_table, node_map_from_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def succession(spark: SparkSession, folder: str) -> EdgeMap:
    # Equal lines of an order are counted first, so a repeated line does not multiply rows.
    # Lines without one of the keys are in no step. Both sides of the join read alike, so that lines are counted once.
    lines = (
        table(spark, folder, "lineitem")
        .where("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_partkey IS NOT NULL")
        .groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.count("*").alias("n"))
    )
    after = lines.select(
        "l_orderkey", F.coalesce(F.col("l_linenumber") - 1, F.lit(0)).alias("l_linenumber"),
        F.col("l_partkey").alias("next"), F.col("n").alias("next_n"),
    )
    steps = lines.join(after, ["l_orderkey", "l_linenumber"]).where("l_partkey <> next")
    times = F.sum(F.col("n") * F.col("next_n")).cast("double").alias("weight")
    edges = steps.groupBy("l_partkey", "next").agg(times)
    return edges_from_table(edges, "l_partkey", "next", "weight")


def succession_graph(spark: SparkSession, folder: str) -> Graph:
    edges = succession(spark, folder)
    return Graph(edges.df, is_directed=edges.is_directed)


def prices(spark: SparkSession, folder: str) -> NodeMap:
    return node_map_from_table(table(spark, folder, "part"), "p_partkey", "p_retailprice")


def purchases(spark: SparkSession, folder: str, lines_where: str = "true") -> BipartiteGraph:
    """Customer ids stay; part ``p`` becomes ``-p - 1``, as the two number ranges overlap."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("src")
    )
    lines = table(spark, folder, "lineitem").where(lines_where).select("l_orderkey", "l_partkey")
    rows = lines.count()
    hot = sampled_hot_keys(lines, "l_orderkey", rows)
    if hot.frame is None:
        lines, orders = even(lines, rows, "l_orderkey"), even(orders, rows, "id")
    bought = lookup(lines, "l_orderkey", orders, hot, "l_partkey").select(
        "src", (-F.col("l_partkey") - 1).alias("dst")
    )
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    parts = table(spark, folder, "part").select((-F.col("p_partkey") - 1).alias("id"))
    return BipartiteGraph(even(bought, rows, "src", "dst").distinct(), customers, parts)


def places(spark: SparkSession, folder: str) -> Graph:
    """Ids are ``5 * key + kind``: order 0, customer 1, supplier 2, nation 3, region 4."""
    links = [
        ("orders", "o_orderkey", 0, "o_custkey", 1),
        ("customer", "c_custkey", 1, "c_nationkey", 3),
        ("supplier", "s_suppkey", 2, "s_nationkey", 3),
        ("nation", "n_nationkey", 3, "n_regionkey", 4),
    ]
    edges = None
    for name, low, low_kind, high, high_kind in links:
        part = table(spark, folder, name).select(
            (F.col(low).cast("bigint") * 5 + low_kind).alias("src"),
            (F.col(high).cast("bigint") * 5 + high_kind).alias("dst"),
        )
        edges = part if edges is None else edges.union(part)
    return Graph(edges)


def event_states(spark: SparkSession, folder: str) -> DataFrame:
    """``pos, user_id, event_type``: the states in their order, numbered."""
    states = table(spark, folder, "events").select("user_id", "event_type").distinct()
    return dense_positions(states, ["user_id", "event_type"])


def transitions(spark: SparkSession, folder: str) -> Graph:
    """Events are numbered by user and time, so an event meets the next one by position.

    Unlike a window per user this leaves no task with all events of a busy user.
    """
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id")
    placed = dense_positions(events, ["user_id", "ts", "event_id"]).select(
        "pos", "user_id", "event_type"
    )
    after = placed.select(
        (F.col("pos") - 1).alias("pos"), F.col("user_id").alias("next_user"),
        F.col("event_type").alias("next_type"),
    )
    counted = (
        placed.join(after, "pos").where("user_id = next_user")
        .groupBy("user_id", "event_type", "next_type")
        .agg(F.count("*").cast("double").alias("weight"))
    )
    states = event_states(spark, folder)
    src = states.select(F.col("pos").alias("src"), "user_id", "event_type")
    dst = states.select(F.col("pos").alias("dst"), "user_id", F.col("event_type").alias("next_type"))
    named = counted.join(src, ["user_id", "event_type"]).join(dst, ["user_id", "next_type"])
    return Graph(named.select("src", "dst", "weight"), states.select(F.col("pos").alias("id")))
