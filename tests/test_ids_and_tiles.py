"""Missing, repeated and fractional ids; equality; user functions; tiles of large groups."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.errors import PySparkException

from edgeloom.functions.edges import canonicalize
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, Vector
from edgeloom.operators import checks, diff, edges as edge_ops, lookups, nodes as node_ops
from edgeloom.operators.betweenness import betweenness
from edgeloom.operators.bfs import bfs_iter
from edgeloom.operators.components import connected_components
from edgeloom.operators.louvain import louvain_community, modularity_table
from edgeloom.operators.pagerank import _degrees, pagerank
from edgeloom.operators.strong import strongly_connected_components
from edgeloom.operators.triangles import triangle_count
from edgeloom.plans.blocks import Blocks, total
from edgeloom.plans.rounds import Rounds, release
from edgeloom.plans.skew import lookup, pair_tiles, pairs_within
from edgeloom.sources import matrices, tables
from tests import brute
from tests.fixtures import edges_df, graph, ids_df, pairs, random_edges


def _null_ended(spark):
    return Graph(spark.createDataFrame([(1, 2), (None, 5)], "src bigint, dst bigint"))


@pytest.mark.parametrize("algorithm", [
    lambda g: connected_components(g).df, lambda g: strongly_connected_components(g).df,
    lambda g: pagerank(g).df, lambda g: bfs_iter(g, 1).df, lambda g: louvain_community(g)[0].df,
    lambda g: triangle_count(g), lambda g: matrices.edges_to_coo(EdgeSet(g.edges)).cells,
])
def test_a_missing_end_is_an_error(spark, algorithm):
    with pytest.raises(PySparkException, match="no src or no dst"):
        found = algorithm(_null_ended(spark))
        found.collect()


def test_unlisted_ends_are_an_error(spark):
    with pytest.raises(PySparkException, match="not listed"):
        matrices.graph_to_coo(graph(spark, [(1, 2), (2, 7)], nodes=[1, 2])).cells.collect()


def test_null_ends_are_no_loops(spark):
    a = spark.createDataFrame([(None, 5)], "src bigint, dst bigint")
    assert canonicalize(a).collect() == [(5, None)]
    b = edges_df(spark, [(5, 5)])
    assert diff.edge_set_diff(EdgeSet(a, False), EdgeSet(b, False)).count() == 2


def test_fractional_ids(spark):
    halves = spark.createDataFrame([(1.0, 2.0), (1.5, 3.0)], "a double, b double")
    with pytest.raises(PySparkException, match="no whole number"):
        tables.edges_from_table(halves, "a", "b").df.collect()
    assert tables.edges_from_table(halves.where("a = 1.0"), "a", "b").df.collect() == [(1, 2)]
    with pytest.raises(TypeError):
        node_ops.node_set_from_vector(Vector(spark.createDataFrame([(0, 1.2)], "pos bigint, value double")))


def test_repeated_node_ids(spark):
    repeated = Graph(edges_df(spark, [(1, 2)]), ids_df(spark, [1, 2, 2, 9, 9]))
    for labels in (connected_components(repeated, True), strongly_connected_components(repeated, True),
                   pagerank(repeated, include_isolated=True)):
        assert labels.df.count() == 3


def test_ends_that_are_not_listed_keep_what_they_receive(spark):
    # 1 and 2 send all; 7 receives, but passes nothing on; 8 sends nothing, as it isn't listed, so 9 has no rank.
    partly = Graph(edges_df(spark, [(1, 2), (2, 1), (2, 7), (7, 1), (8, 9)]), ids_df(spark, [1, 2, 3]))
    got = pairs(pagerank(partly, 1.0, 1, 0.0, include_isolated=True).df)
    assert got == pytest.approx({1: 1 / 6 + 1 / 9, 2: 1 / 3 + 1 / 9, 3: 1 / 9, 7: 1 / 6 + 1 / 9})


def test_a_round_shuffles_no_row_for_each_edge(spark):
    """PageRank's sums travel as a row for a bin and a group, however many edges there are between them."""
    edges = sorted(set(random_edges(5, 300, 6000)) | {(0, i) for i in range(1, 300)})
    rows = edges_df(spark, edges)
    spark.conf.set("spark.edgeloom.rowsPerPartition", "1500")
    try:
        with Rounds(spark) as rounds:
            blocks = Blocks(rounds, _degrees(rows), 300, rows, len(edges))
            nodes = {r["pos"]: r["id"] for r in blocks.nodes.collect()}
            assert blocks.count == -(-len(edges) // 1500) and sorted(nodes.values()) == list(range(300))
            groups = range(-(-300 // blocks.width))
            ids = {g: [nodes[p] for p in range(g * blocks.width, min(300, (g + 1) * blocks.width))] for g in groups}
            packed = [(g, bytearray(np.array(ids[g], "<f8").tobytes())) for g in groups]
            found = blocks.sums(spark.createDataFrame(packed, "group bigint, value binary")).toArrow()
            assert found.num_rows <= 2 * blocks.count**2 < len(edges)
            got = {}
            for g in groups:
                sums = total(found.filter(pc.equal(found["group"], g)), len(ids[g]))
                got |= dict(zip(ids[g], sums.tolist()))
    finally:
        spark.conf.unset("spark.edgeloom.rowsPerPartition")
    want = dict.fromkeys(range(300), 0.0)
    for s, d in edges:
        want[d] += s
    assert got == want


AWAY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}).getOrCreate()
from edgeloom.model import Graph
from edgeloom.operators.pagerank import pagerank
print("RANKS", pagerank(Graph(spark.createDataFrame([(1, 2), (2, 1)], "src bigint, dst bigint"))).df.count())
"""


def test_pagerank_on_executors_without_the_package(tmp_path):
    # Workers start in the folder of the driver's process, so it must be another one than the repository.
    public = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", AWAY, str(Path(__file__).resolve().parents[1])]
    said = subprocess.run(command, cwd=tmp_path, env=public, capture_output=True, text=True, timeout=300)
    assert "RANKS 2" in said.stdout, said.stderr[-500:]


def test_a_map_equals_itself(spark, mode):
    rows = [(1, 5), (1, 7), (1, 5), (None, 3), (None, None), (2, None)]
    m = NodeMap(spark.createDataFrame(rows, "id bigint, weight bigint"))
    assert diff.node_map_diff(m, m).count() == 0
    e = EdgeMap(spark.createDataFrame([(1, 2, 3.0), (1, 2, 4.0), (None, 2, 1.0)], "src bigint, dst bigint, weight double"))
    assert diff.edge_map_diff(e, e).count() == 0
    fewer = EdgeMap(e.df.where("weight <> 3.0"))
    found = [tuple(r) for r in diff.edge_map_diff(e, fewer).orderBy("rank").collect()]
    assert found == [(1, 2, 0, "value", 3.0, 4.0), (1, 2, 1, "only_left", 4.0, None)]


def test_types_are_part_of_equality(spark):
    whole = NodeMap(spark.createDataFrame([(1, 3)], "id bigint, weight bigint"))
    floats = NodeMap(spark.createDataFrame([(1, 3.0)], "id bigint, weight double"))
    for a, b in ((whole, floats), (floats, whole)):
        assert [r.issue for r in diff.node_map_diff(a, b).collect()] == ["type"]


def test_python_functions_see_exact_values(spark):
    rows = [(1, 9007199254740993), (2, None), (3, -1)]
    m = NodeMap(spark.createDataFrame(rows, "id bigint, weight bigint"))
    seen = node_ops.apply(m, lambda v: "none" if v is None else str(v), "string", scalar=True)
    assert pairs(seen.df) == {1: "9007199254740993", 2: "none", 3: "-1"}
    added = node_ops.apply(m, lambda values: pc.add(values, pa.scalar(1)), "bigint", batch=True)
    assert pairs(added.df) == {1: 9007199254740994, 2: None, 3: 0}
    with pytest.raises(ValueError, match="no weights"):
        edge_ops.filter_edges(graph(spark, [(1, 2)]), lambda w: w > 1)


def test_errors_hand_over_all_ids(spark):
    broken = graph(spark, [(i, i + 1) for i in range(50)], nodes=[0])
    with pytest.raises(checks.BrokenRules) as raised:
        checks.require_valid(broken)
    assert raised.value.counts == {"endpoint_not_in_nodes": 50}
    assert raised.value.violations.count() == 50
    m = NodeMap(spark.createDataFrame([(1, 1)], "id bigint, weight bigint"))
    with pytest.raises(node_ops.AbsentNodes) as raised:
        node_ops.select(m, tables.node_set_from_table(spark.range(60), "id"), strict=True)
    assert raised.value.nodes.count() == 59


def test_sides_whichever_way_edges_are_written(spark):
    b = BipartiteGraph(edges_df(spark, [(0, 10), (11, 0), (1, 11)]), ids_df(spark, [0, 1]))
    assert sorted(r.id for r in b.nodes1.collect()) == [10, 11]
    assert lookups.num_nodes(b).first()[0] == 4
    assert checks.violations(b).count() == 0


def test_tiles_meet_two_blocks_only(spark):
    rows = spark.range(200).selectExpr("1 AS k", "id AS v").union(spark.range(5).selectExpr("2 AS k", "id AS v"))
    spark.conf.set("spark.edgeloom.pairRows", "20")
    try:
        left, right = pair_tiles(rows, "k", "v")
        most = max(
            r["count"] for side in (left, right) for r in side.groupBy("k", "_i", "_j").count().collect()
        )
        assert most <= 40  # 20 rows a block, give or take what the hash does
        found = pairs_within(rows, "k", "v")
        assert found.count() == found.distinct().count() == 199 * 100 + 10
        assert found.where("first >= second").count() == 0
    finally:
        spark.conf.unset("spark.edgeloom.pairRows")


@pytest.mark.parametrize("seed", range(3))
def test_louvain_ends_where_no_single_move_gains(spark, seed):
    edges = [(a, b) for a, b in random_edges(seed, 14, 24) if a != b]
    made = graph(spark, edges, directed=False)
    labels, score = louvain_community(made)
    by_id = pairs(labels.df)
    assert abs(modularity_table(made, labels).first()[0] - score) < 1e-9
    assert all(min(n for n in by_id if by_id[n] == c) == c for c in by_id.values())
    alone = NodeMap(made.nodes.selectExpr("id", "id AS weight"))
    assert score >= modularity_table(made, alone).first()[0]


def test_release_leaves_the_result_only(spark):
    release(spark)
    made = graph(spark, [(1, 2), (2, 3), (7, 8)])
    result = matrices.edges_to_coo(EdgeSet(made.edges)).cells
    labels = connected_components(made).df
    assert release(spark, keep=labels) >= 2
    assert labels.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST"):
        result.collect()
    assert release(spark) == 1


@pytest.mark.parametrize("directed", [True, False])
def test_betweenness(spark, directed):
    edges = [(a, b) for a, b in random_edges(3, 12, 24) if a != b]
    sources = [0, 3, 5, 77]
    found = pairs(betweenness(graph(spark, edges, directed=directed), tables.node_set_from_table(ids_df(spark, sources), "id")).df)
    wanted = brute.betweenness(edges, directed, sources)
    assert set(found) == set(wanted)
    assert all(abs(found[n] - wanted[n]) < 1e-9 for n in wanted)


def test_measured_tables_stay_off_the_driver(spark):
    """A table of more rows than the limit is shuffled, however small its files are."""
    facts = spark.range(100).withColumnRenamed("id", "k")
    for rows, word in ((60_000, "SortMergeJoin"), (50_000, "BroadcastHashJoin")):
        joined = lookup(facts, "k", spark.range(rows), rows=rows)
        assert word in joined._jdf.queryExecution().executedPlan().toString()


def test_counted_keys_are_spread_by_their_rows(spark):
    """There are more tasks than the session's partitions if these would hold too many rows."""
    left, right = (tables.node_set_from_table(spark.range(n), "id") for n in (60, 40))
    try:
        spark.conf.set("spark.edgeloom.taskRows", "5")
        found = diff.node_set_diff(left, right)
        assert found.rdd.getNumPartitions() == 20 and sorted(r["id"] for r in found.collect()) == list(range(40, 60))
    finally:
        spark.conf.unset("spark.edgeloom.taskRows")
