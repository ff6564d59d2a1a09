import duckdb
import pytest
from pyspark.sql import functions as F

from edgeloom.functions.edges import canonicalize, symmetrize
from edgeloom.functions.values import simple_type, widest_type
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector
from edgeloom.operators import checks, diff, edges as edge_ops, lookups, nodes as node_ops
from edgeloom.operators.profile import profile
from edgeloom.plans.positions import dense_positions, running_totals
from edgeloom.plans.rounds import Rounds, shared_folder, written
from edgeloom.plans.skew import hot_keys, lookup
from edgeloom.sources import matrices, property_graphs, tables
from tests.fixtures import A4W, B5, G4W, edges_df, graph, ids_df, pairs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def node_map(spark, values, kind="bigint"):
    return NodeMap(spark.createDataFrame(list(values.items()), f"id bigint, weight {kind}"))


@pytest.fixture
def nm3(spark):
    return node_map(spark, {3: 33, 2: 22, 1: 11})


def test_csr_of_a_known_graph(spark, mode):
    csr = matrices.edges_to_csr(EdgeMap(edges_df(spark, A4W)))
    assert rows(csr.offsets) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 5)]
    assert [r[1:] for r in rows(csr.indices)] == [(1, 1.1), (3, 2.2), (0, 3.3), (0, 4.4), (2, 5.5)]
    back = matrices.edges_from_csr(csr.offsets, csr.indices)
    assert rows(back.df) == sorted(A4W)


def test_csr_with_empty_rows_and_sums(spark, mode):
    edges = [(10, 30, 1.0), (10, 30, 2.0), (40, 10, 5.0), (40, 20, 6.0), (40, 30, 7.0)]
    csr = matrices.edges_to_csr(EdgeMap(edges_df(spark, edges)))
    assert [r[1] for r in rows(csr.offsets)] == [0, 1, 1, 1, 4]
    back = matrices.edges_from_csr(csr.offsets, csr.indices, csr.node_list)
    assert rows(back.df) == [(10, 30, 3.0), (40, 10, 5.0), (40, 20, 6.0), (40, 30, 7.0)]


def test_undirected_coo_mirrors_once(spark, mode):
    g = graph(spark, [(1, 1), (1, 2)], nodes=[1, 2, 3], directed=False)
    coo = matrices.graph_to_coo(g)
    assert rows(coo.cells) == [(0, 0, True), (0, 1, True), (1, 0, True)]
    back = matrices.graph_from_coo(coo, directed=False, edge_dtype="int")
    assert rows(back.edges) == [(1, 1, 1), (1, 2, 1)] and back.nodes.count() == 3


def test_property_graph_roundtrip(spark, tmp_path):
    nodes = spark.createDataFrame([(i, i / 2) for i in range(6)], "n int, w double")
    g = property_graphs.load_graph(edges_df(spark, G4W, "bigint"), nodes, weight="weight", node="n", node_weight="w")
    property_graphs.save_graph(g, f"{tmp_path}/g")
    back = property_graphs.read_graph(spark, f"{tmp_path}/g")
    assert diff.graph_diff(g, back).isEmpty() and back.node_dtype == "float"
    b = property_graphs.load_bipartite(edges_df(spark, B5))
    property_graphs.save_bipartite(b, f"{tmp_path}/b")
    assert diff.bipartite_diff(b, property_graphs.read_bipartite(spark, f"{tmp_path}/b")).isEmpty()


def test_csv_edge_list(spark, tmp_path):
    (tmp_path / "e.csv").write_text("Source,Destination\n0,1\n0,2\n")
    df = spark.read.csv(f"{tmp_path}/e.csv", header=True)
    e = tables.edges_from_table(df, "Source", "Destination")
    assert rows(tables.edges_to_table(e, "a", "b")) == [(0, 1), (0, 2)]
    with pytest.raises(ValueError):
        tables.edges_from_table(df, "Source", "Nowhere")


def test_scan_reads_only_named_columns(spark, tmp_path):
    spark.range(5).selectExpr("id a", "id b", "id c", "id d").write.parquet(f"{tmp_path}/t")
    e = tables.edges_from_table(spark.read.parquet(f"{tmp_path}/t"), "a", "b")
    plan = e.df.where("src > 2")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan and "GreaterThan(a,2)" in plan


def test_model_checks(spark, nm3):
    with pytest.raises(ValueError):
        EdgeMap(edges_df(spark, B5))
    with pytest.raises(TypeError):
        Vector(spark.createDataFrame([("x", 1)], "pos string, value int"))
    with pytest.raises(ValueError):
        Graph(edges_df(spark, B5), has_node_weights=True)
    with pytest.raises(ValueError, match="endpoint_not_in_nodes: 1"):
        edge_ops.build_graph(EdgeSet(edges_df(spark, [(1, 10)])), nm3)
    assert rows(NodeSet(ids_df(spark, [1, 1, 2])).df) == [(1,), (2,)]


def test_bipartite_rules(spark, mode):
    sound = BipartiteGraph(edges_df(spark, B5))
    assert checks.violations(sound).isEmpty()
    broken = BipartiteGraph(
        edges_df(spark, B5 + [(0, 1), (7, 10)]), ids_df(spark, [0, 1, 2, 10]), ids_df(spark, [10, 11])
    )
    assert rows(checks.violations(broken).where("rule <> 'edge_inside_side'")) == [
        ("endpoint_in_no_side", 7), ("in_both_sides", 10)
    ]
    assert ("edge_inside_side", 1) in rows(checks.violations(broken))


def test_null_and_duplicate_ids(spark):
    v = Vector(spark.createDataFrame([(0, 1), (0, 2), (None, 3)], "pos bigint, value int"))
    assert {tuple(r) for r in checks.violations(v).collect()} == {("duplicate_id", 0), ("null_id", None)}
    e = EdgeSet(spark.createDataFrame([(1, None), (2, 3)], "src bigint, dst bigint"))
    assert rows(checks.violations(e)) == [("null_endpoint", 1)]


def test_lookups(spark, nm3):
    assert rows(lookups.contains(nm3, [1, 9])) == [(1,)]
    assert rows(lookups.contains(nm3, ids_df(spark, [2, 2, 9]))) == [(2,)]
    assert rows(lookups.get(nm3, [3])) == [(3, 33)]
    gaps = Vector(spark.createDataFrame([(1, 5.0), (4, 6.0)], "pos bigint, value double"))
    assert lookups.vector_length(gaps).first()[0] == 5
    assert rows(lookups.get(gaps, [4])) == [(4, 6.0)]
    assert lookups.num_nodes(EdgeSet(edges_df(spark, B5))).first()[0] == 5
    assert lookups.num_edges(EdgeSet(edges_df(spark, B5))).first()[0] == 4


@pytest.mark.parametrize("kind, values, negative", [
    ("double", [1.0, -1.0], True), ("bigint", [1, 2], False), ("boolean", [True, False], None),
])
def test_profile_of_weights(spark, kind, values, negative):
    e = EdgeMap(edges_df(spark, [(i, i + 1, v) for i, v in enumerate(values)], kind))
    row = profile(e).first()
    assert row["has_negative_weights"] is negative
    assert (row["num_nodes"], row["num_edges"], row["is_directed"]) == (3, 2, True)


def test_profile_of_empty_and_bipartite(spark):
    empty = EdgeMap(edges_df(spark, [(1, 2, 1.0)]).where("false"))
    assert profile(empty).first()["has_negative_weights"] is False
    assert profile(empty, slow=False).first().asDict() == {"is_directed": True, "dtype": "float"}
    row = profile(BipartiteGraph(edges_df(spark, B5))).first()
    assert (row["num_nodes0"], row["num_nodes1"], row["edge_type"], row["node0_dtype"]) == (3, 2, "set", None)


def test_diffs(spark, nm3):
    other = node_map(spark, {3: 33, 2: 23, 5: 1})
    assert rows(diff.node_map_diff(nm3, other).select("id", "issue")) == [
        (1, "only_left"), (2, "value"), (5, "only_right")
    ]
    near = node_map(spark, {1: 1.0 + 1e-12}, "double"), node_map(spark, {1: 1.0}, "double")
    assert diff.node_map_diff(*near).isEmpty()
    assert not diff.node_map_diff(*near, rel_tol=0.0).isEmpty()
    a, b = EdgeSet(edges_df(spark, [(1, 2), (1, 2)])), EdgeSet(edges_df(spark, [(1, 2), (3, 4)]))
    assert rows(diff.edge_set_diff(a, b)) == [(1, 2, "count", 2, 1), (3, 4, "only_right", 0, 1)]
    flat = EdgeSet(edges_df(spark, [(2, 1)]), False), EdgeSet(edges_df(spark, [(1, 2)]), False)
    assert diff.edge_set_diff(*flat).isEmpty()


def test_parallel_edges_compare_in_weight_order(spark, mode):
    a = EdgeMap(edges_df(spark, [(1, 2, w) for w in (3.0, 1.0, 2.0)] + [(4, 5, 1.0)]))
    b = EdgeMap(edges_df(spark, [(1, 2, w) for w in (1.0, 2.5, 3.0, 9.0)] + [(4, 5, 1.0)]))
    got = rows(diff.edge_map_diff(a, b).select("src", "dst", "rank", "issue"))
    assert got == [(1, 2, 1, "value"), (1, 2, 3, "only_right")]


def test_sort_with_ties_and_limits(spark, mode):
    x = node_map(spark, {1: 5, 2: 5, 3: 1, 4: 9})
    up = [r["value"] for r in node_ops.sort(x).df.orderBy("pos").collect()]
    down = [r["value"] for r in node_ops.sort(x, ascending=False).df.orderBy("pos").collect()]
    assert up == [3, 1, 2, 4] and down == up[::-1]
    for limit in (0, 2, 3, 10):
        got = node_ops.sort(x, True, limit).df.orderBy("pos").collect()
        assert [r["value"] for r in got] == up[:limit]


def test_node_operators(spark, nm3):
    assert pairs(node_ops.select(nm3, NodeSet(ids_df(spark, [1, 7]))).df) == {1: 11}
    with pytest.raises(KeyError):
        node_ops.select(nm3, NodeSet(ids_df(spark, [1, 7])), strict=True)
    assert rows(node_ops.filter_nodes(nm3, "weight > 11").df) == [(2,), (3,)]
    assert rows(node_ops.filter_nodes(nm3, lambda v: v % 2 == 1, scalar=True).df) == [(1,), (3,)]
    assert pairs(node_ops.apply(nm3, lambda w: w * 2).df) == {1: 22, 2: 44, 3: 66}
    assert pairs(node_ops.apply(nm3, lambda v: -v, "bigint", scalar=True).df)[3] == -33
    with pytest.raises(TypeError):
        node_ops.apply(nm3, lambda w: w is None)
    assert node_ops.reduce(nm3, "sum").first()[0] == 66
    drawn = node_ops.choose_random(NodeSet(ids_df(spark, range(50))), 7, seed=3).df
    again = node_ops.choose_random(NodeSet(ids_df(spark, range(50))), 7, seed=3).df
    assert drawn.count() == 7 and rows(drawn) == rows(again)


def test_edge_operators(spark):
    g = Graph(edges_df(spark, G4W, "bigint"), ids_df(spark, range(6)))
    kept = edge_ops.filter_edges(g, lambda w: w > 6)
    assert rows(kept.edges) == [(0, 1, 9), (0, 2, 7), (2, 0, 8)] and kept.nodes.count() == 6
    assert pairs(edge_ops.assign_uniform_weight(g, 2).edges.select("weight", F.lit(1))) == {2: 1}
    out = pairs(edge_ops.aggregate_edges(g, "sum", 0).df)
    assert out == {0: 16, 1: 6, 2: 8, 3: 5, 4: 0, 5: 0}
    least = pairs(edge_ops.aggregate_edges(g, "min", 100, in_edges=True).df)
    assert least == {0: 7, 1: 6, 2: 5, 3: 5, 4: 100, 5: 100}
    assert edge_ops.build_graph(EdgeSet(edges_df(spark, B5))).nodes.count() == 5


def test_edge_forms(spark):
    df = edges_df(spark, [(2, 1, 5.0), (3, 3, 1.0)])
    assert rows(symmetrize(df)) == [(1, 2, 5.0), (2, 1, 5.0), (3, 3, 1.0)]
    assert rows(canonicalize(df)) == [(1, 2, 5.0), (3, 3, 1.0)]
    assert simple_type(df.schema["weight"].dataType) == "float"
    assert [widest_type(t) for t in (["int", "bool"], ["int", "float"], ["int", "str"])] == ["int", "float", "str"]


def test_positions_and_totals(spark, mode):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(2).alias("v"))
    placed = dense_positions(df.repartition(5), ["k"])
    assert placed.where("pos <> k").isEmpty() and placed.count() == 1000
    totals = running_totals(placed, "pos", "v", "before", 1000)
    assert totals.where("before <> 2 * pos").isEmpty()


def test_hot_keys_are_few_and_lookups_whole(spark, mode):
    facts = spark.range(900).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(900).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    hot = hot_keys(facts.groupBy("k").agg(F.count("*").alias("n")), "k", 900)
    if mode == "skewed":
        assert 1 <= hot.frame.count() <= 8
        assert hot.spread(facts, "k", F.col("id")).where("k = 0").select("_part").distinct().count() > 1
    joined = lookup(facts.withColumnRenamed("id", "row"), "k", table, hot, "row")
    assert joined.count() == 900 and joined.where("twice <> 2 * k").isEmpty()


def test_loop_tables_are_dropped_and_results_stay(spark):
    with Rounds(spark) as loop:
        inner, facts = loop.written(spark.range(10), n=F.count("*"))
        kept, _ = written(inner.select((F.col("id") + 1).alias("id")))
        folder = loop._folder
    assert facts == {"n": 10} and kept.count() == 10
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
    assert shared_folder(spark)


def test_every_query_has_a_matching_schema(spark):
    from __spark_entry__ import oracle_sql, queries
    from queries.registered import QUERIES

    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    con = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    for name in ("lineitem", "orders", "part", "customer"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    for name in ("csr_offsets", "nodemap_sort_topk", "edge_set_diff"):
        result = con.execute(oracle_sql()[name])
        columns = [d[0] for d in result.description]
        got = queries()[name](spark, folder).select(*columns)
        assert rows(got) == sorted(result.fetchall())
