import pytest

from edgeloom.model import BipartiteGraph, Graph
from edgeloom.operators import louvain
from edgeloom.operators.bfs import bfs_iter
from edgeloom.operators.components import connected_components
from edgeloom.operators.louvain import louvain_community, modularity_table
from edgeloom.operators.pagerank import pagerank
from edgeloom.operators.projection import graph_projection
from edgeloom.operators.strong import strongly_connected_components
from edgeloom.operators.triangles import triangle_count
from tests import brute
from tests.fixtures import (
    A4, B5, G4, G8, edges_df, graph, ids_df, pairs, random_edges, shifted, star_edges,
)

# Many shapes side by side in one graph: every algorithm answers for all of them at once.
ZOO = shifted(
    G4, G8, A4,
    star_edges(40),
    random_edges(1, 60, 45),
    random_edges(2, 40, 90),
    [(i, (i + 1) % 12) for i in range(12)] + [(20, 21), (21, 20), (21, 22)],
    [(i, i + 1) for i in range(12)],
    [(i, j) for i in range(8) for j in range(i)],
)
KNOWN = shifted(G4, G8, A4)


def test_components(spark, mode):
    assert pairs(connected_components(graph(spark, ZOO)).df) == brute.weak(ZOO)


def test_strong_components(spark, mode):
    got = pairs(strongly_connected_components(graph(spark, ZOO)).df)
    assert got == brute.strong(ZOO)
    # The three known graphs come first, shifted by 0, 100 and 200.
    assert {n: got[n] for n in range(4)} == {0: 0, 1: 0, 2: 0, 3: 3}
    assert {n - 100: got[n] - 100 for n in range(100, 108)} == {
        0: 0, 1: 0, 3: 0, 2: 2, 4: 2, 5: 2, 6: 2, 7: 7
    }
    assert {got[n] for n in range(200, 204)} == {200}


def test_isolated_nodes_are_optional(spark):
    g = graph(spark, G4, nodes=range(5))
    for algorithm in (connected_components, strongly_connected_components, pagerank):
        assert 4 not in pairs(algorithm(g).df)
        assert 4 in pairs(algorithm(g, include_isolated=True).df)


def test_undirected_strong_components_are_weak(spark):
    g = graph(spark, KNOWN, directed=False)
    assert pairs(strongly_connected_components(g).df) == brute.weak(KNOWN)


@pytest.mark.parametrize("directed", [True, False])
def test_pagerank(spark, mode, directed):
    got = pairs(pagerank(graph(spark, ZOO, directed=directed), 0.85, 5, 0.0).df)
    assert got == pytest.approx(brute.pagerank(ZOO, directed, 0.85, 5), abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)


def test_pagerank_stops_at_tolerance(spark):
    # The first round changes the ranks by less than 2, so it is the last.
    once = pairs(pagerank(graph(spark, G8), tolerance=2.0).df)
    assert once == pytest.approx(brute.pagerank(G8, True, 0.85, 1), abs=1e-12)


@pytest.mark.parametrize("edges, limit", [(star_edges(40), None), (G8, 2), (shifted(G8, ZOO), None)])
def test_bfs(spark, mode, edges, limit):
    source = edges[0][0]
    got = bfs_iter(graph(spark, edges), source, limit).df.orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(len(got)))
    assert [r["value"] for r in got] == brute.bfs(edges, source, True, limit)


def test_bfs_along_a_path(spark, mode):
    path = [(i, i + 1) for i in range(9)]
    got = bfs_iter(graph(spark, path), 0).df.orderBy("pos").collect()
    assert [r["value"] for r in got] == list(range(10))


def test_bfs_undirected_unknown_and_alone(spark):
    g = graph(spark, G4, nodes=range(5), directed=False)
    order = [r["value"] for r in bfs_iter(g, 3).df.orderBy("pos").collect()]
    assert order == brute.bfs(G4, 3, directed=False)
    assert [r["value"] for r in bfs_iter(g, 4).df.collect()] == [4]
    with pytest.raises(ValueError):
        bfs_iter(g, 99)


def test_triangles(spark, mode):
    assert triangle_count(graph(spark, ZOO)) == brute.triangles(ZOO)
    assert triangle_count(graph(spark, KNOWN)) == 1 + 4 + 2


def test_projection(spark, mode):
    g = BipartiteGraph(edges_df(spark, B5), ids_df(spark, [0, 1, 2, 5]), ids_df(spark, [10, 11]))
    kept = graph_projection(g, 0)
    assert {tuple(r) for r in kept.edges.collect()} == {(0, 1), (1, 2)}
    assert {r["id"] for r in kept.nodes.collect()} == {0, 1, 2, 5}
    assert {tuple(r) for r in graph_projection(g, 1).edges.collect()} == {(10, 11)}


def test_projection_with_popular_node(spark, mode):
    edges = [(i, 100) for i in range(30)] + [(i, 101 + i % 4) for i in range(0, 40, 3)]
    want = {(a, b) for a, x in edges for b, y in edges if x == y and a < b}
    got = [tuple(r) for r in graph_projection(BipartiteGraph(edges_df(spark, edges)), 0).edges.collect()]
    assert len(got) == len(want) and set(got) == want


def test_louvain_finds_planted_groups(spark):
    edges = [
        (10 * g + i, 10 * g + j, 1.0) for g in range(4) for i in range(6) for j in range(i)
    ] + [(10 * g, 10 * ((g + 1) % 4) + 1, 1.0) for g in range(4)]
    nodes = sorted({n for s, d, _ in edges for n in (s, d)}) + [99]
    labels, score = louvain_community(Graph(edges_df(spark, edges), ids_df(spark, nodes), False))
    got = pairs(labels.df)
    assert got == {n: n if n == 99 else n // 10 * 10 for n in nodes}
    assert score == pytest.approx(brute.modularity(edges, got))


def test_louvain_invariants(spark, mode):
    shape = shifted(star_edges(12), random_edges(3, 12, 20), G4)
    edges = [(s, d, 1.0 + (s + d) % 3) for s, d in shape]
    g = Graph(edges_df(spark, edges))
    labels, score = louvain_community(g)
    got = pairs(labels.df)
    assert set(got) == {n for s, d, _ in edges for n in (s, d)}
    assert all(got[label] == label and label <= n for n, label in got.items())
    assert score == pytest.approx(brute.modularity(edges, got))
    assert score >= brute.modularity(edges, {n: n for n in got})
    assert modularity_table(g, labels).first()[0] == pytest.approx(score)


def test_empty_graph(spark):
    g = graph(spark, [], nodes=[1, 2])
    assert pairs(connected_components(g).df) == {}
    assert pairs(strongly_connected_components(g).df) == {}
    assert pairs(pagerank(g).df) == {}
    assert triangle_count(g) == 0
    labels, score = louvain_community(g)
    assert pairs(labels.df) == {1: 1, 2: 2} and score == 0.0


def test_louvain_takes_single_neighbours_along(spark, monkeypatch):
    """Leaves follow their hub and the larger of a pair the smaller, before any round; loops are no leaves."""
    moves = []
    move = louvain._move
    monkeypatch.setattr(louvain, "_move", lambda *given: moves.append(1) or move(*given))
    edges = [(0, i) for i in range(1, 40)] + [(101, 100), (201, 200), (200, 202), (201, 201)]
    labels, score = louvain_community(graph(spark, edges))
    got = pairs(labels.df)
    assert {n: c for n, c in got.items() if n < 200} == {n: n // 100 * 100 for n in [*range(40), 100, 101]}
    assert len(moves) <= 6 and score == pytest.approx(brute.modularity([(s, d, 1.0) for s, d in edges], got))


def test_projection_lists(spark, mode):
    """Ids too far apart for small numbers, nodes with many neighbours, pairs met several times."""
    far = 2**40
    edges = [(i * far // 7, -k) for i in range(12) for k in range(1, 6) if (i * k) % 3 != 1]
    want = {(a, b) for a, x in edges for b, y in edges if x == y and a < b}
    projected = graph_projection(BipartiteGraph(edges_df(spark, edges)), 0).edges
    got = [tuple(r) for r in projected.collect()]
    assert len(got) == len(want) and set(got) == want and dict(projected.dtypes) == {"src": "bigint", "dst": "bigint"}
    if mode == "plain":  # No row per pair is shuffled: pairs are made after the last exchange.
        plan = projected._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Repartition")
