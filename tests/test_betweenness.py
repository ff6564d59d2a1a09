"""Betweenness from all and from given nodes, normalised, in batches."""

import pytest

from edgeloom.model import Graph
from edgeloom.operators import betweenness as operator
from edgeloom.operators.betweenness import betweenness
from edgeloom.sources import tables
from tests import brute
from tests.fixtures import G8, graph, ids_df, pairs, random_edges, shifted

SHAPES = shifted([e for e in random_edges(5, 7, 11) if e[0] != e[1]], G8, [(0, 1), (1, 2), (2, 3), (3, 4)])


def _close(found, wanted):
    return set(found) == set(wanted) and all(abs(found[n] - wanted[n]) < 1e-9 for n in wanted)


@pytest.mark.parametrize("directed", [True, False])
def test_all_nodes(spark, directed):
    nodes = sorted({n for e in SHAPES for n in e} | {999})
    made = graph(spark, SHAPES + SHAPES[:3] + [(1, 1)], nodes, directed)
    raw = brute.betweenness(SHAPES, directed, nodes[:-1]) | {999: 0.0}
    found = pairs(betweenness(made).df)
    assert _close(found, {n: s if directed else s / 2 for n, s in raw.items()})
    pairs_between = (len(nodes) - 1) * (len(nodes) - 2)
    assert _close(pairs(betweenness(made, normalize=True).df), {n: s / pairs_between for n, s in raw.items()})
    # A path's inner nodes, by hand: 1 and 3 lie between 3 pairs, the middle between 4.
    if not directed:
        assert [found[n] for n in range(200, 205)] == [0, 3, 4, 3, 0]


@pytest.mark.parametrize("directed", [True, False])
def test_batches_and_given_nodes(spark, directed):
    made = graph(spark, SHAPES, None, directed)
    nodes = {n for e in SHAPES for n in e}
    some = [0, 103, 202, 12345]
    given = tables.node_set_from_table(ids_df(spark, some), "id")
    wanted = brute.betweenness(SHAPES, directed, some[:-1])
    scale = len(nodes) / 3 / ((len(nodes) - 1) * (len(nodes) - 2))
    try:
        spark.conf.set("spark.edgeloom.stateRows", "30")
        assert _close(pairs(betweenness(made, given).df), wanted)
        assert _close(pairs(betweenness(made, given, True).df), {n: s * scale for n, s in wanted.items()})
    finally:
        spark.conf.unset("spark.edgeloom.stateRows")


def test_small_graphs(spark):
    none = tables.node_set_from_table(ids_df(spark, [77]), "id")
    assert pairs(betweenness(graph(spark, [(1, 2)]), none).df) == {1: 0.0, 2: 0.0}
    assert pairs(betweenness(graph(spark, [(1, 2)]), normalize=True).df) == {1: 0.0, 2: 0.0}
    assert pairs(betweenness(graph(spark, [(4, 4)]), normalize=True).df) == {4: 0.0}
    made = graph(spark, [(1, 2)])
    assert pairs(betweenness(Graph(made.edges.where("false"), made.nodes.where("false"))).df) == {}


def test_only_what_is_reached_is_batched(spark, monkeypatch):
    """Many small components and nodes without edges are one batch, though all pairs would be many."""
    taken = []
    shares = operator._shares
    monkeypatch.setattr(operator, "_shares", lambda *given: taken.append(1) or shares(*given))
    edges = shifted(*[[(0, 1), (1, 2)]] * 4)
    nodes = range(400)
    try:
        spark.conf.set("spark.edgeloom.stateRows", "30")
        found = pairs(betweenness(graph(spark, edges, nodes)).df)
        assert len(taken) == 1
        assert found == {n: float(n % 100 == 1) for n in nodes}
        assert set(pairs(betweenness(graph(spark, [], range(3))).df).values()) == {0.0}
        assert len(taken) == 1
    finally:
        spark.conf.unset("spark.edgeloom.stateRows")
