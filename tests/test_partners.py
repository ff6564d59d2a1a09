"""Pairs by packed lists: the functions that tasks run, alone and as a query."""

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from edgeloom.model import BipartiteGraph
from edgeloom.operators.projection import graph_projection
from edgeloom.plans import partners
from edgeloom.plans.skew import sampled_hot_keys
from tests.fixtures import edges_df

SPANS = {"near": (-20, 20), "far": (0, 2**40), "all": (-(2**63), 2**63 - 1)}


def rows_of(seed, span, count, keys, popular=0):
    """``key, value`` in the order of keys: repeats, a key of many values, a value of many keys."""
    rng = random.Random(seed)
    low, high = SPANS[span]
    values = [low, high, *(rng.randint(low, high) for _ in range(40))]
    rows = [(rng.randrange(keys), rng.choice(values)) for _ in range(count)]
    rows += [(0, v) for v in values] + [(k, values[5]) for k in range(popular)]
    return sorted(rows, key=lambda row: row[0])


def brute(rows):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, set()).add(v)
    return {(a, b) for group in groups.values() for a in group for b in group if a < b}


def batches(rows, size):
    for i in range(0, len(rows), size):
        keys, values = zip(*rows[i:i + size])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], ["key", "value"])


def chain(rows, at_once, bins, size):
    """What the query does, with one task for a step but the last."""
    lists = list(partners._listed(at_once)(batches(rows, size)))
    pairs, low = sum(b["pairs"][0].as_py() for b in lists), min(b["low"][0].as_py() for b in lists)
    high = max(b["high"][0].as_py() for b in lists)
    step = max(1, pairs // (bins * partners.POINTS))
    points = np.sort(np.concatenate([b["value"].to_numpy() for b in partners._drawn(step)(iter(lists))]))
    bounds = points[np.arange(1, bins) * len(points) // bins]
    pieces, met = {}, []
    for piece in partners._dealt(bounds, 4 * at_once)(iter(lists)):
        pieces.setdefault(piece["bin"][0].as_py(), []).append(piece)
    assert all(0 <= bin < bins for bin in pieces)
    for held in pieces.values():
        for batch in partners._paired(low, "<u4" if high - low < 2**32 else "<u8", at_once)(iter(held)):
            met += [(a, b) for a, seconds in zip(*(c.to_pylist() for c in batch.columns)) for b in seconds]
    return met, bounds


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("at_once, bins, size", [(1, 7, 3), (5, 2, 10), (40, 9, 1000), (10**6, 1, 50), (10**6, 30, 7)])
def test_steps(span, at_once, bins, size):
    for seed in range(3):
        rows = rows_of(seed, span, 250, 1 + 30 * seed, popular=60)
        met, _ = chain(rows, at_once, bins, size)
        want = brute(rows)
        assert len(met) == len(want) and set(met) == want


def test_value_with_several_bins():
    """The least of all values has most pairs: its partners are dealt to several bins."""
    rows = [(k, v) for k in range(100) for v in (-5, 2 * k, 2 * k + 1)]
    met, bounds = chain(rows, 10, 12, 25)
    assert np.count_nonzero(bounds == -5) > 4 and len(met) == len(set(met)) and set(met) == brute(rows)


def shuffled(df):
    """Bytes of the rows that running ``df`` shuffles."""
    df._jdf.queryExecution().toRdd().count()
    total, todo = 0, [df._jdf.queryExecution().executedPlan().finalPhysicalPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "ShuffleQueryStage":
            node = node.plan()
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("hot_rows", [20_000, 1_000_000])
def test_pairs_are_not_shuffled(spark, hot_rows):
    """A list travels once to a range of nodes, not once to each node that it holds."""
    rng = random.Random(4)
    edges = [(v, -k - 1) for k in range(60) for v in rng.sample(range(20 * k, 20 * k + 400), 70)]
    spark.conf.set("spark.edgeloom.hotRows", str(hot_rows))
    try:
        projected = graph_projection(BipartiteGraph(edges_df(spark, edges)), 0).edges
        assert 0 < shuffled(projected) < 16 * len(edges)
        got = [tuple(r) for r in projected.collect()]
    finally:
        spark.conf.unset("spark.edgeloom.hotRows")
    want = brute([(x, v) for v, x in edges])
    assert len(got) == len(want) and set(got) == want


def test_projection_of_any_edges(spark, mode):
    """Edges in both directions, repeated, within a side, and ends that aren't listed."""
    rng = random.Random(5)
    edges = [(rng.randrange(25), rng.randrange(15, 45)) for _ in range(150)]
    edges += [(b, a) for a, b in edges[:40]] + edges[:20] + [(3, 3), (3, 4)]
    listed = [i for i in range(25) if i % 6] + [3, 77]
    graph = BipartiteGraph(edges_df(spark, edges), spark.createDataFrame([(i,) for i in listed], "id bigint"))
    got = [tuple(r) for r in graph_projection(graph, 0).edges.collect()]
    want = brute([(k, v) for a, b in edges for v, k in ((a, b), (b, a)) if v in listed])
    assert len(got) == len(want) and set(got) == want


def test_projection_without_pairs(spark):
    for edges, listed in (([], [1]), ([(1, 2), (3, 4)], []), ([(1, 2), (3, 4)], [1, 3])):
        nodes = spark.createDataFrame([(i,) for i in listed], "id bigint")
        graph = BipartiteGraph(edges_df(spark, edges), nodes, spark.createDataFrame([(2,), (4,)], "id bigint"))
        assert graph_projection(graph, 0).edges.collect() == []


def test_edge_without_an_end(spark):
    graph = BipartiteGraph(edges_df(spark, [(1, 2), (None, 2)]))
    with pytest.raises(Exception, match="an edge has no src"):
        graph_projection(graph, 0)


AWAY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}).getOrCreate()
from edgeloom.model import BipartiteGraph
from edgeloom.operators.projection import graph_projection
spark.conf.set("spark.edgeloom.hotRows", "2")
edges = spark.createDataFrame([(i, -1 - i % 2) for i in range(8)], "src bigint, dst bigint")
print("PAIRS", graph_projection(BipartiteGraph(edges), 0).edges.count())
"""


def test_projection_on_executors_without_the_package(tmp_path):
    # Workers start in the folder of the driver's process, so it must be another one than the repository.
    public = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", AWAY, str(Path(__file__).resolve().parents[1])]
    said = subprocess.run(command, cwd=tmp_path, env=public, capture_output=True, text=True, timeout=300)
    assert "PAIRS 12" in said.stdout, said.stderr[-500:]


def test_hot_keys_of_a_sample(spark, mode):
    rows = spark.range(2000).selectExpr("if(id % 2 = 0, 7, id) AS k")
    found = sampled_hot_keys(rows, "k", 2000)
    assert (found.frame is None) == (mode == "plain")
    if found.frame is not None:
        assert [(r["_key"], r["_parts"]) for r in found.frame.collect()] == [(7, pytest.approx(4, abs=2))]
