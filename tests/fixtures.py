"""Small graphs with known answers, and random ones."""

import random

from edgeloom.model import Graph

G4 = [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2)]
G4W = [(0, 1, 9), (0, 2, 7), (1, 2, 6), (2, 0, 8), (3, 2, 5)]
G8 = [(0, 3), (1, 0), (1, 4), (2, 4), (2, 5), (2, 7), (3, 1), (3, 4), (4, 5), (5, 6), (6, 2)]
A4 = [(0, 1), (1, 3), (2, 0), (3, 0), (3, 2)]
A4W = [(0, 1, 1.1), (1, 3, 2.2), (2, 0, 3.3), (3, 0, 4.4), (3, 2, 5.5)]
B5 = [(0, 10), (1, 10), (1, 11), (2, 11)]


def edges_df(spark, edges, weight="double"):
    if edges and len(edges[0]) == 3:
        return spark.createDataFrame(edges, f"src bigint, dst bigint, weight {weight}")
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def ids_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def graph(spark, edges, nodes=None, directed=True):
    ids = None if nodes is None else ids_df(spark, nodes)
    return Graph(edges_df(spark, edges), ids, directed)


def pairs(df):
    """A two-column table as a dict."""
    return {row[0]: row[1] for row in df.collect()}


def random_edges(seed, nodes, count):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(count)]


def star_edges(leaves):
    """A hub that holds almost all edges, with loops, repeats and a far pair."""
    spokes = [(0, i) if i % 3 else (i, 0) for i in range(1, leaves + 1)]
    return spokes + spokes[:5] + [(7, 7), (1, 2), (2, 3), (leaves + 1, leaves + 2)]


def shifted(*shapes):
    """The shapes as one edge list, each with its ids moved up by another 100."""
    return [(s + 100 * i, d + 100 * i) for i, edges in enumerate(shapes) for s, d in edges]
