"""Near-duplicate embeddings by a forest of random-projection trees.

A tree splits the vectors again and again by their projection on a random direction, near the median.
Vectors close to a split go to both sides (spill overlap), so a close pair is seldom
parted, and what one tree parts another keeps together. Vectors with equal labels are compared
within the leaves, each pair that meets is verified by its cosine in double precision, and
verified links are united.

Thresholds come from a bounded sample (``sample_rows``); below the levels that it resolves, the
thresholds of the whole level hold, so the depth follows the number of vectors of each label. All vectors
are routed. Recall is planned, not hoped for: sampled vectors with partners at the wanted cosine are
routed as well, and each depth gets as many trees, at least ``trees``, as bring :data:`RECALL` of these pairs
together. A depth that would need more than :data:`MOST_TREES` is given up for a smaller one; at depth 0 all meet.
Equal vectors are one row with a multiplicity. A leaf with many rows is cut into tiles
of two blocks. A pair that meets in several leaves counts in the first of them only, which both
rows know, so no list of pairs is ever built: a tile gives numbers of links and a
chain through each of its connected groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from edgeloom.llm.common import chains, column_of, local_labels, sorted_groups, table, with_component
from edgeloom.plans.rounds import written

TREES = 10  # at least
MOST_TREES = 40
RECALL = 0.995  # share of pairs at the wanted cosine that meet in a leaf
PROBES = 2_000
LEAF_ROWS = 512
SPILL = 0.05  # share of a node's rows on each side of its median that go both ways
SAMPLE_ROWS = 20_000
NODE_SAMPLE = 64  # sampled rows that a threshold of its own needs
TILE_ROWS = 1024


def fit_forest(sample: np.ndarray, depth: int, trees: int = TREES, spill: float = SPILL, seed: int = 11) -> dict:
    """Directions per tree and level, per level the spill limits of its nodes, and ``trees`` for each depth."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(sample.shape[1], trees, max(1, depth)))
    directions /= np.linalg.norm(directions, axis=0)
    middle = (0.5 - spill, 0.5 + spill)
    limits = []
    for tree in range(trees):
        node = np.zeros(len(sample), np.int64)
        levels = []
        for level in range(depth):
            projected = sample @ directions[:, tree, level]
            general = np.quantile(projected, middle) if len(sample) else np.zeros(2)
            if levels and levels[-1].ndim == 1 or len(sample) < NODE_SAMPLE << level:
                levels.append(general)  # the sample is too small for single nodes
                continue
            own = np.tile(general, (1 << level, 1))
            median = np.full(1 << level, general.mean())
            for n in range(1 << level):
                part = projected[node == n]
                if len(part) >= NODE_SAMPLE // 2:
                    own[n] = np.quantile(part, middle)
                    median[n] = np.median(part)
            levels.append(own)
            node = node * 2 + (projected > median[node])
        limits.append(levels)
    return {"directions": directions, "limits": limits, "depth": depth, "trees": [1] + [trees] * depth}


def plan_forest(sample: np.ndarray, depth: int, threshold: float, trees: int = TREES, spill: float = SPILL,
                recall: float = RECALL, most_trees: int = MOST_TREES, seed: int = 11) -> dict:
    """A forest whose ``trees`` says how many trees each depth needs; it ends at the last depth that ``most_trees`` suffice for."""
    if not depth or len(sample) < 2 or sample.shape[1] < 2:
        return fit_forest(sample, 0, 1, spill, seed)
    rng = np.random.default_rng(seed + 1)
    # The sample is in the order of a hash, so its first rows are drawn at random.
    x = np.tile(sample, (-(-PROBES // len(sample)), 1))[:PROBES]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = min(1.0, max(-1.0, threshold))
    y = cosine * x + math.sqrt(1 - cosine * cosine) * aside
    most = max(trees, most_trees)
    forest = fit_forest(sample, depth, most, spill, seed)
    met = np.zeros((depth + 1, most, len(x)), bool)
    for tree in range(most):
        for level, (a, b) in enumerate(zip(_routes(forest, x, tree, depth), _routes(forest, y, tree, depth))):
            common = np.intersect1d(a[0] << 40 | a[1], b[0] << 40 | b[1], assume_unique=True)
            met[level, tree, common >> 40] = True
    needed = [1]
    for level in range(1, depth + 1):
        share = np.logical_or.accumulate(met[level], axis=0).mean(1)
        if share[-1] < recall:
            break
        needed.append(max(trees, needed[-1], int(np.argmax(share >= recall)) + 1))
    last = len(needed) - 1
    limits = [levels[:last] for levels in forest["limits"][:needed[-1]]]
    return forest | {"limits": limits, "depth": last, "trees": needed}


def _routes(forest: dict, x: np.ndarray, tree: int, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and node of every place of every vector in a tree, for each depth from 0."""
    row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    yield row, node
    for level, limits in enumerate(forest["limits"][tree][:depth]):
        projected = (x @ forest["directions"][:, tree, level])[row]
        low, high = limits if limits.ndim == 1 else limits[node].T
        left, right = projected <= high, projected >= low
        row = np.concatenate([row[left], row[right]])
        node = np.concatenate([node[left] * 2, node[right] * 2 + 1])
        yield row, node


def leaves_of(forest: dict, x: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and leaf code (tree and leaf) of every place of every vector, sorted by row and code.

    With ``depth``, leaves are the nodes of that depth, or the forest's own if that is smaller.
    """
    depth = forest["depth"] if depth is None else min(depth, forest["depth"])
    rows, codes = [], []
    for tree in range(forest["trees"][depth]):
        *_, (row, node) = _routes(forest, x, tree, depth)
        rows.append(row)
        codes.append(tree << 48 | node)
    row, code = np.concatenate(rows), np.concatenate(codes)
    order = np.lexsort((code, row))
    return row[order], code[order]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Equally long lists as one matrix, in the precision that they have."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; none of ``x`` is zero."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _classes(vectors: DataFrame) -> DataFrame:
    """``cid, label, vector, least, size``: equal vectors with equal labels, if they can link at all."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    grouped = vectors.where(usable).groupBy("label", "vector").agg(
        F.min("id").alias("least"), F.count("*").alias("size")
    )
    return grouped.withColumn("cid", F.monotonically_increasing_id())


def _placed(classes: DataFrame, forest_of: dict[int, dict]) -> DataFrame:
    """A row for each leaf of each class, with all its leaf codes and the vector's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, depths = batch.column("dim").to_numpy(), batch.column("depth").to_numpy()
            for dim, depth in sorted(set(zip(dims.tolist(), depths.tolist()))):
                part = batch.filter(pa.array((dims == dim) & (depths == depth)))
                x = _matrix(part.column("vector"))
                row, code = leaves_of(forest_of[dim], _unit(x), depth)
                first = np.searchsorted(row, np.arange(len(x) + 1))
                codes = [code[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                raw = [v.tobytes() for v in x]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    part.column("label").take(take), part.column("dim").take(take), pa.array(code),
                    part.column("cid").take(take), part.column("size").take(take),
                    pa.array(codes, pa.binary()).take(take), pa.array(raw, pa.binary()).take(take),
                ], ["label", "dim", "leaf", "cid", "size", "leaves", "raw"])

    schema = "label string, dim int, leaf bigint, cid bigint, size bigint, leaves binary, raw binary"
    plain = classes.select("label", "dim", "depth", "vector", "cid", "size")
    return plain.mapInArrow(run, schema)


def _tiled(placed: DataFrame, tile_rows: int) -> DataFrame:
    """Rows with the tiles ``i <= j`` of two blocks that they belong to, and their own block."""
    keys = ["label", "dim", "leaf"]
    counts = placed.groupBy(*keys).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("blocks"))
    sized = placed.join(counts, keys)
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")),
    )
    opened = sized.withColumn("block", block).withColumn("_t", F.explode(tiles))
    return opened.select(*keys, "_t.i", "_t.j", "block", "cid", "size", "leaves", "raw")


def _compare(threshold: float):
    def work(tile: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        cid, size, leaf, dim = tile["cid"], tile["size"], int(tile["leaf"][0]), int(tile["dim"][0])
        kind = np.float32 if len(tile["raw"][0]) == 4 * dim else np.float64
        x = _unit(np.frombuffer(b"".join(tile["raw"]), kind).reshape(-1, dim))
        left = np.flatnonzero(tile["block"] == tile["i"])
        right = np.flatnonzero(tile["block"] == tile["j"])
        diagonal = tile["i"][0] == tile["j"][0]
        # Leaves before this one: pairs that share one of them have been counted there.
        lists = [np.frombuffer(b, np.int64) for b in tile["leaves"]]
        lists = [codes[codes < leaf] for codes in lists]
        owner = np.repeat(np.arange(len(lists)), [len(c) for c in lists])
        known, at = np.unique(np.concatenate(lists), return_inverse=True)
        member = np.zeros((len(lists), max(1, len(known))), np.float32)
        member[owner, at] = 1
        close = x[left] @ x[right].T >= threshold
        close &= member[left] @ member[right].T == 0
        if diagonal:
            close = np.triu(close, 1)
        h, v = np.nonzero(close)
        if not len(h):
            return None
        a, b = left[h], right[v]
        links = np.bincount(a, size[b], len(cid)) + np.bincount(b, size[a], len(cid))
        some = np.flatnonzero(links)
        src, dst = chains(local_labels(len(cid), a, b))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([cid[some], cid[src]])),
            pa.array(np.concatenate([np.zeros(len(some), np.int64), cid[dst]]),
                     mask=np.concatenate([np.ones(len(some), bool), np.zeros(len(src), bool)])),
            pa.array(np.concatenate([links[some].astype(np.int64), np.zeros(len(src), np.int64)])),
        ], ["a", "b", "links"])

    return work


def embedding_groups(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = 0.93, trees: int = TREES, leaf_rows: int = LEAF_ROWS, spill: float = SPILL,
    sample_rows: int = SAMPLE_ROWS, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """One row per row: ``id, n_links, component_id`` (the smallest id that links reach).

    Vectors that are null, zero, or hold null or non-finite components, and rows without a label link
    with nothing; vectors of different lengths don't link. Rows that repeat link with each
    other. A row without an id counts as a link of others and is never the smallest.
    """
    # Single precision stays as it is until cosines are taken; everything else becomes double.
    given = df.schema[embedding].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    kind = "float" if single else "double"
    vectors, _ = written(df.select(
        column_of(df, vec_id).alias("id"), column_of(df, label).cast("string").alias("label"),
        column_of(df, embedding).cast(f"array<{kind}>").alias("vector"),
    ))
    classes, _ = written(_classes(vectors).withColumn("dim", F.size("vector")))
    depth_of = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / leaf_rows))).cast("int")
    counts = classes.groupBy("dim", "label").agg(F.count("*").alias("n")).select("dim", "label", depth_of.alias("depth"))
    depths, _ = written(counts)  # a row per label
    forests = {}
    for row in depths.groupBy("dim").agg(F.max("depth").alias("depth")).collect():  # one per length of vector
        depth = row["depth"]
        drawn = classes.where(F.col("dim") == row["dim"]).orderBy(F.xxhash64("vector")).limit(sample_rows)
        sample = np.zeros((0, row["dim"]))
        if depth:
            sample = _unit(_matrix(drawn.select("vector").toArrow().column(0).combine_chunks()))
        forests[row["dim"]] = plan_forest(sample, depth, threshold, trees, spill)
    deep = depths.where("depth > 0").withColumnRenamed("label", "_label").withColumnRenamed("dim", "_dim")
    sized = classes.join(deep, (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim")), "left")
    placed, _ = written(_placed(sized.withColumn("depth", F.coalesce("depth", F.lit(0))), forests))
    keys = ["label", "dim", "leaf", "i", "j"]
    found, _ = written(sorted_groups(_tiled(placed, tile_rows), keys, _compare(threshold), "a bigint, b bigint, links bigint"))
    edges = found.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    links = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    groups = with_component(classes.select("cid", "least"), edges, "cid", "least")
    known = classes.join(links, "cid", "left").join(groups, "cid").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    joined = vectors.join(known, ["label", "vector"], "left")
    return joined.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def op5_embedding_dedup(spark, folder: str) -> DataFrame:
    groups = embedding_groups(table(spark, folder, "embeddings"))
    return groups.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component_id").cast("bigint").alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
