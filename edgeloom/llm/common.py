"""What the operators of this package share: text batches, splits, sorted groups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgeloom.model import Graph
from edgeloom.operators.components import connected_components

CHUNK_CHARS = 4_000_000  # characters that a vectorised step handles at once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_fold(doc_id: str | Column, parts: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``parts``; null without an id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % parts


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet, in any letter case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def column_of(df: DataFrame, name: str) -> Column:
    """The column called exactly ``name``, also if its name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_chunks(texts: pa.Array, most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``most`` characters, each with its first index; null becomes empty."""
    run: list[str] = []
    start = size = 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if run and size + len(text) > most:
            yield start, run
            run, start, size = [], i, 0
        run.append(text)
        size += len(text) + 1
    if run:
        yield start, run


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each ended by a line feed, and the end of each text."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return codes, ends


def groups_in_order(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Groups of rows with equal ``keys`` from batches that are sorted by them.

    Columns come as numpy arrays. Only the last group of a batch is carried over, so memory is
    bounded by a batch and the largest group.
    """
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            change[1:] |= columns[key][1:] != columns[key][:-1]
        if held and any(held[-1][k][-1] != columns[k][0] for k in keys):
            yield _stacked(held)
            held = []
        cuts = np.flatnonzero(change).tolist()
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            part = {n: c[low:high] for n, c in columns.items()}
            held.append(part)
            if high < batch.num_rows:
                yield _stacked(held)
                held = []
    if held:
        yield _stacked(held)


def _stacked(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def sorted_groups(
    df: DataFrame, keys: list[str], work: Callable[[dict[str, np.ndarray]], pa.RecordBatch | None],
    schema: str,
) -> DataFrame:
    """Apply ``work`` to each group of equal, non-null ``keys``, which must be of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_in_order(batches, keys):
            found = work(group)
            if found is not None and found.num_rows:
                yield found

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def local_labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of ``size`` nodes under the links ``a``-``b``."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            return label


def chains(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the members of each label one after the other, so no node is a hub."""
    order = np.argsort(label, kind="stable")
    same = label[order][1:] == label[order][:-1]
    return order[:-1][same], order[1:][same]


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest id that each end of ``edges(src, dst)`` reaches."""
    return connected_components(Graph(edges)).df.select("id", F.col("weight").alias("component"))


def with_component(members: DataFrame, edges: DataFrame, key: str, least: str) -> DataFrame:
    """``key, component_id``: the least ``least`` among the members that ``edges`` connect.

    ``members(key, least)`` has one row per key; keys without an edge stand alone.
    """
    labels = components(edges).withColumnRenamed("id", key)
    linked = members.join(labels, key)
    lowest = linked.groupBy("component").agg(F.min(least).alias("component_id"))
    named = labels.join(lowest, "component").select(key, "component_id")
    joined = members.join(named, key, "left")
    return joined.select(key, F.coalesce("component_id", least).alias("component_id"))
