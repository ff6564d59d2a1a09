"""Near-duplicates by SimHash fingerprints, found by anchor-point covering.

The 64 bits fall into three blocks of 21, 21 and 22. Two fingerprints that differ in at most
``t`` bits differ in at most ``t // 3`` bits in one of the blocks. Each block is a word of the
binary Golay code of length 23 with its last bits zero. That code is perfect: its 4096
codewords, the anchors, have covering radius 3, so every word has one home anchor within 3.
A word is also copied to every anchor within 3 + t // 3. If two words differ in at most
``t // 3`` bits, the home of each is among the anchors of the other, so comparing the homes of
an anchor with all its visitors misses no pair.

There are 3 * 4096 keys of a block and an anchor, whatever the data; their row counts are a
table of bounded size. A key with many rows is cut into tiles of home rows by visitors.
A tile hands on a chain through each of its connected groups instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from edgeloom.llm.common import (
    chains, column_of, free_name, local_labels, sorted_groups, table, with_component,
)
from edgeloom.plans.rounds import written

GENERATOR = 0b101011100011  # fixed value: x^11+x^9+x^7+x^6+x^5+x+1, which generates the Golay code
LENGTH, RADIUS = 23, 3
WIDTHS = (21, 21, 22)
HOME_ROWS, VISITOR_ROWS = 2048, 4096  # rows of a tile


def fingerprint(text: str | None, width: int = 4) -> int:
    """The bits that are set in over half of the XXH64 values of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[min(width, len(words)) - 1:].tolist()
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), last)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """``docs`` with the bigint column ``name``, the fingerprint's bits; null text gives 0."""

    @F.arrow_udf("bigint")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch), np.uint64, len(batch))
            yield pa.array(found.view(np.int64))

    return docs.withColumn(name, fp(column_of(docs, text).cast("string")))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each word by the generator polynomial, which is 0 for codewords only."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def error_patterns(radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All error words of at most ``radius`` bits ordered by syndrome, with start and end of each."""
    words = [0]
    for weight in range(1, radius + 1):
        words += [sum(1 << i for i in bits) for bits in combinations(range(LENGTH), weight)]
    patterns = np.array(words, np.int64)  # lighter ones first, so the leader leads its coset
    found = _syndromes(patterns)
    order = np.argsort(found, kind="stable")
    edges = np.searchsorted(found[order], np.arange(2049))
    return patterns[order], edges[:-1], edges[1:]


def anchors(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key (block and anchor) and home flag of every anchor within ``radius`` of each value."""
    patterns, start, end = error_patterns(radius)
    rows, keys, homes, shift = [], [], [], 0
    for block, width in enumerate(WIDTHS):
        word = (values >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        shift += width
        syndrome = _syndromes(word)
        many = (end - start)[syndrome]
        row = np.repeat(np.arange(len(values)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        anchor = word[row] ^ patterns[start[syndrome][row] + nth]
        rows.append(row)
        keys.append(block << LENGTH | anchor)
        homes.append(nth == 0)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def _anchored(prints: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            rows, keys, homes = anchors(values.view(np.uint64), radius)
            columns = [pa.array(values[rows]), pa.array(keys.astype(np.int32)), pa.array(homes)]
            yield pa.RecordBatch.from_arrays(columns, ["fp", "key", "home"])

    return prints.select("fp").mapInArrow(run, "fp bigint, key int, home boolean")


def _tiles(anchored: DataFrame, home_rows: int, visitor_rows: int) -> DataFrame:
    """Rows with their tiles ``key, i, j``; a home row is a visitor of its anchor as well."""
    sizes = anchored.groupBy("key").agg(
        F.ceil(F.count_if("home") / home_rows).cast("int").alias("hs"),
        F.ceil(F.count("*") / visitor_rows).cast("int").alias("vs"),
    )
    sized = anchored.join(F.broadcast(sizes), "key").where("hs > 0")  # at most 12288 keys
    spot = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    as_visitor = F.transform(
        F.sequence(F.lit(0), F.col("hs") - 1),
        lambda i: F.struct(i.alias("i"), (spot % F.col("vs")).cast("int").alias("j"), F.lit(False).alias("home")),
    )
    as_home = F.transform(
        F.sequence(F.lit(0), F.col("vs") - 1),
        lambda j: F.struct((spot % F.col("hs")).cast("int").alias("i"), j.alias("j"), F.lit(True).alias("home")),
    )
    places = F.when(F.col("home"), F.concat(as_visitor, as_home)).otherwise(as_visitor)
    return sized.select("fp", "key", F.explode(places).alias("_t")).select(
        "fp", "key", "_t.i", "_t.j", "_t.home"
    )


def links(prints: DataFrame, threshold: int = 4, home_rows: int = HOME_ROWS,
          visitor_rows: int = VISITOR_ROWS) -> DataFrame:
    """``src, dst``: edges that connect the distinct fingerprints ``prints(fp)`` within ``threshold``.

    Edges lead to the same connected groups as all pairs do.
    """
    if not 0 <= threshold <= 11:
        raise ValueError("the threshold must be from 0 to 11 bits")
    anchored, _ = written(_anchored(prints, RADIUS + threshold // len(WIDTHS)))

    def compare(tile: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        home = tile["home"].astype(bool)
        ids, where = np.unique(tile["fp"], return_inverse=True)
        left, right = where[home], where[~home]
        bits = ids.view(np.uint64)
        a, b = [], []
        step = max(1, 4_000_000 // max(1, len(right)))
        for low in range(0, len(left), step):
            part = left[low:low + step]
            near = np.bitwise_count(bits[part][:, None] ^ bits[right][None, :]) <= threshold
            h, v = np.nonzero(near)
            apart = part[h] != right[v]
            a.append(part[h[apart]])
            b.append(right[v[apart]])
        if not a or not sum(map(len, a)):
            return None
        src, dst = chains(local_labels(len(ids), np.concatenate(a), np.concatenate(b)))
        return pa.RecordBatch.from_arrays([pa.array(ids[src]), pa.array(ids[dst])], ["src", "dst"])

    tiles = _tiles(anchored, home_rows, visitor_rows)
    return sorted_groups(tiles, ["key", "i", "j"], compare, "src bigint, dst bigint").distinct()


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: int = 4, width: int = 4) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (the smallest id that links reach).

    Text null, empty or without words: fingerprint 0, linked like any other. Repeated rows are
    rows of one group. A row without an id has the component of the others, null if there is
    none. Other columns are not looked at.
    """
    plain = docs.select(column_of(docs, doc_id).alias("doc_id"), column_of(docs, text).alias("text"))
    marked, _ = written(fingerprints(plain, width=width).select("doc_id", "fp"))
    prints, _ = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges, _ = written(links(prints, threshold))
    # Written, so that both sides of the join are shuffled and a fingerprint of very many rows can be split.
    groups, _ = written(with_component(prints, edges, "fp", "least"))
    return marked.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             threshold: int = 4, width: int = 4) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest (id, hash of the text, number of the row).

    Rows are numbered in a written table, so the choice is one of rows, also if ids are repeated.
    Rows without an id are all kept.
    The rows are shuffled once, at any size, to meet the list of numbers that stay.
    """
    name = free_name(docs, "_row")
    rows, _ = written(docs.withColumn(name, F.monotonically_increasing_id()))
    plain = rows.select(
        column_of(rows, name).alias("row"), column_of(rows, doc_id).alias("doc_id"), column_of(rows, text).cast("string").alias("text")
    )
    marked, _ = written(fingerprints(plain, width=width).select("row", "doc_id", F.xxhash64("text").alias("hash"), "fp"))
    # A group is named by its first row that has an id.
    place = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "hash", "row"))
    prints, _ = written(marked.groupBy("fp").agg(F.min(place).alias("least")))
    edges, _ = written(links(prints.select("fp"), threshold))
    groups, _ = written(with_component(prints, edges, "fp", "least"))
    kept, _ = written(groups.where("component_id is not null").select(F.col("component_id.row").alias(name)).distinct())
    staying = rows.join(kept.hint("merge"), name, "left_semi").select(rows.columns)
    return staying.union(rows.where(column_of(rows, doc_id).isNull())).drop(name)


def op7_simhash_dedup(spark, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", hexed, "component_id")
