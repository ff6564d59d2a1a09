"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive benchmark words. Words are the symbols of the search
and a block is two of them. For every block that occurs in a pattern, the shift table has how
far it stands from the end of the nearest one; other blocks shift by the most. Where the shift
is 0, the suffix bucket of the block lists the patterns that may end there, and the words of
the text are compared with theirs.

Patterns of one length share their tables, so a short item doesn't shorten the shifts of the
long ones. All texts of a batch are searched in step, each at its own place.

Benchmarks of any size are searched in blocks of a bounded number of windows, one pass over
the documents each; what has been found so far travels along with the row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.llm.common import column_of, free_name, table
from edgeloom.plans.rounds import written

WINDOWS_PER_BLOCK = 200_000  # windows of one pass, which every executor holds
PIECE_WORDS = 1024  # a text is searched in pieces of so many places
BATCH_BYTES = 4_000_000

#: Byte -> the byte itself or its small letter if it belongs to a word, else 0.
FOLD = np.zeros(256, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it can be inverted modulo 2 ** 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        values = np.full(n, base, np.uint64)
        values[0] = 1
        out.append(np.multiply.accumulate(values))
    return out[0], out[1]


def word_hashes(data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of texts that lie end to end, and each cut's first word."""
    folded = FOLD[np.frombuffer(data, np.uint8)]
    inside = folded != 0
    joined = np.zeros(len(data), bool)  # goes on with the word of the byte before
    joined[1:] = inside[:-1] & inside[1:]
    joined[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~joined)
    last = inside.copy()
    last[:-1] &= ~joined[1:]
    ends = np.flatnonzero(last) + 1
    powers, inverses = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(folded * powers[:-1], out=total[1:])
    hashes = _mix((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, np.searchsorted(starts, cuts)


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


@dataclass
class Tables:
    """Search tables for the patterns of one length, in words."""

    length: int
    blocks: np.ndarray  # sorted hashes of the blocks of all patterns
    shifts: np.ndarray  # how far each block stands from the end of the nearest pattern
    bucket: np.ndarray  # sorted hashes of suffix block and whole pattern
    words: list[bytes]  # the words of each pattern, joined, in the order of ``bucket``
    items: list[list]  # the items that hold it


def _block(hashes: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    if length == 1:
        return hashes[last]
    return _mix(hashes[last - 1] * BASE + hashes[last])


def _bucket(hashes: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Hash of the suffix block and of all ``length`` words from each place on."""
    total = _block(hashes, first + length - 1, length)
    for k in range(length):
        total = _mix(total * BASE + hashes[first + k])
    return total


def build_tables(windows: dict[bytes, list]) -> list[Tables]:
    """Tables for ``windows``: words joined by one space each -> items."""
    by_length: dict[int, list[bytes]] = {}
    for words in windows:
        by_length.setdefault(words.count(b" ") + 1, []).append(words)
    found = []
    for length, patterns in sorted(by_length.items()):
        data = b"".join(p + b" " for p in patterns)
        hashes, *_ = word_hashes(data, np.array([0, len(data)]))
        first = np.arange(len(patterns)) * length
        ends = range(min(2, length), length + 1)
        blocks = np.concatenate([_block(hashes, first + e - 1, length) for e in ends])
        shifts = np.repeat([length - e for e in ends], len(first))
        order = np.lexsort((shifts, blocks))
        unique, at = np.unique(blocks[order], return_index=True)
        bucket = _bucket(hashes, first, length)
        rank = np.argsort(bucket, kind="stable")
        found.append(Tables(
            length, unique, shifts[order][at], bucket[rank],
            [patterns[i] for i in rank], [windows[patterns[i]] for i in rank],
        ))
    return found


def _places(tables: Tables, hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where a pattern may start, by hash; the words of each text are ``low:high``."""
    length, most = tables.length, max(1, tables.length - 1)
    # A text is cut into pieces by the place of a window's last word.
    first = low + length - 1
    many = np.maximum(0, -(-(high - first) // PIECE_WORDS))
    text = np.repeat(np.arange(len(low)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    place = first[text] + nth * PIECE_WORDS
    end = np.minimum(place + PIECE_WORDS, high[text])
    hits = [np.zeros(0, np.int64)]
    while len(place):
        block = _block(hashes, place, length)
        slot = np.minimum(np.searchsorted(tables.blocks, block), len(tables.blocks) - 1)
        shift = np.where(tables.blocks[slot] == block, tables.shifts[slot], most)
        start = place[shift == 0] - length + 1
        if len(start):
            bucket = _bucket(hashes, start, length)
            slot = np.minimum(np.searchsorted(tables.bucket, bucket), len(tables.bucket) - 1)
            hits.append(start[tables.bucket[slot] == bucket])
        place = place + np.maximum(shift, 1)
        going = place < end
        place, end = place[going], end[going]
    return np.sort(np.concatenate(hits))


def search(texts: list[bytes], tables: list[Tables]) -> list[tuple[int, list[tuple[int, int]], set]]:
    """Per text: its number of words, the ranges of words in an occurrence, the items found."""
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = b"".join(texts)
    if not data:
        return [(0, [], set()) for _ in texts]
    hashes, starts, ends, first = word_hashes(data, cuts)
    found: list[tuple[int, list, set]] = [(n, [], set()) for n in np.diff(first).tolist()]
    for t in tables:
        places = _places(t, hashes, first[:-1], first[1:])
        texts_of = (np.searchsorted(first, places, side="right") - 1).tolist()
        bucket = _bucket(hashes, places, t.length)
        lows = np.searchsorted(t.bucket, bucket).tolist()
        highs = np.searchsorted(t.bucket, bucket, side="right").tolist()
        for place, text, low, high in zip(places.tolist(), texts_of, lows, highs):
            # Direct comparison: equal hashes alone prove nothing.
            last = place + t.length
            spoken = b" ".join(data[s:e] for s, e in zip(starts[place:last], ends[place:last])).lower()
            for slot in range(low, high):
                if spoken == t.words[slot]:
                    begin = place - int(first[text])
                    found[text][1].append((begin, begin + t.length))
                    found[text][2].update(t.items[slot])
    return found


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as ranges that are sorted and apart."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def windows_of(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """``words, item``: the distinct windows of every item; null ids stay null."""
    plain = benchmark.select(
        column_of(benchmark, item_id).cast("string").alias("item"),
        column_of(benchmark, text).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text or "")
                for i in range(max(1, len(words) - width + 1) if words else 0):
                    rows.append((b" ".join(words[i:i + width]), item))
            columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["words", "item"])

    return plain.mapInArrow(run, "words binary, item string").distinct()


STATE = "struct<n_words:bigint, n_hit:bigint, items:array<string>, hits:array<struct<begin:bigint, end:bigint>>>"
STATE_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("hits", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
])


def _states(texts: pa.Array, known: list, tables: list[Tables]) -> pa.Array:
    out: list[dict] = []
    held: list[bytes] = []

    def flush() -> None:
        for words, ranges, items in search(held, tables):
            old = known[len(out)] or {"hits": [], "items": []}
            hits = merged(ranges + [(h["begin"], h["end"]) for h in old["hits"]])
            out.append({
                "n_words": words, "n_hit": sum(e - b for b, e in hits),
                "items": sorted({*items, *old["items"]} - {None}),
                "hits": [{"begin": b, "end": e} for b, e in hits],
            })
        held.clear()

    size = 0
    for value in texts:
        held.append((value.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size > BATCH_BYTES:
            flush()
            size = 0
    flush()
    return pa.array(out, STATE_TYPE)


def _pass(text: Column, before: Column | None, tables: list[Tables]) -> Column:
    """Search one block of windows, on top of what was found ``before``."""

    @F.arrow_udf(STATE)
    def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _states(texts, [None] * len(texts), tables)

    @F.arrow_udf(STATE)
    def later(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, known in batches:
            yield _states(texts, known.to_pylist(), tables)

    return first(text) if before is None else later(text, before)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 10, name: str = "contamination",
    windows_per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """``docs`` with a struct ``name``: ``n_words, n_hit, items, hits`` (ranges of hit words).

    A window is ``width`` words of an item in a row; a shorter item with words is one window.
    Null and empty texts have no words; items without words never occur; the hits of an item
    without an id count but it isn't listed. Rows that repeat are searched like any other.
    """
    windows, facts = written(windows_of(benchmark, item_id, item_text, width), rows=F.count("*"))
    blocks = max(1, -(-facts["rows"] // windows_per_block))
    block = F.pmod(F.xxhash64("words", "item"), F.lit(blocks))
    for k in range(blocks):
        found: dict[bytes, list] = {}
        part = windows.where(block == k).toArrow()  # about windows_per_block rows
        for words, item in zip(part.column("words").to_pylist(), part.column("item").to_pylist()):
            found.setdefault(words, []).append(item)
        content = column_of(docs, text).cast("string")
        known = column_of(docs, name) if k else None
        docs = docs.withColumn(name, _pass(content, known, build_tables(found)))
        if k + 1 < blocks:
            docs, _ = written(docs)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; see :func:`contamination`."""
    name = free_name(docs, "_contamination")
    marked = contamination(docs, benchmark, name=name, **options)
    return marked.where(column_of(marked, name)["n_hit"] == 0).drop(name)


def op8_decontaminate(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark"), name="c")
    return found.select(
        "doc_id", "c.n_words", "c.n_hit", F.size("c.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("c.items", ","), 256).alias("items_sha256"),
        (F.col("c.n_hit") > 0).alias("contaminated"),
    )
