"""Pairs of values that share a key, by packed lists.

The values of a key are one ascending list. Lists are written packed: the gaps between their numbers, by planes
of bytes, compressed. The first values of the pairs are cut into ranges, bins, of about as many pairs each, and a bin is sent each list that
has a value of its range once: from that value on, whatever the number of its pairs. Pairs are made and
repeats dropped after this shuffle, a bounded number at a time. A value with more pairs than a bin has
several bins, to which its partners are dealt by hash.
"""

from __future__ import annotations

import math
import struct
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from edgeloom.plans.rounds import free_shuffles, partitions_for, setting, shuffle_partitions, written

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BIN = 32  # pairs of a bin, in units of hotRows
POINTS = 64  # values drawn for a bin to find its bounds

LISTS = "pairs bigint, low bigint, high bigint, sizes binary, gaps binary"
PIECES = "bin int, low bigint, sizes binary, firsts binary, gaps binary"


def partners_within(rows: DataFrame, key: str, value: str, count: int) -> DataFrame:
    """``first, second``: the distinct pairs ``first < second`` of ``value`` that share a key.

    ``rows(key, value)`` are about ``count`` rows of whole numbers; repeats are dropped. The shuffled bytes are those of
    the lists, each as often as there are bins that it has values of.
    """
    spark, at_once = rows.sparkSession, setting(rows.sparkSession, "hotRows")
    plain = rows.select(F.col(key).cast("bigint").alias("key"), F.col(value).cast("bigint").alias("value")).where("key IS NOT NULL AND value IS NOT NULL")
    tasks = max(partitions_for(spark, count), math.ceil(count / setting(spark, "taskRows")))
    grouped = plain.repartition(tasks, "key").sortWithinPartitions("key")
    lists, facts = written(
        grouped.mapInArrow(_listed(at_once), LISTS), pairs=F.sum("pairs"), low=F.min("low"), high=F.max("high"),
    )
    if count > at_once:
        free_shuffles(spark)
    pairs, low = facts["pairs"] or 0, facts["low"] or 0
    kind = "<u4" if (facts["high"] or 0) - low < 2**32 else "<u8"
    bins = max(1, math.ceil(pairs / (BIN * at_once)), min(shuffle_partitions(spark), math.ceil(pairs / at_once)))
    bounds = _bounds(lists, pairs, bins)
    pieces = lists.select("low", "sizes", "gaps").mapInArrow(_dealt(bounds, 4 * at_once), PIECES)
    met = pieces.repartitionById(bins, "bin").mapInArrow(_paired(low, kind, at_once), "first bigint, seconds array<bigint>")
    return met.select("first", F.explode("seconds").alias("second"))


def _bounds(lists: DataFrame, pairs: int, bins: int) -> np.ndarray:
    """Least values of all bins but the first, from values drawn at even steps of the pairs that they are first of."""
    if bins == 1:
        return np.zeros(0, np.int64)
    drawn = lists.select("low", "sizes", "gaps").mapInArrow(_drawn(max(1, pairs // (bins * POINTS))), "value bigint")
    points = np.sort(np.array([row[0] for row in drawn.collect()], np.int64))
    return points[np.arange(1, bins) * len(points) // bins] if len(points) else points


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, their lowest bytes first, then the next ones, which are mostly alike."""
    width = 4 if int(numbers.max()) < 2**32 else 8
    planes = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return struct.pack("<BQ", width, len(numbers)) + pa.compress(np.ascontiguousarray(planes), codec="zstd", asbytes=True)


def _opened(value: pa.BinaryScalar) -> np.ndarray:
    """What :func:`_squeezed` has packed."""
    data = memoryview(value.as_buffer())
    width, n = struct.unpack_from("<BQ", data)
    planes = np.frombuffer(pa.decompress(data[9:], n * width, codec="zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}")


def _gaps(values: np.ndarray, starts: np.ndarray, low: int) -> np.ndarray:
    """Steps within ascending lists that begin at ``starts``; a list's first one is from ``low``. They wrap at 2 ** 64, as sums do."""
    whole = values.astype(np.int64).view(np.uint64)
    gaps = np.diff(whole, prepend=whole[:1])
    gaps[starts] = whole[starts] - np.array(low, np.int64).view(np.uint64)
    return gaps


def _summed(gaps: np.ndarray, sizes: np.ndarray, low: int) -> np.ndarray:
    """The values of which :func:`_gaps` gave the steps."""
    total = np.cumsum(gaps, dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    total -= np.repeat(total[starts] - gaps[starts] - np.array(low, np.int64).view(np.uint64), sizes)
    return total.view(np.int64)


def _row(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    return [_opened(batch.column(name)[row]) for name in names]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``size`` of them, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Values, sizes of the lists that they are, and their packed gaps, row by row."""
    for batch in batches:
        for row in range(batch.num_rows):
            sizes, gaps = _row(batch, row, "sizes", "gaps")
            sizes = sizes.astype(np.int64)
            yield _summed(gaps, sizes, batch.column("low")[row].as_py()), sizes, batch.column("gaps")[row].as_py()


def _listed(at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by key as packed lists, those of about ``at_once`` rows together."""

    def pack(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((values, keys))
        keys, values = keys[order], values[order]
        other = np.append(True, keys[1:] != keys[:-1])
        fresh = other | np.append(True, values[1:] != values[:-1])
        keys, values = keys[fresh], values[fresh]
        sizes = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)))
        several = sizes > 1  # a value alone has no partner
        values, sizes = values[np.repeat(several, sizes)], sizes[several]
        if len(sizes):
            low, high, pairs = int(values.min()), int(values.max()), int((sizes * (sizes - 1) // 2).sum())
            gaps = _gaps(values, np.cumsum(sizes) - sizes, low)
            columns = [pa.array([x], pa.int64()) for x in (pairs, low, high)] + [pa.array([_squeezed(x)], pa.binary()) for x in (sizes, gaps)]
            yield pa.RecordBatch.from_arrays(columns, ["pairs", "low", "high", "sizes", "gaps"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, enough = [], 0, at_once
        for batch in batches:
            held.append([batch.column(name).to_numpy() for name in ("key", "value")])
            count += batch.num_rows
            if count < enough:
                continue
            keys, values = (np.concatenate(x) for x in zip(*held))
            whole = int(np.searchsorted(keys, keys[-1]))  # rows of the last key may follow
            if whole:
                yield from pack(keys[:whole], values[:whole])
            held, count = [[keys[whole:].copy(), values[whole:].copy()]], len(keys) - whole
            enough = max(at_once, 2 * count)
        if count:
            yield from pack(*(np.concatenate(x) for x in zip(*held)))

    return work


def _drawn(step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The value that is first of each ``step``-th pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, sizes, packed in _lists(batches):
            pairs = np.cumsum(np.repeat(np.cumsum(sizes), sizes) - np.arange(1, len(values) + 1))
            wanted = np.arange(zlib.crc32(packed) % step, pairs[-1], step)
            yield pa.RecordBatch.from_arrays([pa.array(values[np.searchsorted(pairs, wanted, "right")])], ["value"])

    return work


def _dealt(bounds: np.ndarray, at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each bin the lists' parts from their first value in its range on, with the number of values in it."""
    several = np.unique(bounds[1:][bounds[1:] == bounds[:-1]])  # values that have more than one bin

    def packed(bins: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row for each bin, of lists in the order of their bins."""
        cuts = np.flatnonzero(np.diff(bins, prepend=-1))
        stops = np.append(0, np.cumsum(sizes))
        for a, b in zip(cuts, [*cuts[1:], len(bins)]):
            part, starts = values[stops[a]:stops[b]], stops[a:b] - stops[a]
            low = int(part[starts].min())
            columns = [pa.array([bins[a]], pa.int32()), pa.array([low], pa.int64())]
            columns += [pa.array([_squeezed(x)], pa.binary()) for x in (sizes[a:b], firsts[a:b], _gaps(part, starts, low))]
            yield pa.RecordBatch.from_arrays(columns, ["bin", "low", "sizes", "firsts", "gaps"])

    def plain(values: np.ndarray, starts: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, bins: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(bins, kind="stable")
        starts, firsts, sizes, bins = starts[order], firsts[order], sizes[order], bins[order]
        block = (np.cumsum(sizes) - sizes) // at_once
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(block)]):
            yield from packed(bins[a:b], sizes[a:b], firsts[a:b], values[_ranges(starts[a:b], sizes[a:b])])

    def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Lists of a value with several bins and those of its partners that a bin is dealt."""
        least, shares = (np.searchsorted(bounds, values[starts], side) for side in ("left", "right"))
        shares -= least
        tails = np.cumsum(sizes - 1)
        for a in range(0, int(tails[-1]), at_once):
            place = np.arange(a, min(a + at_once, int(tails[-1])))
            of = np.searchsorted(tails, place, "right")
            seconds = values[starts[of] + 1 + place - (tails[of] - sizes[of] + 1)]
            mixed = (seconds.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            bins = least[of] + 1 + mixed % shares[of]
            order = np.lexsort((of, bins))
            of, bins, seconds = of[order], bins[order], seconds[order]
            cuts = np.flatnonzero(np.diff(bins, prepend=-1) | np.diff(of, prepend=-1))
            lengths = np.diff(np.append(cuts, len(of))) + 1
            yield from packed(bins[cuts], lengths, np.ones(len(cuts), np.int64), np.insert(seconds, cuts, values[starts[of[cuts]]]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values, sizes, _ in _lists(batches):
            ends, bins = np.repeat(np.cumsum(sizes), sizes), np.searchsorted(bounds, values, "right")
            alone = np.isin(values, several)
            begins = np.append(True, (bins[1:] != bins[:-1]) | (ends[1:] != ends[:-1]) | alone[1:] | alone[:-1])
            starts = np.flatnonzero(begins)
            firsts, sizes = np.diff(np.append(starts, len(values))), ends[starts] - starts
            for which, deal in ((~alone[starts], plain), (alone[starts], spread)):
                which &= sizes > 1
                if which.any():
                    more = (firsts[which], sizes[which], bins[starts[which]]) if deal is plain else (sizes[which],)
                    yield from deal(values, starts[which], *more)

    return work


def _paired(low: int, kind: str, at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The larger partners of each first value of the lists, without repeats, about ``at_once`` pairs together.

    Numbers are counted from ``low`` and fit ``kind``.
    """

    def rows(firsts: np.ndarray, sizes: np.ndarray, seconds: np.ndarray) -> pa.RecordBatch:
        base = np.array(low, np.int64).view(np.uint64)
        firsts, seconds = ((x.astype(np.uint64) + base).view(np.int64) for x in (firsts, seconds))
        stops = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(firsts), pa.ListArray.from_arrays(stops, pa.array(seconds))], ["first", "seconds"])

    def together(firsts: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted, without repeats; ``firsts`` are small numbers."""
        if kind == "<u4":
            both = np.sort(firsts.astype(np.uint64) << np.uint64(32) | seconds)
            both = both[np.append(True, both[1:] != both[:-1])]
            return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
        order = np.lexsort((seconds, firsts))
        firsts, seconds = firsts[order], seconds[order]
        fresh = np.append(True, (firsts[1:] != firsts[:-1]) | (seconds[1:] != seconds[:-1]))
        return firsts[fresh], seconds[fresh]

    def many(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Partners of one value with more than ``at_once`` of them, repeats included."""
        found, more, count = np.zeros(0, values.dtype), [], 0
        block = (np.cumsum(sizes) - sizes) // at_once
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(block)]):
            more.append(np.unique(values[_ranges(starts[a:b], sizes[a:b])]))
            count += len(more[-1])
            if count > max(at_once, len(found)):
                found, more, count = np.unique(np.concatenate([found, *more])), [], 0
        return np.unique(np.concatenate([found, *more]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in range(batch.num_rows):
                sizes, firsts, gaps = _row(batch, row, "sizes", "firsts", "gaps")
                values = _summed(gaps, sizes.astype(np.int64), batch.column("low")[row].as_py())
                held.append(((values.view(np.uint64) - np.array(low, np.int64).view(np.uint64)).astype(kind), sizes, firsts))
        if not held:
            return
        values, sizes, firsts = (np.concatenate(x) for x in zip(*held))
        held.clear()
        stops = np.cumsum(sizes, dtype=np.int64)
        starts = _ranges(stops - sizes, firsts.astype(np.int64)) + 1  # of the partners of each first value
        tails = np.repeat(stops, firsts) - starts
        starts, tails = starts[tails > 0], tails[tails > 0]
        order = np.argsort(values[starts - 1], kind="stable")
        starts, tails = starts[order], tails[order]
        names = values[starts - 1]
        cuts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        ends = np.append(cuts[1:], len(names))
        total = np.cumsum(tails)[ends - 1]
        a = 0
        while a < len(cuts):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + at_once, "right")))
            here = slice(cuts[a], ends[b - 1])
            if b == a + 1 and tails[here].sum() > at_once:
                found = many(values, starts[here], tails[here])
                for part in range(0, len(found), at_once):
                    some = found[part:part + at_once]
                    yield rows(names[cuts[a]:cuts[a] + 1], np.array([len(some)]), some)
            else:
                place = np.repeat(np.arange(b - a), ends[a:b] - cuts[a:b])
                place, seconds = together(np.repeat(place, tails[here]), values[_ranges(starts[here], tails[here])])
                yield rows(names[cuts[a:b]], np.bincount(place, minlength=b - a), seconds)
            a = b

    return work
