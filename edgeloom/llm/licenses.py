"""Licence scans: MinHash bands over overlapping text windows find templates, containment verifies.

Words are small-cased runs of letters and digits, shingles are five of them in a row (all words of
a template that has fewer). Templates of similar numbers of shingles form a class. Texts are cut into
overlapping windows for each class, so that every stretch as long as its templates lies in one; for templates of
:data:`REACH_FROM` shingles and more also a stretch half as long again, so they may hold insertions. If a window
holds 80 % of a template's shingles, that bounds their Jaccard similarity from below. Each class gets as many
bands as make the chance to miss such a window less than one in ten thousand. With bands of one hash that takes the fewest hashes;
windows that share no shingle with a template are still almost never taken for one.

Every found pair of window and template is verified: the exact share of the template's shingles that
the window holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edgeloom.llm.common import column_of, table
from edgeloom.llm.decontaminate import BASE, _mix, word_hashes
from edgeloom.llm.notices import notices

SHINGLE = 5
LEAST = 0.8
PER_BAND = 1
ALIKE = 1.25  # templates of a class have up to so many times the shingles of the smallest
REACH, REACH_FROM = 1.5, 20  # fewer shingles can't spare the ones that an insertion costs
MISS = 1e-4
TEMPLATES_PER_PASS = 1_000
CHUNK_BYTES = 2_000_000

NOTICE_ROWS = notices()
TEMPLATES = {name: text for name, _, _, text in NOTICE_ROWS}


def template_table(spark: SparkSession) -> DataFrame:
    """``template_id, spdx, family, text``: the notices of :mod:`edgeloom.llm.notices`."""
    return spark.createDataFrame(NOTICE_ROWS, "template_id string, spdx string, family string, text string")


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; runs may cross from one text to the next."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = _mix(total * BASE + hashes[k:k + n])
    return total


def bands_for(size: int, window: int, least: float) -> int:
    """Bands by which a window with ``least`` of ``size`` shingles is missed less often than MISS."""
    shared = min(size, math.ceil(least * size - 1e-9))
    similarity = shared / (size + window - shared)
    hit = similarity ** PER_BAND
    return 1 if hit >= 1 else math.ceil(math.log(MISS) / math.log(1 - hit))


def _salt(band: int, nth: int) -> np.uint64:
    return _mix(np.array([(band * PER_BAND + nth + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1], np.uint64))[0] | np.uint64(1)


def banded(values: np.ndarray, windows: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
    """Band hashes for ``windows`` of (number of shingles, bands, places), as number of the window and hashes.

    A window's minimum is that of two runs whose length is a power of two; all windows share these runs.
    """
    for band in range(max((bands for _, bands, _ in windows), default=0)):
        active = [i for i, (_, bands, places) in enumerate(windows) if band < bands and len(places)]
        totals = {i: np.full(len(windows[i][2]), band, np.uint64) for i in active}
        for nth in range(PER_BAND):
            runs = [((values * _salt(band, nth)) >> np.uint64(32)).astype(np.uint32)]
            for i in active:
                span, _, places = windows[i]
                level = span.bit_length() - 1
                while len(runs) <= level:
                    reach = 1 << len(runs) - 1
                    runs.append(np.minimum(runs[-1][:-reach], runs[-1][reach:]))
                least = runs[level][places]
                if span > 1 << level:
                    least = np.minimum(least, runs[level][places + (span - (1 << level))])
                totals[i] = _mix(totals[i] * BASE + least)
        for i in active:
            yield i, totals[i]


def build_index(templates: list[tuple[str, str]], least: float = LEAST) -> list[dict]:
    """One index per shingle width and class of sizes, so that windows fit the templates."""
    shapes: dict[int, list[tuple[int, str, np.ndarray]]] = {}
    for name, text in templates:
        data = (text or "").encode("utf-8", "surrogatepass")
        hashes = word_hashes(data, np.array([0, len(data)]))[0] if data else np.zeros(0, np.uint64)
        if not len(hashes):
            continue
        width = min(SHINGLE, len(hashes))
        found = shingles(hashes, width)
        shapes.setdefault(width, []).append((len(found), name, found))
    out = []
    for width, members in sorted(shapes.items()):
        members.sort(key=lambda m: m[:2])
        while members:
            size = members[0][0]
            # What can't spare a shingle is looked for as it is.
            most = size if math.ceil(least * size - 1e-9) == size else size * ALIKE
            out.append(_class(width, [m for m in members if m[0] <= most], least))
            members = [m for m in members if m[0] > most]
    return out


def _class(width: int, members: list[tuple[int, str, np.ndarray]], least: float) -> dict:
    size, largest = members[0][0], members[-1][0]
    step = max(1, size // 8)
    window = (largest if size < REACH_FROM else math.ceil(REACH * largest)) + step - 1
    sets = [np.unique(v) for *_, v in members]  # repeats make a template's set smaller
    bands = max(bands_for(len(v), window, least) for v in sets)
    keys, owners = [], []
    for number, (own, _, values) in enumerate(members):
        for _, band in banded(values, [(own, bands, np.zeros(1, np.int64))]):
            keys.append(band[0])
            owners.append(number)
    order = np.argsort(np.array(keys, np.uint64), kind="stable")
    keys = np.array(keys, np.uint64)[order]
    begins = np.zeros(1 << 16, bool)
    begins[keys >> np.uint64(48)] = True
    return {
        "width": width, "step": step, "window": window, "bands": bands, "needed": math.ceil(least * min(map(len, sets)) - 1e-9),
        "keys": keys, "begins": begins, "owners": np.array(owners)[order], "names": [n for _, n, _ in members], "sets": sets,
    }


def scan(texts: list[bytes], index: list[dict], least: float = LEAST) -> list[dict[str, tuple[float, int, int]]]:
    """Per text: template -> best share, and the first word and the end of the words that hold it in that window."""
    found: list[dict[str, tuple[float, int, int]]] = [{} for _ in texts]
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = b"".join(texts)
    if not data:
        return found
    hashes, _, _, first = word_hashes(data, cuts)
    for width in sorted({shape["width"] for shape in index}):
        shapes = [s for s in index if s["width"] == width]
        values = shingles(hashes, width)
        low, high = first[:-1], first[1:] - width + 1  # the shingles of each text
        length = np.maximum(0, high - low)
        # A window may reach beyond a short text; what follows is none of the text's, and room is left after the last.
        room = max(s["window"] for s in shapes)
        padded = np.concatenate([values, _mix(np.arange(1, room + 1).astype(np.uint64))])
        windows, about = [], []
        for shape in shapes:
            span, step = shape["window"], shape["step"]
            many = np.where(length >= max(1, shape["needed"]), -(-np.maximum(0, length - span) // step) + 1, 0)
            text = np.repeat(np.arange(len(texts)), many)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
            windows.append((span, shape["bands"], np.maximum(low[text], np.minimum(low[text] + nth * step, high[text] - span))))
            about.append((shape, text))
        pairs: list[set[tuple[int, int]]] = [set() for _ in windows]
        for i, band in banded(padded, windows):
            shape = about[i][0]
            keys, owners = shape["keys"], shape["owners"]
            likely = np.flatnonzero(shape["begins"][band >> np.uint64(48)])
            left = np.searchsorted(keys, band[likely])
            hit = keys[np.minimum(left, len(keys) - 1)] == band[likely]
            for h, at in zip(likely[hit].tolist(), left[hit].tolist()):
                while at < len(keys) and keys[at] == band[h]:
                    pairs[i].add((h, int(owners[at])))
                    at += 1
        for (span, _, places), (shape, text), met in zip(windows, about, pairs):
            for h, owner in sorted(met):
                t, start = int(text[h]), int(places[h])
                _contain(shape, owner, values[start:min(start + span, int(high[t]))], t, int(start - low[t]), least, found)
    return found


def _contain(shape: dict, owner: int, window: np.ndarray, text: int, word: int, least: float, found: list) -> None:
    wanted = shape["sets"][owner]
    there = np.flatnonzero(np.isin(window, wanted))
    share = len(np.unique(window[there])) / len(wanted)
    name = shape["names"][owner]
    if share >= least and share > found[text].get(name, (0.0, 0, 0))[0]:
        found[text][name] = (share, word + int(there[0]), word + int(there[-1]) + shape["width"])


def _matcher(index: list[dict], least: float):
    @F.arrow_udf(MATCH)
    def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[list[dict]] = []
            held: list[bytes] = []
            size = 0
            for value in batch:
                held.append((value.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(held[-1])
                if size > CHUNK_BYTES:
                    out += map(_listed, scan(held, index, least))
                    held, size = [], 0
            out += map(_listed, scan(held, index, least))
            yield pa.array(out, MATCH_TYPE)

    return matches


MATCH = "array<struct<template_id:string, share:double, first_word:bigint, end_word:bigint>>"
MATCH_TYPE = pa.list_(pa.struct([
    ("template_id", pa.string()), ("share", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64()),
]))


def license_matches(docs: DataFrame, templates: DataFrame, text: str = "text", template_id: str = "template_id",
                    template_text: str = "text", least: float = LEAST, name: str = "licenses",
                    per_pass: int = TEMPLATES_PER_PASS) -> DataFrame:
    """``docs`` with an array ``name`` of the templates whose shingles a text holds to ``least`` or more.

    Each template is listed once, with the words of the first window that holds most of it. Null and empty texts hold
    none; templates without words or id are left out; equal templates under several ids
    are all listed. Many templates are searched in passes of ``per_pass``, which executors hold.
    """
    known = templates.select(
        column_of(templates, template_id).cast("string").alias("id"), column_of(templates, template_text).cast("string").alias("text")
    ).where("id is not null and text is not null").distinct()
    passes = max(1, -(-known.count() // per_pass))
    empty = F.array().cast(MATCH)
    docs = docs.withColumn(name, empty)
    for k in range(passes):
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k).toArrow().to_pylist()
        index = build_index(sorted((r["id"], r["text"]) for r in part), least)

        found = _matcher(index, least)(column_of(docs, text).cast("string"))
        docs = docs.withColumn(name, F.concat(column_of(docs, name), found))
    return docs


def best_of_family(matches: str, templates: DataFrame, template_id: str = "template_id", family: str = "family") -> Column:
    """The array ``matches`` without those that a better match of the same family overlaps.

    Better is the larger share, then the longer stretch of words. Templates without a family are families of their own.
    The table of templates is taken to the driver, as by :func:`license_matches` in passes; it should be small.
    """
    rows = templates.select(column_of(templates, template_id).cast("string"), column_of(templates, family).cast("string")).collect()
    of = F.create_map(*[F.lit(x) for name, kind in rows if name is not None for x in (name, kind or name)])

    def worse(x: Column, y: Column) -> Column:
        overlap = (x["first_word"] < y["end_word"]) & (y["first_word"] < x["end_word"])
        less = F.struct(x["share"], x["end_word"] - x["first_word"]) < F.struct(y["share"], y["end_word"] - y["first_word"])
        return (of[x["template_id"]] == of[y["template_id"]]) & overlap & less

    return F.filter(matches, lambda x: ~F.exists(matches, lambda y: worse(x, y)))


def _listed(found: dict[str, tuple[float, int, int]]) -> list[dict]:
    return [
        {"template_id": n, "share": s, "first_word": a, "end_word": b} for n, (s, a, b) in sorted(found.items())
    ]


def op10_license_scan(spark, folder: str) -> DataFrame:
    """Notices of each document, the best of those that overlap: versions of a header differ in a word or two."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    templates = template_table(spark)
    found = license_matches(docs, templates, name="all").withColumn("m", best_of_family("all", templates))
    spdx = F.create_map(*[F.lit(x) for name, of, *_ in NOTICE_ROWS for x in (name, of)])
    return found.select(
        "doc_id", F.size("m").alias("n_licenses"),
        F.array_join(F.array_sort(F.transform("m", lambda x: x["template_id"])), ",").alias("licenses"),
        F.array_max(F.transform("m", lambda x: x["share"])).alias("best_share"),
        F.transform("m", lambda x: x["first_word"]).alias("first_words"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: spdx[x["template_id"]]))), ",").alias("spdx"),
    )
