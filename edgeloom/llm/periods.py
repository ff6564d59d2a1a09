"""Periodic runs of words: longest common extensions by a difference cover, asked on a harmonic grid.

A run with period q and at least 2 q words holds two neighbouring points of the grid 0, q, 2 q, ... of its text.
So for each period the grid's points are asked how far the words from there on, and back from there, agree with those q
words later; together that gives the whole stretch. There are about n ln n such questions for n words, and the
first word of most disagrees. Questions that a few words don't answer go to :class:`Extensions`.

There, suffixes are sampled at the residues of a difference cover: from any two places, fewer than
:data:`COVER_PERIOD` steps lead to places that are both sampled. Only sampled suffixes are sorted: by as many
words as the cover is long, then by doubling, as a sample that many words on is a sample as well. Neighbours' common prefixes
lie in a sparse table, so a question costs a few words and one range minimum. The same on the reversed words looks back.

Texts are worked on in chunks of bounded size by numpy; a longer text is a chunk of its own, and its questions come in blocks
that are answered and dropped one by one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.llm.common import column_of, table, text_chunks

WORD = re.compile("[^\x20\x09-\x0D]+")
LEAST = 12  # words of a run
CHARS = 2_000_000  # of the texts that are handled at once
#: Residues whose differences are all the residues of the period.
COVER_PERIOD, COVER = 21, (0, 1, 4, 14, 16)
SLIDE = 64  # periods up to this are compared at all places of a chunk, larger ones on the grid alone
BLOCK = 500_000  # questions asked at once
WIDE = 256  # words of a stretch from which on its further periods are passed over


def _steps_to_samples() -> np.ndarray:
    """Steps from residues a and b to the first places that are both sampled."""
    sampled = np.isin(np.arange(2 * COVER_PERIOD) % COVER_PERIOD, COVER)
    a, b, step = np.ogrid[:COVER_PERIOD, :COVER_PERIOD, :COVER_PERIOD]
    return np.argmax(sampled[a + step] & sampled[b + step], axis=2)


STEPS = _steps_to_samples()


def compare(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words from ``a`` and ``b`` on (back with ``step`` -1) are equal, ``most`` at most."""
    equal = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    done = 0
    while len(live):
        live = live[words[a[live] + step * done] == words[b[live] + step * done]]
        done += 1
        equal[live] = done
        live = live[most[live] > done]
    return equal


class Extensions:
    """Longest common extensions of two places of the same text.

    ``words`` are numbers from 0 on; ``text_of`` names each place's text. A number that occurs nowhere else
    ends every text, and one stands before the first, so no extension leaves its text.
    """

    def __init__(self, words: np.ndarray, text_of: np.ndarray):
        v = COVER_PERIOD
        self.words = words
        blocks = -(-len(words) // v)
        samples = (np.arange(blocks)[:, None] * v + np.array(COVER)).ravel()
        self.slot = np.full(v, -1)
        self.slot[list(COVER)] = np.arange(len(COVER))
        samples = samples[samples < len(words)]
        self._sort(samples, text_of[samples])

    def _index(self, place: np.ndarray) -> np.ndarray:
        """Number of the sample at a sampled place."""
        return place // COVER_PERIOD * len(COVER) + self.slot[place % COVER_PERIOD]

    def _sort(self, samples: np.ndarray, text: np.ndarray) -> None:
        n, v = len(samples), COVER_PERIOD
        bits = max(1, int(self.words.max()).bit_length())
        packed = 63 // bits
        padded = np.concatenate([self.words, np.zeros(v + packed, self.words.dtype)]).astype(np.int64)
        keys = []
        for first in range(0, v, packed):
            key = np.zeros(n, np.int64)
            for k in range(first, min(first + packed, v)):
                key = key << bits | padded[samples + k]
            keys.append(key)
        keys = [text, *keys]
        order = np.lexsort(keys[::-1])
        new = np.zeros(n, bool)
        new[:1] = True
        for key in keys:
            moved = key[order]
            new[1:] |= moved[1:] != moved[:-1]
        levels, width = [], v
        while True:
            # A rank is where the group of samples that agree on ``width`` words starts in the order.
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = np.empty(n, np.int32)
            rank[order] = start
            levels.append((width, rank))
            tied = np.flatnonzero(~(new & np.append(new[1:], True)))
            if not len(tied):
                break
            # Samples that tie lie in one text, before whose end another sample follows ``width`` words on.
            group, one = start[tied], order[tied]
            after = rank[self._index(samples[one] + width)]
            again = np.lexsort((after, group))
            order[tied] = one[again]
            after, group = after[again], group[again]
            new[tied[1:]] |= (after[1:] != after[:-1]) | (group[1:] != group[:-1])
            width *= 2
        self.rank = rank
        prefix = np.zeros(n, np.int64)
        same_text = np.zeros(n, bool)
        same_text[1:] = text[order][1:] == text[order][:-1]
        at = np.flatnonzero(same_text)
        prefix[at] = self._common_prefixes(samples, levels, order[at - 1], order[at])
        self._table(prefix.astype(np.int32), int(np.bincount(text).max()) if n else 0)

    def _common_prefixes(self, samples, levels, one, two) -> np.ndarray:
        """Words that pairs of samples have in common, from the widest level down, the rest by comparison."""
        a, b = samples[one], samples[two]
        begin = a.copy()
        for width, rank in reversed(levels[:-1]):
            equal = rank[self._index(a)] == rank[self._index(b)]
            a, b = a + width * equal, b + width * equal
        return a - begin + compare(self.words, a, b, np.full(len(a), COVER_PERIOD))

    def _table(self, prefix: np.ndarray, longest: int) -> None:
        """Minima of all stretches of 1, 2, 4, ... prefixes, up to the samples of the longest text."""
        rows, span = [prefix], 1
        while 2 * span <= longest:
            last = rows[-1]
            row = last.copy()
            np.minimum(last[:-span], last[span:], out=row[:-span])
            rows.append(row)
            span *= 2
        self.minima = np.stack(rows)

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from ``a`` and ``b`` on, for places a < b of one text."""
        steps = STEPS[a % COVER_PERIOD, b % COVER_PERIOD]
        equal = compare(self.words, a, b, steps)
        more = np.flatnonzero(equal == steps)
        # A place after its text's end would have met the end's own number before.
        x = self.rank[self._index(a[more] + steps[more])]
        y = self.rank[self._index(b[more] + steps[more])]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        row = np.frexp(high - low + 1)[1] - 1
        width = np.left_shift(1, row)
        equal[more] += np.minimum(self.minima[row, low], self.minima[row, high - width + 1])
        return equal


def _fenced(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a number of its own before the first text and after each; and where each text starts."""
    texts = len(bounds) - 1
    first = bounds[:-1] + np.arange(1, texts + 1)
    fences = np.append(first - 1, len(ids) + texts)
    words = np.empty(len(ids) + texts + 1, np.int64)
    inside = np.ones(len(words), bool)
    inside[fences] = False
    words[inside] = ids
    words[fences] = (int(ids.max()) + 1 if len(ids) else 0) + np.arange(texts + 1)
    return words, first


def _questions(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place and period of the grid's points whose word comes again a period later, in blocks."""
    text_of = np.zeros(len(words), np.int32)
    text_of[first] = 1
    text_of = np.cumsum(text_of, dtype=np.int32) - 1  # a fence belongs to the text before it
    held, n = [], 0
    for q in range(1, min(SLIDE, int(sizes.max()) // 2) + 1):
        place = np.flatnonzero(words[:-q] == words[q:])
        text = text_of[place]
        good = (text == text_of[place + q]) & ((place - first[text]) % q == 0)
        held.append((text[good], place[good], np.full(int(good.sum()), q)))
        n += len(held[-1][0])
        if n >= BLOCK:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n = [], 0
    # Rows of a text and a period; a row has a question for each point of the grid.
    widest = np.maximum(sizes // 2 - SLIDE, 0)
    if not widest.any():
        if held:
            yield tuple(map(np.concatenate, zip(*held)))
        return
    row_text = np.repeat(np.arange(len(sizes)), widest)
    row_period = np.arange(len(row_text)) - np.repeat(np.cumsum(widest) - widest, widest) + SLIDE + 1
    points = (sizes[row_text] - 1) // row_period
    upto = np.cumsum(points)
    low = 0
    while low < len(points):
        done = int(upto[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + BLOCK)))
        count = points[low:high]
        row = np.repeat(np.arange(low, high), count)
        k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        text, q = row_text[row], row_period[row]
        place = first[text] + k * q
        again = words[place] == words[place + q]
        held.append((text[again], place[again], q[again]))
        yield tuple(map(np.concatenate, zip(*held)))
        held, low = [], high


def find_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of all runs, by text, start and period.

    Text k has the word numbers ``ids[bounds[k]:bounds[k + 1]]``. A run is a stretch whose smallest period is q, of at least
    ``least`` and 2 q words, that can't be extended with that period.
    """
    sizes = np.diff(bounds)
    nothing = tuple(np.zeros(0, np.int64) for _ in range(4))
    long = np.flatnonzero(sizes >= max(2, least))
    if not len(long):
        return nothing
    # Shorter texts hold no run and are left out of the work.
    chosen, cut = _part(ids, bounds, long)
    words, first = _fenced(chosen, cut)
    near, asking = [], np.zeros(len(long), bool)
    for text, place, q in _questions(words, first, sizes[long]):
        still = ~asking[text]
        text, place, q = text[still], place[still], q[still]
        ahead, back, answered = _few_words(words, place, q)
        near.append(_stretches(first, text, place - first[text], q, ahead, back, answered, least))
        asking[text[~answered]] = True
    if asking.any():
        near += _by_extensions(chosen, cut, np.flatnonzero(asking), least)
    text, start, length, period = map(np.concatenate, zip(*near))
    # A stretch that two periods found has the smaller one; the other is a multiple of it.
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = long[text[new]], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _part(ids: np.ndarray, bounds: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of some of the texts."""
    cut = np.concatenate([[0], np.cumsum(np.diff(bounds)[texts])])
    chosen = np.repeat(bounds[texts] - cut[:-1], np.diff(cut)) + np.arange(cut[-1])
    return ids[chosen], cut


def _stretches(first, text, place, q, ahead, back, known, least) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of the known stretches that are long enough, each once per period."""
    length = q + ahead + back
    good = np.flatnonzero(known & (length >= np.maximum(least, 2 * q)))
    # A chunk has fewer than 2 ** 31 words, so place and period fit one key; they name a stretch.
    keys = (first[text[good]] + (place - back)[good]) << 31 | q[good]
    good = good[np.unique(keys, return_index=True)[1]]
    return text[good], (place - back)[good], length[good], q[good]


def _few_words(words: np.ndarray, place: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal words ahead and back as far as a few words tell, and whether these answer the question."""
    few = np.full(len(place), COVER_PERIOD)
    ahead = compare(words, place, place + q, few)
    back = compare(words, place - 1, place + q - 1, few, -1)
    return ahead, back, (ahead < COVER_PERIOD) & (back < COVER_PERIOD)


def _by_extensions(ids: np.ndarray, bounds: np.ndarray, asked: np.ndarray, least: int) -> list[tuple[np.ndarray, ...]]:
    """Stretches of all questions of the ``asked`` texts, some of which a few words don't answer.

    The questions are drawn up once more and answered block by block, as a long text of few different words has too many to be held.
    Those that have the answer of a smaller period are passed over: within a stretch, periods are its own one's multiples.
    """
    chosen, cut = _part(ids, bounds, asked)
    words, first = _fenced(chosen, cut)
    # Numbers as small as can be, so that many fit one key.
    words = np.unique(words, return_inverse=True)[1]
    text_of = np.zeros(len(words), np.int64)
    text_of[first[1:]] = 1
    text_of = np.cumsum(text_of)
    ahead_of = Extensions(words, text_of)
    # Backwards, the fence before a text is the one that ends it.
    shifted = np.append(text_of[1:], text_of[-1])
    back_of = Extensions(words[::-1], (len(first) - 1 - shifted)[::-1])
    last, found = len(words) - 1, []
    # A long stretch found so far that a place lies in: where it ends, and its period.
    until, every = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    for text, place, q in _questions(words, first, np.diff(cut)):
        new = (until[place] <= place + q) | (q % every[place] != 0)
        text, place, q = text[new], place[new], q[new]
        ahead, back, _ = _few_words(words, place, q)
        more = ahead == COVER_PERIOD
        ahead[more] = ahead_of.lce(place[more], place[more] + q[more])
        more = back == COVER_PERIOD
        back[more] = back_of.lce(last - (place[more] + q[more] - 1), last - (place[more] - 1))
        t, start, length, period = _stretches(first, text, place - first[text], q, ahead, back, np.ones(len(q), bool), least)
        found.append((asked[t], start, length, period))
        wide = np.flatnonzero(length >= np.maximum(WIDE, 4 * period))
        for k in wide[np.argsort(-period[wide])]:  # of equal stretches, the smallest period is the last to be noted
            low = first[t[k]] + start[k]
            until[low:low + length[k]], every[low:low + length[k]] = low + length[k], period[k]
    return found


PART = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _answers(texts: list[str], least: int) -> tuple[pa.Array, ...]:
    """Words, runs and the text without repeats, of each text."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    split = [WORD.findall(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(bounds[-1]))
    text, start, length, period = find_runs(ids, bounds, least)
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, bounds[text] + start + period, 1)
    np.add.at(gone, bounds[text] + start + length, -1)
    gone = np.cumsum(gone) > 0
    some = set(text.tolist())
    kept = []
    for k, words in enumerate(split):
        if k in some:
            words = [w for w, x in zip(words, gone[bounds[k]:bounds[k + 1]].tolist()) if not x]
        kept.append(" ".join(words))
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(PART))
    return pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), spans), pa.array(kept, pa.string())


def periods(docs: DataFrame, text: str = "text", name: str = "periods", least: int = LEAST) -> DataFrame:
    """``docs`` with a struct ``name``: ``n_words, runs(start, length, period), collapsed``.

    ``runs`` are by start, then period, in word numbers from 0. ``collapsed`` joins by single blanks the words that are
    not in any run after that run's first period. Null and empty texts have no words, no
    runs, and an empty ``collapsed``. Rows are independent of each other; other columns are handed through.
    """

    @F.arrow_udf("struct<n_words:bigint, runs:array<struct<start:bigint, length:bigint, period:bigint>>, collapsed:string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fields = [pa.field("n_words", pa.int64()), pa.field("runs", pa.list_(PART)), pa.field("collapsed", pa.string())]
        for batch in batches:
            out = [pa.array([], pa.struct(fields))]
            for _, texts in text_chunks(batch, CHARS):
                out.append(pa.StructArray.from_arrays(list(_answers(texts, least)), fields=fields))
            yield pa.concat_arrays(out)

    return docs.withColumn(name, found(column_of(docs, text).cast("string")))


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the ids with the words from some place on replaced by repeats of the first of them.

    With h the crc32 of the id and g = h div 10: if h ends in 0, word i >= a is word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) div (3 + g % 8) for n words. Others, and those without an id or words, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    # In a lambda, so that the words are taken once.
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return F.when(h % 10 == 0, F.transform(words, planted)[0]).otherwise(text)


def op12_periodic_runs(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    texts = docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = periods(texts, name="p").select("doc_id", "p.runs", "p.collapsed")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start, r.period)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
