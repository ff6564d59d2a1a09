"""Phrase collocations by Rabin-Karp fingerprints.

Texts are split into pieces at punctuation and line ends, and pieces into words. Prefix polynomials over the words' bytes,
modulo a prime for each of two bases, give the fingerprint of any phrase by a subtraction and a product.

Counting goes in levels: words, pairs of words, longer phrases. A task adds up the fingerprints that it meets, the
shuffle adds up those of all tasks, and fingerprints below the least count fall away. A phrase is at most as frequent as
its parts, so the next level leaves out phrases that hold an infrequent part. What is frequent travels as a filter of a fixed number
of bits: its errors let a phrase through, never keep one out, so a filter that a large corpus fills up costs time, not rows.

Equal fingerprints don't prove equal phrases. A last reading takes the phrases that all levels let through, compares the bytes of
each with those of the first of its fingerprint in the chunk, and passes on one row for each different phrase: text,
count, and a pointer to an occurrence. The shuffle adds these rows up by text, so counts are exact; text is made of
frequent phrases only.

Nothing depends on the size of a group: a frequent phrase is one row for each chunk of texts. Texts are
cut at piece ends into chunks of bounded size; a single piece longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from edgeloom.llm.common import column_of, table
from edgeloom.plans.rounds import shuffle_partitions, written
from edgeloom.plans.skew import lookup, measured_hot_keys

MAX_WORDS, LEAST, TOP = 5, 100, 2000
UNKNOWN = "und"
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
BREAK = re.compile(f"[{BREAKS.decode()}]")
CHARS = 1_000_000  # of the texts that are handled at once
HELD = 2_000_000  # fingerprints that a task adds up before it passes them on
PRIME_BITS = 31
PRIME = np.uint64((1 << PRIME_BITS) - 1)
BASES = (1_000_003, 777_767_777)
FILTER_BITS = 26  # logarithm of the bits of a filter


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, its small letter and its kind: 0 in a word, 1 blank, 2 end of a piece."""
    small, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    small[65:91] += 32
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    return small, kind


SMALL, KIND = _byte_table()


def _reduced(x: np.ndarray) -> np.ndarray:
    """Remainders by the prime of numbers below 2 ** 62, in place."""
    high = x >> np.uint64(PRIME_BITS)
    x &= PRIME
    x += high
    np.right_shift(x, np.uint64(PRIME_BITS), out=high)
    x &= PRIME
    x += high
    return np.subtract(x, PRIME, out=x, where=x >= PRIME)


POWERS: dict[int, np.ndarray] = {}  # of each base, as many as were needed; each task has its own


def _powers(base: int, bits: int) -> np.ndarray:
    """The first 2 ** bits powers of the base, or more.

    Kept in a plain table: what functools wraps for caching travels by name, and executors needn't have this package.
    """
    powers = POWERS.get(base, np.ones(1, np.uint64))
    while len(powers) < 1 << bits:
        step = np.uint64(pow(base, len(powers), int(PRIME)))
        powers = np.concatenate([powers, _reduced(powers * step)])
    POWERS[base] = powers
    return powers


class Chunk:
    """Words of some texts: their bytes with a blank after each, where they start and end, their piece and text."""

    def __init__(self, texts: list[str], salts: np.ndarray):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = SMALL[np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)]
        kind = KIND[raw]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        start, end = edge[::2], edge[1::2]  # the last byte ends a piece, so every word has an end
        begins = np.zeros(len(start) + 1, np.int32)  # words that come after the end of a piece
        begins[np.searchsorted(start, np.flatnonzero(kind == 2))] = 1
        self.piece = np.cumsum(begins[:-1], dtype=np.int32)
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in encoded), np.int64, len(encoded)))
        words = np.searchsorted(start, text_ends)
        self.text = np.repeat(np.arange(len(encoded)), np.diff(words, prepend=0))
        inside[end] = True
        self.data = raw[inside]
        self.end = np.cumsum(end - start + 1) - 1
        self.start = self.end - (end - start)
        self.data[self.end] = 32
        self.salt = salts[self.text]
        n = len(self.data)
        self.bits = max(10, n.bit_length())
        digits = self.data.astype(np.uint64)
        digits += np.uint64(1)
        self.prefix = []
        for base in BASES:
            terms = digits * _powers(base, self.bits)[:n]
            high = terms >> np.uint64(PRIME_BITS)
            terms &= PRIME
            terms += high  # below 2 ** 32, so sums of 2 ** 32 of them fit
            self.prefix.append(np.concatenate([np.zeros(1, np.uint64), _reduced(np.cumsum(terms))]))

    def phrases(self, words: int) -> np.ndarray:
        """First words of all phrases of so many words that lie in one piece."""
        n = len(self.start) - words + 1
        return np.flatnonzero(self.piece[:n] == self.piece[words - 1:]) if n > 0 else np.zeros(0, np.int64)

    def fingerprints(self, first: np.ndarray, words: int, width: int = 2 * PRIME_BITS) -> np.ndarray:
        """Fingerprints of the phrases of so many words from ``first`` on, in their text's language, of ``width`` bits."""
        low, high = self.start[first], self.end[first + words - 1]
        found = np.zeros(len(first), np.uint64)
        for base, prefix in zip(BASES, self.prefix):
            # Divided by the power where the phrase starts, so that it doesn't depend on the place.
            back = _powers(pow(base, -1, int(PRIME)), self.bits)
            part = _reduced((prefix[high] + PRIME - prefix[low])) * back[low]
            found = found << np.uint64(PRIME_BITS) | _reduced(part)
        return (found.view(np.int64) ^ self.salt[first]) & ((1 << width) - 1)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from ``a`` and from ``b`` on are equal."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    equal = np.ones(len(a), bool)
    live, done = np.flatnonzero(a != b), 0
    while len(live):
        left = np.minimum(length[live] - done, 8)
        # Bytes beyond the end are shifted out.
        shift = (8 * (8 - left)).astype(np.uint64)
        match = (eight[a[live] + done] ^ eight[b[live] + done]) << shift == 0
        equal[live[~match]] = False
        done += 8
        live = live[match & (length[live] > done)]
    return equal


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end with a piece."""
    start = 0
    while len(text) - start > CHARS:
        end = BREAK.search(text, start + CHARS)
        if end is None:
            break
        yield text[start:end.end()]
        start = end.end()
    yield text[start:] if start else text


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, np.ndarray, np.ndarray, list[str]]]:
    """Chunks with, for each of their texts: its row, the words of the row before it; and the languages of all rows."""
    langs = batch.column("lang").to_pylist()
    salts = {x: xxhash.xxh64_intdigest(x.encode()) >> 2 for x in set(langs)}
    run: list[tuple[int, str]] = []
    size, carried = 0, (-1, 0)
    for row, value in enumerate(batch.column("text")):
        for part in _parts(value.as_py() or ""):
            run.append((row, part))
            size += len(part) + 1
            if size >= CHARS:
                made = _chunk(run, langs, salts, carried)
                carried = made[-1]
                yield made[:-1]
                run, size = [], 0
    if run:
        yield _chunk(run, langs, salts, carried)[:-1]


def _chunk(run, langs, salts, carried):
    rows = np.array([row for row, _ in run])
    chunk = Chunk([part for _, part in run], np.array([salts[langs[row]] for row in rows], np.int64))
    words = np.bincount(chunk.text, minlength=len(run))
    before = np.zeros(len(run), np.int64)
    for k in range(len(run)):
        if rows[k] == carried[0]:
            before[k] = carried[1]
        carried = rows[k], before[k] + words[k]
    return chunk, rows, before, langs, carried


def _known(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether the filter holds the fingerprints, which it may also say of others."""
    one, two = _slots(prints)
    return (bits[one >> 6] >> (one & 63) & bits[two >> 6] >> (two & 63) & 1).astype(bool)


def _slots(prints):
    """The two bits of a fingerprint: low bits of its two polynomials. For numpy and for columns."""
    if isinstance(prints, Column):
        mask = F.lit((1 << FILTER_BITS) - 1).cast("bigint")
        return prints.bitwiseAND(mask), F.shiftright(prints, PRIME_BITS).bitwiseAND(mask)
    return prints & ((1 << FILTER_BITS) - 1), prints >> PRIME_BITS & ((1 << FILTER_BITS) - 1)


def _filter(frequent: DataFrame) -> np.ndarray:
    """The fingerprints as a filter of 2 ** FILTER_BITS bits, whatever their number."""
    slot = F.explode(F.array(*_slots(F.col("fp"))))
    words = frequent.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits


def _summed(prints: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different fingerprints and their counts."""
    fp = np.concatenate(prints)
    order = np.argsort(fp)
    fp = fp[order]
    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, np.int64)
    return fp[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(fp) else np.zeros(0, np.int64)


def _level(docs: DataFrame, sizes: range, known_words: int, known, width: int) -> DataFrame:
    """``fp, n``: fingerprints of phrases of these sizes, whose parts of ``known_words`` words the filter holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, counts, held = [], [], 0
        for batch in batches:
            for chunk, *_ in _chunks(batch):
                if known is not None:
                    good = np.zeros(len(chunk.start), bool)
                    part = chunk.phrases(known_words)
                    good[part] = _known(known.value, chunk.fingerprints(part, known_words, width))
                for size in sizes:
                    first = chunk.phrases(size)
                    if known is not None:
                        for k in range(size - known_words + 1):
                            first = first[good[first + k]]
                    fp, n = _summed([chunk.fingerprints(first, size, width)], [np.ones(len(first), np.int64)])
                    prints.append(fp)
                    counts.append(n)
                    held += len(fp)
                if held >= HELD:
                    fp, n = _summed(prints, counts)
                    prints, counts, held = [fp], [n], len(fp)
                    if held >= HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(n)], ["fp", "n"])
                        prints, counts, held = [], [], 0
        if held:
            fp, n = _summed(prints, counts)
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(n)], ["fp", "n"])

    return docs.select("lang", "text").mapInArrow(run, "fp bigint, n bigint")


def different(fp: np.ndarray, lang: np.ndarray, low: np.ndarray, length: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and counts of the phrases that differ in language or in their bytes ``data[low:low + length]``."""
    heads, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # A turn takes the first phrase of each fingerprint and all that equal it; others with that fingerprint wait.
    pending = np.argsort(fp, kind="stable")
    while len(pending):
        first = np.flatnonzero(np.concatenate([[True], fp[pending[1:]] != fp[pending[:-1]]]))
        lead = np.repeat(pending[first], np.diff(np.append(first, len(pending))))
        same = (length[pending] == length[lead]) & (lang[pending] == lang[lead])
        at = np.flatnonzero(same)
        same[at] = same_bytes(data, low[pending[at]], low[lead[at]], length[lead[at]])
        heads.append(pending[first])
        counts.append(np.add.reduceat(same.astype(np.int64), first))
        pending = pending[~same]
    return np.concatenate(heads), np.concatenate(counts)


def _known_phrases(chunk: Chunk, bits: np.ndarray, max_words: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, size and fingerprint of the occurrences of phrases that the filter holds, with all their parts."""
    firsts, sizes, prints = [], [], []
    good = np.ones(len(chunk.start) + 1, bool)
    for size in range(1, max_words + 1):
        first = chunk.phrases(size)
        first = first[good[first] & good[first + 1]] if size > 1 else first
        fp = chunk.fingerprints(first, size, width)
        there = _known(bits, fp)
        firsts.append(first[there])
        prints.append(fp[there])
        sizes.append(np.full(int(there.sum()), size))
        good[:] = False
        good[first[there]] = True
    return np.concatenate(firsts), np.concatenate(sizes), np.concatenate(prints)


def _read_phrases(docs: DataFrame, known, max_words: int, width: int) -> DataFrame:
    """``lang, phrase, n, doc_id, word``: phrases that the filter holds, compared byte by byte in each chunk.

    A row without a phrase has the number of words of the chunk in that language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk, rows, before, langs in _chunks(batch):
                names = sorted({langs[r] for r in rows})
                code = {x: k for k, x in enumerate(names)}
                lang = np.array([code[langs[r]] for r in rows])[chunk.text]
                first, size, fp = _known_phrases(chunk, known.value, max_words, width)
                low = chunk.start[first]
                length = chunk.end[first + size - 1] - low
                head, n = different(fp, lang[first], low, length, chunk.data)
                ends = np.concatenate([[0], np.cumsum(length[head])])
                byte = np.repeat(low[head] - ends[:-1], length[head]) + np.arange(ends[-1])
                phrase = pa.StringArray.from_buffers(len(head), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(chunk.data[byte]))
                first = first[head]
                text = chunk.text[first]
                yield _batch(
                    pa.array(names).take(pa.array(lang[first])), phrase, n, ids.take(pa.array(rows[text])),
                    first - np.searchsorted(chunk.text, text) + before[text])
                words = np.bincount(lang, minlength=len(names))
                yield _batch(pa.array(names), pa.nulls(len(names), pa.string()), words, pa.nulls(len(names), ids.type), words)

    def _batch(lang, phrase, n, doc_id, word) -> pa.RecordBatch:
        arrays = [lang, phrase, pa.array(n, pa.int64()), doc_id, pa.array(word, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "n", "doc_id", "word"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"lang string, phrase string, n bigint, doc_id {id_type}, word bigint")


def frequent_phrases(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                     max_words: int = MAX_WORDS, least: int = LEAST, width: int = 2 * PRIME_BITS) -> DataFrame:
    """``lang, phrase, f, doc_id, word``: phrases of 1 to ``max_words`` words that occur ``least`` times in a language.

    The last two columns point to one of the occurrences; which one may change from run to run. Ids that aren't
    whole numbers are given as text.
    A row without a phrase has the number of all words of a language. A null language is ``und``, a null text empty. Rows are
    taken as they are: repeated ones count again. An empty table, or one without words, has no phrases.
    """
    spark = docs.sparkSession
    whole = isinstance(docs.schema[doc_id].dataType, IntegralType)
    rows = docs.select(
        column_of(docs, doc_id).cast("bigint" if whole else "string").alias("doc_id"), column_of(docs, text).cast("string").alias("text"),
        F.coalesce(column_of(docs, lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    found, known, known_words = None, None, 0
    for sizes in (range(1, 2), range(2, min(3, max_words + 1)), range(3, max_words + 1)):
        if not len(sizes):
            break
        level = _level(rows, sizes, known_words, known, width).groupBy("fp").agg(F.sum("n").alias("n"))
        frequent, facts = written(level.where(F.col("n") >= least).select("fp"), n=F.count(F.lit(1)))
        found = frequent if found is None else found.union(frequent)
        if not facts["n"]:
            break
        known, known_words = spark.sparkContext.broadcast(_filter(frequent)), sizes[0]
    read = _read_phrases(rows, spark.sparkContext.broadcast(_filter(found)), max_words, width)
    counted = read.groupBy("lang", "phrase").agg(
        F.sum("n").alias("f"), F.first("doc_id").alias("doc_id"), F.first("word").alias("word"))
    return counted.where((F.col("f") >= least) | F.col("phrase").isNull())


def collocations(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS,
                 least: int = LEAST, top: int = TOP, absorbed: int = 100, width: int = 2 * PRIME_BITS) -> DataFrame:
    """The first ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score, cut, doc_id, word``.

    Of all cuts of a phrase of count ``a`` into two parts of counts ``l`` and ``r``, the one of lowest score
    ``1000 a n / (l r)``, rounded down, counts; of equals the first. ``n`` are the words of the language. A phrase is left
    out if a longer frequent one that holds it has at least ``absorbed`` percent of its count. Order: score, then ``a``,
    both falling, then the phrase by its bytes. Nulls, empty texts, repeated rows: see :func:`frequent_phrases`.
    """
    spark = docs.sparkSession
    counted, facts = written(
        frequent_phrases(docs, doc_id, text, lang, max_words, least, width), n=F.count(F.lit(1)))
    known = counted.where("phrase is not null")
    key = F.struct("lang", "phrase")
    table_of = known.select(key.alias("id"), "f")
    whole = known.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)

    def joined(words: Column) -> Column:
        return F.struct("lang", F.array_join(words, " ").alias("phrase"))

    cut = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")
    cuts = whole.select("lang", "phrase", "f", "w", cut).select(
        key.alias("key"), F.col("f").alias("a"), "cut", joined(F.slice("w", F.lit(1), F.col("cut"))).alias("left"),
        joined(F.slice("w", F.col("cut") + 1, F.size("w") - F.col("cut"))).alias("right"),
    )
    cuts, cut_facts = written(cuts, n=F.count(F.lit(1)))
    for side, name in (("left", "l"), ("right", "r")):
        hot = measured_hot_keys(cuts.select(side), side, cut_facts["n"])
        by = F.struct("key", "cut")
        cuts = lookup(cuts, side, table_of.withColumnRenamed("f", name), hot, by, rows=facts["n"])
    totals = F.broadcast(counted.where("phrase is null").select("lang", F.col("f").alias("n")))  # a row a language
    exact = "cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))"
    score = F.expr(f"({exact}) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = cuts.withColumn("lang", F.col("key.lang")).join(totals, "lang").withColumn("score", score)
    lowest = scored.groupBy("key").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("best")).select("key", "best.*")
    # A phrase inside a longer one is inside one that has a word more, and that is no rarer than the longer one.
    longer = whole.where(F.size("w") > 2).select(F.col("f").alias("longest"), F.explode(F.array(
        joined(F.slice("w", F.lit(1), F.size("w") - 1)), joined(F.slice("w", F.lit(2), F.size("w") - 1)))).alias("key"))
    longer = longer.groupBy("key").agg(F.max("longest").alias("longest"))
    alone = lowest.join(longer, "key", "left").where(F.expr(f"longest is null or 100 * longest < {absorbed} * a"))
    pointers = known.select(key.alias("key"), "doc_id", "word")
    rows = alone.join(pointers, "key").select("key.lang", "key.phrase", "a", "l", "r", "n", "score", "cut", "doc_id", "word")
    # The first of each share of a language, then of these: no task has more than ``top`` rows a share.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(spark)))
    for part in (["lang", share], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        rows = rows.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut", "doc_id", "word")


def op11_collocations(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
