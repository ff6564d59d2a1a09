"""Language identification by interpolated Kneser-Ney character models.

Letters are small-cased and coded as one of 64 symbols: a boundary for everything that isn't a
letter, 26 for a to z, and hashed classes for all other letters. A model of order 4 looks
at up to three symbols back, never beyond the start of a word. There are at most 64 ** 4 different
keys per language, which bounds every table whatever the corpus.

Executors count the keys of all training texts, Spark adds the counts up. Lower orders
count how many different symbols stand before a key, as Kneser and Ney have it, except at the
start of a word, where they count occurrences. Per order, the keys of all languages are one
sorted array of hashes (the packed symbols, which fit without collision) beside a matrix
of log probabilities, a column per language; another pair of arrays holds the back-off weights.

A text gets the language of the lowest cross-entropy per symbol. A model of the other folds judges a
calibration fold, which gives the chance that this is right, by isotonic regression on the margin, and the
cross-entropy that is usual for each language. Then the calibration fold's counts are added, so the final
model has those of all texts that aren't held out. Texts far beyond it, or with a chance below one half, are
marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edgeloom.llm.common import column_of, crc_fold, table, text_chunks

ORDER = 4
BITS = 6
BOUNDARY = 0
SYMBOLS = 1 << BITS
CHARS = 1_000_000  # characters handled at once
FLUSH = 1_000_000  # different keys a counting task holds before it passes them on
UNKNOWN = "und"
MARGIN_BINS = 64
CALIBRATION_ROWS = 50_000  # of the calibration fold, drawn by a hash of the id
DEVIATIONS = 6.0  # standard deviations beyond the usual cross-entropy that reject


def _symbols() -> np.ndarray:
    """Code point -> symbol."""
    out = np.full(0x110000, BOUNDARY, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if not c.isalpha():
            continue
        low = c.lower()[0]
        if "a" <= low <= "z":
            out[code] = 1 + ord(low) - ord("a")
        else:
            out[code] = 27 + (ord(low) * 2654435761 >> 7) % (SYMBOLS - 27)
    return out


_TABLE: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_symbols())
    return _TABLE[0]


def keys_of(texts: list[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all places of the texts, and the end of each text in them.

    A key packs up to three symbols before a place and its own. Runs of boundaries are one;
    the boundary that ends a word is a place as well, the one before the first word is not.
    """
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    found = symbols[codes]
    kept = np.empty(len(found), bool)
    kept[0] = found[0] != BOUNDARY
    np.logical_or(found[1:] != BOUNDARY, found[:-1] != BOUNDARY, out=kept[1:])
    ends = np.add.accumulate(kept, dtype=np.int64)[np.cumsum(sizes) - 1]
    x = found[kept].astype(np.uint32)
    keys = x.copy()
    before = x
    for back in range(1, ORDER):
        # What stands further back than a boundary counts as boundary.
        earlier = np.zeros_like(x)
        if back == 1:
            earlier[1:] = x[:-1]
        else:
            earlier[back:] = np.where(before[back:] == BOUNDARY, BOUNDARY, x[:-back])
        keys |= earlier << np.uint32(BITS * back)
        before = earlier
    return keys, ends


def _counts(texts: DataFrame) -> DataFrame:
    """``lang, key, n`` over the whole texts of ``texts(lang, text)``."""

    symbols = symbol_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def release() -> Iterator[pa.RecordBatch]:
            for lang, (keys, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts)], ["lang", "key", "n"]
                )
            held.clear()

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in dict.fromkeys(langs.tolist()):
                of_lang = batch.column("text").filter(pa.array(langs == lang))
                for _, chunk in text_chunks(of_lang, CHARS):
                    keys, counts = np.unique(keys_of(chunk, symbols)[0], return_counts=True)
                    if lang in held:
                        keys, at = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                        counts = np.bincount(at, np.concatenate([held[lang][1], counts])).astype(np.int64)
                    held[lang] = keys, counts
            if sum(len(keys) for keys, _ in held.values()) > FLUSH:
                yield from release()
        yield from release()

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discount(adjusted: np.ndarray) -> float:
    once, twice = int((adjusted == 1).sum()), int((adjusted == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def build_model(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> dict:
    """Sorted key arrays with log probabilities per language for orders 1 to ORDER."""
    by_lang = []
    for lang in langs:
        keys, n = counts[lang]
        order = np.argsort(keys)
        levels = [(keys[order].astype(np.int64), n[order].astype(np.float64))]
        for length in range(ORDER - 1, 0, -1):
            longer, number = levels[0]
            short = longer & ((1 << BITS * length) - 1)
            # At the start of a word all keys have the same past, so occurrences count.
            value = np.where(short >> BITS * (length - 1) == BOUNDARY, number, 1.0) if length > 1 else np.ones(len(short))
            unique, at = np.unique(short, return_inverse=True)
            levels.insert(0, (unique, np.bincount(at, value)))
        by_lang.append(levels)
    # Every order's keys are those of any language; an absent key has its backed-off probability.
    lower = np.full((1, len(langs)), 1.0 / SYMBOLS)
    orders, known = [], np.zeros(1, np.int64)
    for length in range(1, ORDER + 1):
        union = np.unique(np.concatenate([levels[length - 1][0] for levels in by_lang]))
        contexts = np.unique(union >> BITS)
        parent = np.searchsorted(known, union & ((1 << BITS * (length - 1)) - 1)) if length > 1 else np.zeros(len(union), np.int64)
        probability = np.empty((len(union), len(langs)))
        backoff = np.ones((len(contexts), len(langs)))
        for i, levels in enumerate(by_lang):
            keys, n = levels[length - 1]
            d = _discount(n)
            place = np.searchsorted(contexts, keys >> BITS)
            total = np.bincount(place, n, minlength=len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            seen = total > 0
            backoff[seen, i] = d * kinds[seen] / total[seen]
            at = np.searchsorted(contexts, union >> BITS)
            probability[:, i] = backoff[at, i] * lower[parent, i]
            mine = np.searchsorted(union, keys)
            probability[mine, i] += np.maximum(n - d, 0) / total[place]
        orders.append({
            "keys": union.astype(np.uint32), "logp": np.log(probability).astype(np.float32),
            "contexts": contexts.astype(np.uint32), "backoff": np.log(backoff).astype(np.float32),
        })
        lower, known = probability, union
    return {"langs": langs, "orders": orders}


def _log_probabilities(model: dict, keys: np.ndarray) -> np.ndarray:
    """Rows of log probabilities of the keys, in every language."""
    out = np.zeros((len(keys), len(model["langs"])), np.float32)
    left = np.arange(len(keys))
    for length in range(ORDER, 0, -1):
        level = model["orders"][length - 1]
        part = keys[left] & np.uint32((1 << BITS * length) - 1)
        slot = np.minimum(np.searchsorted(level["keys"], part), len(level["keys"]) - 1)
        here = level["keys"][slot] == part
        out[left[here]] += level["logp"][slot[here]]
        left, part = left[~here], part[~here]
        if not len(left):
            return out
        slot = np.minimum(np.searchsorted(level["contexts"], part >> np.uint32(BITS)), len(level["contexts"]) - 1)
        has = level["contexts"][slot] == part >> np.uint32(BITS)
        out[left[has]] += level["backoff"][slot[has]]
    out[left] -= np.float32(np.log(SYMBOLS))
    return out


def cross_entropies(model: dict, texts: list[str], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nats per symbol of each text in every language, and the number of symbols; 0 without letters."""
    keys, ends = keys_of(texts, symbols)
    starts = np.concatenate([[0], ends[:-1]])
    length = ends - starts
    sums = np.zeros((len(texts), len(model["langs"])))
    if len(keys):
        logs = _log_probabilities(model, keys)
        some = length > 0
        sums[some] = np.add.reduceat(logs, starts[some], axis=0, dtype=np.float64)
    return -sums / np.maximum(1, length)[:, None], length


def _judge(entropy: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best language, its cross-entropy, and the log of the whole text's margin to the next."""
    best = entropy.argmin(1)
    low = entropy[np.arange(len(entropy)), best]
    if entropy.shape[1] == 1:
        return best, low, np.log1p(length * 1.0)
    second = np.partition(entropy, 1, axis=1)[:, 1]
    return best, low, np.log1p((second - low) * length)


def train_model(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5,
                held_out: int = 0, calibration: int = 1, calibration_rows: int = CALIBRATION_ROWS) -> dict:
    """Count on all folds (:func:`crc_fold`) but ``held_out``; a model without ``calibration`` is calibrated on that.

    Texts without a language or without letters, and rows without an id, teach nothing.
    """
    fold = crc_fold(column_of(docs, doc_id), folds)
    rows = docs.select(
        column_of(docs, doc_id).alias("doc_id"), column_of(docs, lang).cast("string").alias("lang"),
        column_of(docs, text).cast("string").alias("text"), fold.alias("fold"),
    ).where("lang is not null and text is not null and fold is not null")
    first = _counted(rows.where(~F.col("fold").isin(held_out, calibration)))
    second = _counted(rows.where((F.col("fold") == calibration) & (F.col("fold") != held_out)))
    counts = dict(first)
    for name, (keys, n) in second.items():
        if name in counts:
            keys, at = np.unique(np.concatenate([counts[name][0], keys]), return_inverse=True)
            n = np.bincount(at, np.concatenate([counts[name][1], n])).astype(np.int64)
        counts[name] = keys, n
    langs = sorted(counts)
    if not langs:
        return {"langs": []}
    ids = rows.where(F.col("fold") == calibration).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = ids.limit(calibration_rows).distinct()
    known = sorted(first)
    if known:
        found = _calibrated(rows.join(F.broadcast(drawn), "doc_id"), build_model(known, first))
    else:  # nothing to judge by: the prior, and no usual cross-entropy
        found = {"chance": isotonic(np.zeros(MARGIN_BINS), np.zeros(MARGIN_BINS)), "most": np.zeros(0)}
    # A language of the calibration fold alone has no usual cross-entropy.
    most = np.full(len(langs), np.inf)
    most[np.searchsorted(langs, known)] = found["most"]
    return build_model(langs, counts) | {"chance": found["chance"], "most": most}


def _counted(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of each language."""
    counted = _counts(rows).toArrow()  # at most 64 ** 4 keys a language
    names = np.array(counted.column("lang").to_pylist(), object)
    keys, n = counted.column("key").to_numpy(), counted.column("n").to_numpy()
    return {x: (keys[names == x], n[names == x]) for x in sorted(set(names.tolist()))}


def _calibrated(rows: DataFrame, model: dict) -> dict:
    langs = model["langs"]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    symbols = symbol_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            truth = batch.column("lang").to_pylist()
            for low, texts in text_chunks(batch.column("text"), CHARS):
                entropy, length = cross_entropies(shared.value, texts, symbols)
                best, lowest, margin = _judge(entropy, length)
                some = length > 0
                right = np.array([langs[b] == t for b, t in zip(best, truth[low:low + len(texts)])], bool)
                bins = np.minimum((margin * 4).astype(np.int64), MARGIN_BINS - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(best[some]), pa.array(bins[some]), pa.array(right[some].astype(np.int64)),
                    pa.array(lowest[some]), pa.array(lowest[some] ** 2),
                ], ["best", "bin", "right", "h", "h2"])

    schema = "best bigint, bin bigint, right bigint, h double, h2 double"
    facts = rows.select("lang", "text").mapInArrow(run, schema).groupBy("best", "bin").agg(
        F.count("*").alias("n"), F.sum("right").alias("right"), F.sum("h").alias("h"), F.sum("h2").alias("h2")
    ).collect()  # at most a row per language and bin
    n, right = np.zeros(MARGIN_BINS), np.zeros(MARGIN_BINS)
    usual = np.zeros((len(langs), 3))
    for r in facts:
        n[r["bin"]] += r["n"]
        right[r["bin"]] += r["right"]
        usual[r["best"]] += (r["n"], r["h"], r["h2"])
    mean = usual[:, 1] / np.maximum(1, usual[:, 0])
    spread = np.sqrt(np.maximum(0, usual[:, 2] / np.maximum(1, usual[:, 0]) - mean ** 2))
    most = np.where(usual[:, 0] >= 2, mean + DEVIATIONS * np.maximum(spread, 0.02), np.inf)
    return {"chance": isotonic(right, n), "most": most}


def isotonic(right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing share of right ones per bin, by pooling neighbours; a weak prior rises from 1/2."""
    prior = np.linspace(0.5, 1.0, len(n))
    value, weight, width = [], [], []
    for v, w in zip((right + prior) / (n + 1.0), n + 1.0):
        value.append(v)
        weight.append(w)
        width.append(1)
        while len(value) > 1 and value[-2] > value[-1]:
            total = weight[-1] + weight[-2]
            value[-2] = (value[-1] * weight[-1] + value[-2] * weight[-2]) / total
            weight[-2], width[-2] = total, width[-1] + width[-2]
            value.pop(), weight.pop(), width.pop()
    return np.clip(np.repeat(value, width), 0.0, 1.0)


FOUND = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()), ("entropy", pa.float64())])


def predict(docs: DataFrame, model: dict, text: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name``: ``lang_pred, score, rejected, entropy`` (bits per symbol).

    A text that is null or has no letter is ``und`` with score 0, rejected, entropy null; so is every
    text if no language was learned. Ties go to the language first in the alphabet.
    """
    langs = model["langs"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    symbols = symbol_table()

    @F.arrow_udf("struct<lang_pred:string, score:double, rejected:boolean, entropy:double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [pa.array([], FOUND)]
            for _, texts in text_chunks(batch, CHARS):
                if not langs:
                    out.append(pa.array([(UNKNOWN, 0.0, True, None)] * len(texts), FOUND))
                    continue
                entropy, length = cross_entropies(shared.value, texts, symbols)
                best, lowest, margin = _judge(entropy, length)
                chance = shared.value["chance"][np.minimum((margin * 4).astype(np.int64), MARGIN_BINS - 1)]
                odd = (chance < 0.5) | (lowest > shared.value["most"][best])
                none = length == 0
                out.append(pa.StructArray.from_arrays([
                    pa.array([UNKNOWN if x else langs[b] for b, x in zip(best, none)]),
                    pa.array(np.where(none, 0.0, chance)), pa.array(odd | none),
                    pa.array(lowest / np.log(2), mask=none),
                ], fields=list(FOUND)))
            yield pa.concat_arrays(out)

    return docs.withColumn(name, found(column_of(docs, text).cast("string")))


def op1_language_id(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), train_model(docs), name="l")
    held_out = F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False))
    return found.select(
        "doc_id", held_out.alias("held_out"), "l.lang_pred", "l.score", "l.rejected", "l.entropy"
    )
