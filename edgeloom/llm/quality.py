"""Quality classifier by gated-attention multiple-instance learning (Ilse and others, 2018).

A document is a bag of passages of 400 characters. Every passage of the whole text is described
by shares of character classes, hashed symbols and character pairs, word repetition and word
length, and encoded by one tanh layer. A gate weighs the passages against each other, and the
weighted sum of their codes gives the score. Only documents have labels; the gate is learned from them.

The model is fitted on the driver on a bounded sample of labelled documents, ``sample_docs``
documents and ``sample_passages`` passages at most, whose features executors compute. If the documents have
more passages, long ones give a part of theirs, drawn by hash: the most that fit, alike for all. It has a
few thousand numbers, whatever the data. Scoring is one pass over all texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.llm.common import code_points, column_of, crc_fold, free_name, table, text_chunks
from edgeloom.plans.rounds import written

PASSAGE = 400
SAMPLE_DOCS = 6_000
SAMPLE_PASSAGES = 120_000
CHARS = 500_000  # features are computed for about so many characters at once

LOWER, UPPER, DIGIT, SPACE, LINE, OTHER = range(6)
SYMBOLS, PAIRS = 32, 64
FEATURES = 6 + SYMBOLS + PAIRS + 7


def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x3000):
        c = chr(code)
        if c in "\n\r":
            table[code] = LINE
        elif c.isspace():
            table[code] = SPACE
        elif c.isdigit():
            table[code] = DIGIT
        elif c.isalpha():
            table[code] = UPPER if c.isupper() else LOWER
    table[0x3040:0xD800] = LOWER  # scripts without case
    table[0xF900:0xFE00] = LOWER
    table[0x20000:0x30000] = LOWER
    return table


CLASS = _classes()


def passage_features(texts: list[str], passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for every passage, and the number of passages of each text.

    A text without characters is one passage of zeros.
    """
    codes, ends = code_points(texts)
    size = np.diff(ends, prepend=0) - 1
    many = np.maximum(1, -(-size // passage))
    first = np.cumsum(many) - many
    text = np.repeat(np.arange(len(texts)), size + 1)
    spot = np.arange(len(codes)) - (ends - size - 1)[text]
    inside = spot < size[text]
    codes, text, spot = codes[inside], text[inside], spot[inside]
    row = first[text] + spot // passage
    total = int(many.sum())
    out = np.zeros((total, FEATURES))
    length = np.bincount(row, minlength=total)
    if not len(codes):
        return out, many
    kind = CLASS[codes]
    share = 1.0 / np.maximum(1, length)

    def histogram(buckets: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows * n + buckets, minlength=total * n).reshape(total, n)

    out[:, :6] = histogram(kind, row, 6) * share[:, None]
    marks = np.flatnonzero(kind == OTHER)
    symbol = (codes[marks] * np.uint32(2654435761) >> np.uint32(27)).astype(np.int64)
    out[:, 6:6 + SYMBOLS] = histogram(symbol, row[marks], SYMBOLS) * share[:, None]
    small = np.where(kind == UPPER, codes | np.uint32(32), codes)
    pair = ((small[:-1] * np.uint32(0x01000193) ^ small[1:]) * np.uint32(2654435761) >> np.uint32(26)).astype(np.int64)
    same = row[:-1] == row[1:]
    at = 6 + SYMBOLS
    out[:, at:at + PAIRS] = np.sqrt(histogram(pair[same], row[:-1][same], PAIRS) * share[:, None])

    # Words: runs without white space; a word belongs to the passage that it starts in.
    word = kind < SPACE
    word |= kind == OTHER
    begins = word.copy()
    begins[1:] &= ~word[:-1] | (text[1:] != text[:-1])
    start = np.flatnonzero(begins)
    if len(start):
        number = np.cumsum(begins) - 1
        salted = small.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        salted ^= salted >> np.uint64(29)
        place = np.arange(len(codes)) - start[np.maximum(number, 0)]
        salted *= (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        salted[~word] = 0
        hashes = np.add.reduceat(salted, start)
        lengths = np.add.reduceat(word, start, dtype=np.int64)
        owner = row[start]
        words = np.bincount(owner, minlength=total)
        per = 1.0 / np.maximum(1, words)
        again = np.zeros(len(start), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (text[start][1:] == text[start][:-1])
        order = np.lexsort((hashes, owner))
        new = np.ones(len(start), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        ends_odd = kind[np.minimum(start + lengths - 1, len(kind) - 1)] == OTHER
        k = at + PAIRS
        out[:, k] = np.bincount(owner[again], minlength=total) * per
        out[:, k + 1] = np.bincount(owner[order][new], minlength=total) * per
        out[:, k + 2] = np.bincount(owner, lengths, minlength=total) * per / 10
        out[:, k + 3] = np.bincount(owner, lengths > 15, minlength=total) * per
        out[:, k + 4] = np.bincount(owner, ends_odd, minlength=total) * per
        out[:, k + 5] = np.bincount(owner, lengths == 1, minlength=total) * per
        out[:, k + 6] = words * share
    return out, many


@dataclass
class Attention:
    """Weights of the encoder, the gate and the score, with the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each bag of ``many`` passages, and the weight of each passage in its bag."""
        forward = _forward(self.weights, (features - self.mean) / self.scale, many)
        return forward["p"], forward["a"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, many: np.ndarray) -> dict[str, np.ndarray]:
    first = np.cumsum(many) - many
    h = np.tanh(x @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (t * g) @ w["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), many))
    a = e / np.repeat(np.add.reduceat(e, first), many)
    z = np.add.reduceat(h * a[:, None], first, axis=0)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["o"] + w["c"])}


def fit(features: np.ndarray, many: np.ndarray, labels: np.ndarray, width: int = 24, gate: int = 12,
        epochs: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Attention:
    """Fit by Adam on the log loss of the documents. One label only gives a constant score."""
    rng = np.random.default_rng(seed)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    x = (features - mean) / scale
    n = x.shape[1]
    prior = (labels.sum() + 0.5) / (len(labels) + 1.0)
    w = {
        "W": rng.normal(0, n ** -0.5, (n, width)), "b": np.zeros(width),
        "V": rng.normal(0, width ** -0.5, (width, gate)), "U": rng.normal(0, width ** -0.5, (width, gate)),
        "w": rng.normal(0, gate ** -0.5, gate), "o": np.zeros(width), "c": np.log(prior / (1 - prior)),
    }
    if labels.min() == labels.max():
        return Attention(mean, scale, w)
    m, v, step = {k: 0.0 for k in w}, {k: 0.0 for k in w}, 0
    first = np.cumsum(many) - many
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        speed = rate * (1 - epoch / epochs) + 1e-4
        for low in range(0, len(order), batch):
            bags = order[low:low + batch]
            size = many[bags]
            rows = np.repeat(first[bags], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            part = x[rows]
            f = _forward(w, part, size)
            start = np.cumsum(size) - size
            d = (f["p"] - labels[bags]) / len(bags)
            dz = d[:, None] * w["o"]
            of_bag = np.repeat(dz, size, axis=0)
            da = (of_bag * f["h"]).sum(1)
            de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, start), size))
            tg = f["t"] * f["g"]
            dt = de[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = de[:, None] * w["w"] * tg * (1 - f["g"])
            dh = of_bag * f["a"][:, None] + dt @ w["V"].T + dg @ w["U"].T
            dpre = dh * (1 - f["h"] ** 2)
            grad = {
                "W": part.T @ dpre, "b": dpre.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": tg.T @ de, "o": f["z"].T @ d, "c": d.sum(),
            }
            step += 1
            for k in w:
                g = grad[k] + decay * w[k] * (k in "WVU")
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - speed * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Attention(mean, scale, w)


def _share(sizes: np.ndarray, most: int) -> int:
    """The largest number of passages that each document may give, 1 at least, so that all give ``most`` at most."""
    low, high = 1, int(sizes.max(initial=1))
    while low < high:
        middle = (low + high + 1) // 2
        if int(np.minimum(sizes, middle).sum()) <= most:
            low = middle
        else:
            high = middle - 1
    return low


def _drawn(doc: str, total: int, share: int) -> np.ndarray:
    """The places, in order, of the passages that a document of ``total`` gives."""
    if total <= share:
        return np.arange(total)
    rng = np.random.default_rng(zlib.crc32(doc.encode("utf-8", "surrogatepass")))
    return np.sort(rng.choice(total, share, replace=False))


def _sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, skip_fold: int,
             folds: int, most_docs: int, most_passages: int) -> tuple[DataFrame, int]:
    """``doc, text, label`` of the labelled documents to learn from, and how many passages each may give.

    Documents are taken in the order of a hash of their ids, up to ``most_docs``, however long they are. A document with
    several labels has the higher one; of rows with one id any counts.
    """
    known = (
        labels.select(column_of(labels, doc_id).alias("doc"), column_of(labels, label).cast("int").alias("label"))
        .where("doc is not null and label in (0, 1)")
        .where(F.coalesce(crc_fold("doc", folds), F.lit(skip_fold)) != skip_fold)
        .groupBy("doc").agg(F.max("label").alias("label"))
    )
    texts = docs.select(column_of(docs, doc_id).alias("doc"), column_of(docs, text).cast("string").alias("text"))
    # Twice as many: a label may lack its document.
    drawn = known.orderBy(F.xxhash64("doc"), "doc").limit(2 * most_docs)
    sizes = (
        texts.select("doc", F.coalesce(F.length("text"), F.lit(0)).alias("n")).join(F.broadcast(drawn), "doc")
        .groupBy("doc", "label").agg(F.max("n").alias("n"))
    )
    passages = F.greatest(F.lit(1), F.ceil(F.col("n") / PASSAGE)).cast("bigint")
    # More documents than passages can't all give one.
    taken = sizes.orderBy(F.xxhash64("doc"), "doc").limit(min(most_docs, most_passages)).select("doc", "label", passages.alias("passages"))
    taken, _ = written(taken)
    share = _share(taken.select("passages").toArrow().column(0).to_numpy(), most_passages)
    return texts.join(F.broadcast(taken.select("doc", "label")), "doc").select("doc", "text", "label"), share


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          skip_fold: int = 1, folds: int = 3, sample_docs: int = SAMPLE_DOCS,
          sample_passages: int = SAMPLE_PASSAGES) -> Attention:
    """Fit on labelled documents whose fold (:func:`crc_fold`) is not ``skip_fold``.

    Without any labelled document every score is 0.5.
    """
    sample, share = _sampled(docs, labels, doc_id, text, label, skip_fold, folds, sample_docs, sample_passages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc").cast(pa.string()), batch.column("label")
            for low, texts in text_chunks(batch.column("text"), CHARS):
                names = ids.slice(low, len(texts))
                for k, (doc, t) in enumerate(zip(names.to_pylist(), texts)):
                    total = max(1, -(-len(t) // PASSAGE))
                    if total > share:  # passages are described one by one, so those drawn may stand together
                        t = "".join(t[i * PASSAGE:(i + 1) * PASSAGE] for i in _drawn(doc, total, share).tolist())
                        texts[k] = t
                features, many = passage_features(texts)
                rows = np.split(features.astype(np.float32), np.cumsum(many)[:-1])
                yield pa.RecordBatch.from_arrays([
                    names, marks.slice(low, len(texts)), pa.array([r.tobytes() for r in rows], pa.binary()),
                ], ["doc", "label", "features"])

    plain = sample.select(F.col("doc").cast("string").alias("doc"), "text", "label")
    rows = plain.mapInArrow(run, "doc string, label int, features binary").toArrow().to_pylist()
    bags = {r["doc"]: r for r in sorted(rows, key=lambda r: (r["doc"], r["features"]))}
    if not bags:
        zero = {"W": np.zeros((FEATURES, 1)), "b": np.zeros(1), "V": np.zeros((1, 1)), "U": np.zeros((1, 1)),
                "w": np.zeros(1), "o": np.zeros(1), "c": np.float64(0)}
        return Attention(np.zeros(FEATURES), np.ones(FEATURES), zero)
    parts = [np.frombuffer(r["features"], np.float32).reshape(-1, FEATURES) for r in bags.values()]
    marks = np.array([r["label"] for r in bags.values()], float)
    return fit(np.concatenate(parts).astype(float), np.array([len(p) for p in parts]), marks)


def score(docs: DataFrame, model: Attention, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text, from 0 to 1; null counts as empty."""
    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [np.zeros(0)]
            for _, texts in text_chunks(batch, CHARS):
                found.append(model.scores(*passage_features(texts))[0])
            yield pa.array(np.concatenate(found))

    return docs.withColumn(name, scored(column_of(docs, text).cast("string")))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose score is below ``least``."""
    name = free_name(docs, "_score")
    marked = score(docs, train(docs, labels, text=text, **options), text, name)
    return marked.where(column_of(marked, name) >= least).drop(name)


def op4_quality(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, folder, "labels")))
    held_out: Column = F.coalesce(crc_fold("doc_id", 3) == 1, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
