"""Token ids as compressed binary blocks: an adaptive context-mixing range coder.

An id of 16 bits is coded as four nibbles. For each nibble models foresee a distribution:
order 0 by the nibbles before it in the id, order 1 and 2 by hashes of those and of the one or two ids
before. The distributions are mixed by weights that follow how well each model did, and
the mix drives a carry-less range coder. Models and weights learn after each id; its nibbles share none, so this
is the same as learning after each nibble. All arithmetic is on integers, or single IEEE operations
followed by rounding down, so every machine decodes alike.

A block holds up to :data:`BLOCK` ids and starts afresh: it can be decoded alone, and a checksum
covers all of it. Many blocks are coded in step, one lane each, by numpy.

File format: a Parquet table of ``part, block, payload``, so that Spark commits, retries and
reads it on any store. A payload is, in little-endian order: magic ``CMR2``, crc32 of what
follows, number of ids, number of document ends ``n``; then ``n`` positions of document ends in the
block, their ``n`` ids of documents and ``n`` flags (1: the document has an id), and the coder's words of 3 bytes. Parts and blocks are in the order of the documents.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from edgeloom.llm.common import column_of, table, text_chunks
from edgeloom.plans.rounds import written

BLOCK = 8192
LANES = 768
BATCH_CHARS = 8_000_000  # of texts that are encoded at once
REMEMBERED = 6_000_000  # characters of the words whose ids a task keeps, and ten for each word
END_ID = 1
MAGIC = b"CMR2"

TOTAL_BITS = 15
TOTAL = np.uint16((1 << TOTAL_BITS) - 1)  # as a mask: counts are modulo 1 << TOTAL_BITS
SCALE = (1 << TOTAL_BITS) - 16  # what the models' counts add up to; 16 more keep every nibble possible
ORDER0, HASHED_BITS = 1 + 16 + 256 + 4096, 8
HASHED = 1 << HASHED_BITS  # of each hashed order and nibble
ROWS = ORDER0 + 2 * 4 * HASHED  # of each lane's models
RATE = 4
ORDERS = 3
MODELS = (3, 3, 3, 3)  # orders that are mixed for each nibble
START = np.array([[0], [1], [17], [273]], np.uint32)  # first order-0 row of each nibble
ALL = slice(0, 4)  # nibbles
PATHS = np.array([[16], [12], [8], [4], [0]], np.uint32)  # by which ids are shifted for what comes before each nibble
NONE = np.zeros(0, np.int64)
# The coder's interval lies in 56 bits; the upper 24 of them are the next word.
WINDOW, WORD = 56, 24
LEAST = np.uint64(1 << WINDOW - WORD)
#: Where each symbol moves the cumulative counts, of the symbols before each, to.
TARGETS = np.where(np.arange(16)[None, :] > np.arange(16)[:, None], SCALE, 0).astype(np.int16)
#: Rows of sixteen equal numbers, by which rows of counts are multiplied without a loop over rows.
SHARES = np.repeat(np.arange(17, dtype=np.int16), 16).reshape(17, 16)
ROW = np.dtype("V32")  # sixteen counts as one item: numpy takes and puts items faster than rows


class _Lanes:
    """Models and range coders of many blocks, for the id that all of them are at.

    The nibbles of an id have rows of their own, so the models learn all four at once, after the id.
    """

    def __init__(self, lanes: int):
        even = (np.arange(16) * (SCALE // 16)).astype(np.int16)
        self.tables = np.tile(even, (lanes * ROWS, 1)).view(ROW).ravel()
        mixed = (np.arange(ORDERS) < np.array(MODELS)[:, None])[:, :, None]
        self.least = (256 * mixed).astype(np.float32)
        self.weights = (16384 // np.array(MODELS)[:, None, None] * mixed * np.ones(lanes)).astype(np.float32)
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << WINDOW) - 1, np.uint64)
        self.shrink(lanes)

    def shrink(self, n: int) -> None:
        """Go on with the first ``n`` lanes."""
        self.weights = np.ascontiguousarray(self.weights[:, :, :n])
        self.low, self.range = self.low[:n], self.range[:n]
        self.base = np.arange(n) * ROWS
        self.hashed = self.base + (ORDER0 + HASHED * np.arange(8)).reshape(4, 2, 1)
        self.place = np.arange(4 * ORDERS * n).reshape(4, ORDERS, n) * 16
        self.index = np.empty((4, ORDERS, n), np.int64)
        self.counts, self.spare, self.factors = (np.empty((4, ORDERS, n, 16), np.int16) for _ in range(3))
        self.one_each = np.tile(np.arange(16, dtype=np.int16), (n, 1))
        self.share()

    def share(self) -> None:
        """Sixteenths that the models have in the mix."""
        share = (self.weights * np.float32(1 / 1024)).astype(np.int16)
        share[:, 0] = 16 - share[:, 1] - share[:, 2]
        SHARES.take(share.ravel(), axis=0, mode="clip", out=self.factors.reshape(-1, 16))

    def context(self, one: np.ndarray, two: np.ndarray) -> None:
        """The ids one and two places back."""
        one = one * np.uint32(0x9E3779B1) + np.uint32(1)
        self.hash = np.stack([one, (one ^ two) * np.uint32(0x85EBCA6B) + np.uint32(2)])

    def foresee(self, nibbles: slice, path: np.ndarray) -> np.ndarray:
        """Cumulative counts of the mix, for each of the nibbles after its ``path``."""
        path = path + START[nibbles]
        rows = self.hash ^ (path * np.uint32(0xC2B2AE35))[:, None]
        rows *= np.uint32(0x27D4EB2F)
        rows >>= np.uint32(32 - HASHED_BITS)
        index, counts, terms = self.index[nibbles], self.counts[nibbles], self.spare[nibbles]
        np.add(self.base, path, out=index[:, 0])
        np.add(self.hashed[nibbles], rows, out=index[:, 1:])
        self.tables.take(index.ravel(), mode="clip", out=counts.reshape(-1).view(ROW))
        np.right_shift(counts, 4, out=terms)
        terms *= self.factors[nibbles]
        mix = terms[:, 0] + terms[:, 1]
        mix += terms[:, 2]
        mix += self.one_each
        return mix.view(np.uint16)

    def spans(self, mix: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the symbols among the counts of the mix."""
        at = self.place.ravel()[:symbols.size] + symbols.ravel()
        flat = mix.ravel()
        low = flat.take(at, mode="clip")
        at += 1
        width = flat.take(at, mode="wrap")  # after the last symbol comes a row's first 0
        width -= low
        width &= TOTAL
        return low.reshape(symbols.shape), width.reshape(symbols.shape)

    def narrow(self, step: np.ndarray, low: np.ndarray, width: np.ndarray) -> None:
        self.low += step * low
        np.multiply(step, width, out=self.range)

    def learn(self, symbols: np.ndarray) -> None:
        """Teach the models and the weights the four nibbles of an id."""
        counts, moved, w = self.counts, self.spare, self.weights
        # Each model's share of the symbol, and the weights that these would have earned.
        at = self.place + symbols[:, None]
        flat = counts.ravel()
        took = flat.take(at, mode="clip")
        at += 1
        took = flat.take(at, mode="wrap") - took
        took &= np.int16(TOTAL)
        gain = took + np.float32(64)
        gain *= w
        total = gain[:, 0] + gain[:, 1]
        total += gain[:, 2]
        gain *= (np.float32(16384) / total)[:, None]
        np.floor(gain, out=gain)
        gain -= w
        gain *= np.float32(0.0625)
        w += gain
        np.floor(w, out=w)
        np.maximum(w, self.least, out=w)
        self.share()
        np.subtract(TARGETS.take(symbols, axis=0, mode="clip")[:, None], counts, out=moved)
        moved >>= RATE
        counts += moved
        self.tables.put(self.index.ravel(), counts.reshape(-1).view(ROW), mode="clip")

    def due(self, among: np.ndarray | None = None) -> np.ndarray:
        """Lanes whose interval has become too small, so that they move on by a word.

        An interval that lies across a step of the next word is cut to its larger part, which
        costs less than a bit and spares carries. After two nibbles one word nearly always makes the interval
        large enough, and a second one always does.
        """
        due = (self.range < LEAST).nonzero()[0] if among is None else among[self.range[among] < LEAST]
        if len(due):
            low, width = self.low[due], self.range[due]
            below = LEAST - (low & (LEAST - np.uint64(1)))
            across = below < width
            upper = across & (width - below > below)
            self.low[due] = np.where(upper, low + below, low)
            self.range[due] = np.where(upper, width - below, np.where(across, below, width))
        return due

    def shift(self, lanes: np.ndarray) -> None:
        self.low[lanes] = (self.low[lanes] & (LEAST - np.uint64(1))) << np.uint64(WORD)
        self.range[lanes] <<= np.uint64(WORD)


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes with the longest first, and how many are still at work at each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max()) if len(lengths) else 0
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, active


def encode_blocks(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The coder's output of each block of ids, as 24-bit words."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    order, active = _by_length(lengths)
    ids = np.zeros((max(1, len(active)), len(blocks)), np.uint32)
    for lane, block in enumerate(order):
        ids[:lengths[block], lane] = blocks[block]
    lanes = _Lanes(len(blocks))
    words = np.zeros((len(blocks), len(active) // 2 + 16), np.uint32)
    used = np.zeros(len(blocks), np.int64)
    last = {}
    for step, n in enumerate(active.tolist()):
        if n < len(lanes.low):
            last.update({i: (lanes.low[i], lanes.range[i]) for i in range(n, len(lanes.low))})
            lanes.shrink(n)
        now = ids[step, :n]
        lanes.context(ids[step - 1, :n] if step else now * 0, ids[step - 2, :n] if step > 1 else now * 0)
        paths = now >> PATHS
        symbols = (paths[1:] & np.uint32(15)).astype(np.int64)
        low, width = lanes.spans(lanes.foresee(ALL, paths[:4]), symbols)
        for nibble in range(4):
            lanes.narrow(lanes.range >> np.uint64(TOTAL_BITS), low[nibble], width[nibble])
            due = lanes.due() if nibble % 2 else NONE
            while len(due):
                words[due, used[due]] = lanes.low[due] >> np.uint64(WINDOW - WORD)
                used[due] += 1
                lanes.shift(due)
                due = lanes.due(due)
        lanes.learn(symbols)
        if step % 64 == 0 and used.max(initial=0) + 300 > words.shape[1]:
            words = np.pad(words, ((0, 0), (0, words.shape[1] + 300)))
    last.update({i: (lanes.low[i], lanes.range[i]) for i in range(len(lanes.low))})
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(blocks)
    for lane, block in enumerate(order):
        # The least word within the interval; readers take the bits after it for zeros.
        tail = [-(-int(last[lane][0]) >> WINDOW - WORD)] if lengths[block] else []
        out[block] = np.concatenate([words[lane, :used[lane]], np.array(tail, np.uint32)])
    return out


def decode_blocks(words: list[np.ndarray], lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of each block, from the coder's output and the number of ids."""
    order, active = _by_length(lengths)
    longest = max((len(w) for w in words), default=0) + 4
    stream = np.zeros((len(words), longest), np.uint32)
    for lane, block in enumerate(order):
        stream[lane, :len(words[block])] = words[block]
    lanes = _Lanes(len(words))
    # The window is two words and a byte, so the third word is held back in part.
    first = stream[:, :3].astype(np.uint64)
    code = first[:, 0] << np.uint64(32) | first[:, 1] << np.uint64(8) | first[:, 2] >> np.uint64(16)
    used = np.full(len(words), 3, np.int64)
    ids = np.zeros((max(1, len(active)), len(words)), np.uint32)
    for step, n in enumerate(active.tolist()):
        if n < len(lanes.low):
            lanes.shrink(n)
            code, used = code[:n], used[:n]
        path = np.zeros(n, np.uint32)
        lanes.context(ids[step - 1, :n] if step else path, ids[step - 2, :n] if step > 1 else path)
        symbols = np.empty((4, n), np.int64)
        for nibble in range(4):
            mix = lanes.foresee(slice(nibble, nibble + 1), path[None])[0]
            width = lanes.range >> np.uint64(TOTAL_BITS)
            value = np.minimum((code - lanes.low) // width, TOTAL).astype(np.uint16)
            below = np.bitwise_count((mix <= value[:, None]).view(np.uint64))
            symbol = symbols[nibble]
            np.add(below[:, 0], below[:, 1], out=symbol)
            symbol -= 1
            lanes.narrow(width, *lanes.spans(mix, symbol))
            due = lanes.due() if nibble % 2 else NONE
            while len(due):
                at = np.minimum(used[due], longest - 1)
                fresh = (stream[due, at - 1] & np.uint32(0xFFFF)).astype(np.uint64) << np.uint64(8)
                fresh |= stream[due, at] >> np.uint32(16)
                code[due] = (code[due] & (LEAST - np.uint64(1))) << np.uint64(WORD) | fresh
                used[due] += 1
                lanes.shift(due)
                due = lanes.due(due)
            path = path << np.uint32(4) | symbol.astype(np.uint32)
        lanes.learn(symbols)
        ids[step, :n] = path
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(words)
    for lane, block in enumerate(order):
        out[block] = ids[:lengths[block], lane].copy()
    return out


def pack(words: np.ndarray, n_ids: int, ends: list[int], docs: list[int | None]) -> bytes:
    body = struct.pack("<II", n_ids, len(ends))
    body += np.array(ends, "<u4").tobytes() + np.array([d or 0 for d in docs], "<i8").tobytes()
    body += np.array([d is not None for d in docs], np.uint8).tobytes()
    body += words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def unpack(payload: bytes) -> tuple[np.ndarray, int, list[int], list[int | None]]:
    """Words, number of ids, document ends and document ids of a payload; raises if it is damaged."""
    body = payload[8:]
    if payload[:4] != MAGIC or struct.unpack("<I", payload[4:8])[0] != zlib.crc32(body):
        raise ValueError("a block of token ids is damaged")
    n_ids, n = struct.unpack("<II", body[:8])
    ends = np.frombuffer(body, "<u4", n, 8)
    docs = np.frombuffer(body, "<i8", n, 8 + 4 * n)
    flags = np.frombuffer(body, np.uint8, n, 8 + 12 * n)
    raw = np.frombuffer(body, np.uint8, -1, 8 + 13 * n).reshape(-1, 3)
    words = np.pad(raw, ((0, 0), (0, 1))).view("<u4").ravel().astype(np.uint32)
    return words, n_ids, ends.tolist(), [d if f else None for d, f in zip(docs.tolist(), flags.tolist())]


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers ``first, first + 1, ...`` of each row, as many as it has."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


class WordEncoder:
    """Ids of texts; words between spaces, tabs and line feeds are encoded once, and remembered.

    The tokenizer must not join characters across white space, and drop it. Words of letters
    are encoded many at a time: each is one piece, and a token at the end of a piece says so. Should
    the ends not be as many as the words, each word is encoded alone. If the tokenizer makes letters small and cuts
    texts by :data:`PIECES`, Latin letters and the signs after them are encoded apart, without regard to capitals;
    but not with U+0130, whose small form ends with a mark that isn't a letter.
    """

    AT_ONCE = 2000
    END = "</w>"
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LATIN = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)(?P<signs>[!-/:-@\[-`{-~]*)$"

    def __init__(self, path: str):
        # A task has one core: threads of the library's own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(self.END)]] = True
        normal, cut = (json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        self.apart = (normal.get("normalizers") or [normal])[-1] == {"type": "Lowercase"} and (cut.get("pretokenizers") or [cut])[0] == {
            "type": "Split", "pattern": {"Regex": self.PIECES}, "behavior": "Removed", "invert": True}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and the number of each word's."""
        if all(map(str.isalpha, words)):
            joined = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(words) and ends[-1] == len(ids) - 1:
                return ids, np.diff(ends, prepend=-1)
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        size = np.fromiter((len(e) for e in encoded), np.int64, len(encoded))
        return np.fromiter((i for e in encoded for i in e.ids), np.uint32, int(size.sum())), size

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Where different words are among the remembered ones."""
        listed = words.to_pylist()
        new = [w for w in listed if w not in self.known]
        if self.held + sum(map(len, new)) + 10 * len(new) > REMEMBERED:
            self.forget()
            new = listed.copy()
        self.held += sum(map(len, new)) + 10 * len(new)
        # Words of letters first, so that most runs hold nothing else.
        new.sort(key=str.isalpha, reverse=True)
        split = sum(map(str.isalpha, new))
        cuts = [*range(0, split, self.AT_ONCE), *range(split, len(new), self.AT_ONCE), len(new)]
        parts = [self.words(new[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.ids = np.concatenate([self.ids, *(p[0] for p in parts)])
        self.size = np.concatenate([self.size, *(p[1] for p in parts)])
        return np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of each text's."""
        plain = pc.fill_null(texts.cast(pa.large_string()), "")
        for white in ("\n", "\t"):
            plain = pc.replace_substring(plain, white, " ")
        words = pc.split_pattern(plain, " ")
        coded = words.flatten().dictionary_encode()
        # Of each different word the pieces, at most two; the second may be empty.
        pieces = coded.dictionary
        if self.apart:
            latin = pc.extract_regex(pieces, self.LATIN)
            stem, signs = pc.struct_field(latin, "stem"), pc.struct_field(latin, "signs")
            pieces = pa.concat_arrays([pc.coalesce(pc.ascii_lower(stem), pieces), pc.fill_null(signs, "")])
        pieces = pieces.dictionary_encode()
        most = 1 + self.apart
        numbers = self.numbers(pieces.dictionary)[pieces.indices.to_numpy()].reshape(most, -1).T.ravel()
        many = self.size[numbers]
        ids = self.ids[_spread((np.cumsum(self.size) - self.size)[numbers], many)]
        size = many.reshape(-1, most).sum(axis=1)
        word = coded.indices.to_numpy()
        many = size[word]
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
        return ids[_spread((np.cumsum(size) - size)[word], many)], np.bincount(text, many, minlength=len(texts)).astype(np.int64)


def write_ids(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
              end_id: int = END_ID, block: int = BLOCK, lanes: int = LANES) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of ids.

    Null texts are empty: the end id only. Rows without an id come first; rows with one id stand together,
    in the order of a hash of their texts. Ids must be below 65536.
    """
    plain = docs.select(
        column_of(docs, doc_id).cast("bigint").alias("doc_id"), column_of(docs, text).cast("string").alias("text")
    ).withColumn("tie", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        number = 0
        ids: list[np.ndarray] = []  # not yet in a block
        ends: list[int] = []  # of documents, counted from the first of ids
        names: list[int | None] = []

        def release(all_of: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, ends, names
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            whole = len(flat) if all_of else len(flat) // (block * lanes) * block * lanes
            for low in range(0, whole, block * lanes):
                cuts = list(range(low, min(whole, low + block * lanes), block))
                parts = [flat[c:min(c + block, whole)] for c in cuts]
                payloads = []
                for cut, part, words in zip(cuts, parts, encode_blocks(parts)):
                    a, b = np.searchsorted(ends, [cut + 1, cut + len(part) + 1])
                    payloads.append(pack(words, len(part), [e - cut for e in ends[a:b]], names[a:b]))
                numbers = pa.array(range(number, number + len(cuts)), pa.int64())
                number += len(cuts)
                yield pa.RecordBatch.from_arrays([numbers, pa.array(payloads, pa.binary())], ["block", "payload"])
            done = int(np.searchsorted(ends, whole + 1))
            ids, ends, names = [flat[whole:]], [e - whole for e in ends[done:]], names[done:]

        held = 0
        for batch in batches:
            names_of = batch.column("doc_id").to_pylist()
            for low, texts in text_chunks(batch.column("text"), BATCH_CHARS):
                found, many = encoder.encode(pa.array(texts, pa.large_string()))
                if len(found) and int(found.max()) >= 1 << 16:
                    raise ValueError("an id has more than 16 bits")
                stop = np.cumsum(many)
                ids.append(np.insert(found, stop, end_id))
                ends += (held + stop + np.arange(1, len(stop) + 1)).tolist()
                names += names_of[low:low + len(texts)]
                held += len(found) + len(many)
                pa.default_memory_pool().release_unused()
                if held >= block * lanes:
                    yield from release(False)
                    held = len(ids[0])
        yield from release(True)

    ordered = plain.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ordered.mapInArrow(run, "block bigint, payload binary")
    blocks.select(F.spark_partition_id().alias("part"), "block", "payload").write.parquet(path)


def read_ids(spark: SparkSession, path: str, lanes: int = LANES, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32``, and ``ids`` if asked for.

    ``start`` is the number of ids of all documents before it.
    """
    blocks = spark.read.schema("part int, block bigint, payload binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, size, crc, kept = None, 0, 0, 0, []

        def rows(parts: list[int], payloads: list[bytes]) -> pa.RecordBatch:
            nonlocal part, start, size, crc, kept
            found = [unpack(p) for p in payloads]
            decoded = decode_blocks([f[0] for f in found], np.array([f[1] for f in found], np.int64))
            out: list[tuple] = []
            for here, ids, (_, _, ends, names) in zip(parts, decoded, found):
                if here != part:
                    part, start, size, crc, kept = here, 0, 0, 0, []
                raw, low = ids.astype("<u4").tobytes(), 0
                for end, name in zip(ends, names):
                    piece = raw[4 * low:4 * end]
                    size, crc = size + end - low, zlib.crc32(piece, crc)
                    out.append((here, name, start, size, crc, b"".join([*kept, piece]) if with_ids else None))
                    start, size, crc, low, kept = start + size, 0, 0, end, []
                piece = raw[4 * low:]
                size, crc = size + len(ids) - low, zlib.crc32(piece, crc)
                if with_ids:
                    kept.append(piece)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"])

        parts: list[int] = []
        payloads: list[bytes] = []
        for batch in batches:
            for p, payload in zip(batch.column("part").to_pylist(), batch.column("payload")):
                parts.append(p)
                payloads.append(payload.as_py())
                if len(parts) == lanes:
                    yield rows(parts, payloads)
                    parts, payloads = [], []
        if parts:
            yield rows(parts, payloads)

    schema = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    ordered = blocks.repartition("part").sortWithinPartitions("part", "block")
    docs, _ = written(ordered.mapInArrow(run, schema))
    # One row per part, so the unpartitioned window is over a list of bounded size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = docs.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    joined = docs.join(F.broadcast(starts), "part")
    columns = ["doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"]
    return joined.select(*columns, *["ids"] * with_ids)


def op6_token_blocks(spark, folder: str) -> DataFrame:
    import uuid

    import public_tokenizers

    from edgeloom.plans.rounds import shared_folder

    path = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path)
