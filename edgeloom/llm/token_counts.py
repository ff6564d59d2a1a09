"""Token counts by byte-pair merging on a heap and a linked list, without any identifier.

A text becomes symbols, one a character. A heap holds the adjacent pairs that the vocabulary can join, by
rank and then by place; the symbols form a linked list. The lowest pair is popped and joined and
its two new neighbourhoods are pushed, until none is left. The count is the number of symbols at the
start less the joins; a lone character that the vocabulary doesn't hold counts a token for each of its bytes.

No piece of a vocabulary reaches across some boundaries (say, from a word into the blank after it), which
:func:`read_model` finds out. Texts are cut there, as joins on one side can't touch the other,
and a task remembers the counts of the short units that it has met.

The model is read on the driver and travels as a broadcast; its size is that of the vocabulary file, whatever the corpus.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from edgeloom.llm.common import column_of, table

BLANK = "▁"  # how pieces write a blank
LETTER = r"[^\W\d_²]"  # the square sign counts as one for regular expressions, yet pieces join it to a full stop
OTHER = rf"(?:(?!{LETTER})[^ 0-9])"
#: Where texts are cut, finest first; the check that allows it asks every two characters that a piece joins.
CUTS = (
    (re.compile(rf"[0-9]| *{OTHER}*{LETTER}+| *{OTHER}+| +"), lambda a, b: (
        (b == " " != a) or a in "0123456789" or b in "0123456789"
        or (re.match(LETTER, a) is not None and re.match(LETTER, b) is None))),
    (re.compile(r" *[^ ]+| +"), lambda a, b: b == " " != a),
    (re.compile(r"(?s).+"), lambda a, b: False),
)
REMEMBERED, UNIT_CHARS = 500_000, 64  # units that a task remembers, and their length at most
SLICE = 1_000_000  # characters of a text that are cut into units at once
LONG_UNIT = 4_096  # units beyond this are cut between characters that no piece joins

#: Kinds of pieces, fields of the model and of its parts, as the file format numbers them.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BPE, BYTE_FALLBACK = 3, 2, 35
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of one message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        width = {1: 8, 5: 4}[kind] if kind != 2 else number()
        yield tag >> 3, data[at:at + width]
        at += width


def read_model(path: str) -> dict:
    """``rank`` of each piece (blanks as such), ``joins`` and ``cut``, from a byte-pair model with byte fallback.

    Raises ValueError for models that join otherwise: other types, normalised texts, pieces of other kinds.
    """
    with open(path, "rb") as file:
        parts = list(_fields(file.read()))
    scores, kinds = {}, set()
    for number, value in parts:
        if number == PIECES:
            piece = dict(_fields(value))
            kind = piece.get(3, NORMAL)
            kinds.add(kind)
            if kind == NORMAL:
                scores[piece[1].decode()] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
    trainer = dict(f for n, v in parts if n == TRAINER for f in _fields(v))
    normal = dict(f for n, v in parts if n == NORMALIZER for f in _fields(v))
    if trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK) or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("not a byte-pair model with byte fallback and plain pieces")
    if normal.get(CHARSMAP) or normal.get(REMOVE_EXTRA, 1) or not normal.get(ESCAPE, 1):
        raise ValueError("models that normalise texts are not supported")
    order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    rank = {p.replace(BLANK, " "): order[s] for p, s in scores.items()}
    joins = {pair for p in rank for pair in zip(p, p[1:])}
    cut = next(i for i, (_, parted) in enumerate(CUTS) if not any(parted(a, b) for a, b in joins))
    return {"rank": rank, "joins": joins, "cut": cut, "prefix": bool(normal.get(DUMMY_PREFIX, 1))}


def merged(unit: str, rank: dict[str, int]) -> int:
    """Tokens of one unit: symbols at the start less joins, and more for bytes of unknown characters."""
    n = len(unit)
    listed = list if n <= UNIT_CHARS else partial(array, "q")  # quicker, or smaller
    ends = listed(range(1, n + 1))  # of the symbol that starts here; 0 once it is joined to the one before
    before = listed(range(-1, n - 1))  # where the symbol before starts
    get = rank.get
    # An entry is one number, so that a long unit's heap stays small: rank, place of the left symbol, length of both.
    bits = n.bit_length()
    mask = (1 << bits) - 1
    heap = [(r << bits | i) << bits | 2 for i in range(n - 1) if (r := get(unit[i:i + 2])) is not None]
    heapify(heap)
    joins = 0
    while heap:
        entry = heappop(heap)
        left = entry >> bits & mask
        right = ends[left]
        if not right or right == n:
            continue
        end = ends[right]
        if end - left != entry & mask:  # a side has grown since
            continue
        ends[left], ends[right] = end, 0
        joins += 1
        past = before[left]
        if past >= 0 and (r := get(unit[past:end])) is not None:
            heappush(heap, (r << bits | past) << bits | end - past)
        if end < n:
            before[end] = left
            after = ends[end]
            if (r := get(unit[left:after])) is not None:
                heappush(heap, (r << bits | left) << bits | after - left)
    count = n - joins
    for i, char in enumerate(unit):
        if char not in rank and ends[i] == i + 1:
            count += len(char.encode("utf-8", "surrogatepass")) - 1
    return count


class _Counts(dict):
    """Token counts of units, remembered up to a bound."""

    def __init__(self, model: dict):
        self.rank, self.joins = model["rank"], model["joins"]

    def __missing__(self, unit: str) -> int:
        if len(unit) > LONG_UNIT:
            cuts = [i for i in range(1, len(unit)) if (unit[i - 1], unit[i]) not in self.joins]
            return sum(merged(unit[a:b], self.rank) for a, b in zip([0, *cuts], [*cuts, len(unit)]))
        count = merged(unit, self.rank)
        if len(unit) <= UNIT_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = count
        return count


def _slices(text: str) -> Iterator[str]:
    """The text in slices of about :data:`SLICE` characters, each but the first beginning with a blank after none."""
    start = 0
    while len(text) - start > SLICE:
        cut = text.find(" ", start + SLICE)
        while cut > 0 and text[cut - 1] == " ":
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def counter(model: dict):
    """A function that gives the number of tokens of a text."""
    counts = _Counts(model)
    units = CUTS[model["cut"]][0].findall
    whole = model["cut"] == len(CUTS) - 1  # no cut at blanks either
    prefix = " " if model["prefix"] else ""

    def count(text: str | None) -> int:
        if not text:
            return 0
        text = prefix + text.replace(BLANK, " ")
        if whole or len(text) <= SLICE:
            return sum(map(counts.__getitem__, units(text)))
        return sum(sum(map(counts.__getitem__, units(part))) for part in _slices(text))

    return count


def token_counts(docs: DataFrame, model: dict, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with a column ``name``: the tokens of each whole text, as bigint; 0 for null and empty texts.

    No begin, end or other special token is added, and strings that look like one are plain text. Rows
    are independent: repeated ones get equal counts, an empty table stays empty, other columns are handed through.
    A column that is already called ``name`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("bigint")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(shared.value)
        for batch in batches:
            yield pa.array((count(x.as_py()) for x in batch), pa.int64(), size=len(batch))

    return docs.withColumn(name, counted(column_of(docs, text).cast("string")))


def op13_token_counts(spark, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = token_counts(docs, read_model(public_tokenizers.path("piece_bpe_32k.model")))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return found.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
