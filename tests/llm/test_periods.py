"""Periodic runs against their definition, tried at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from edgeloom.llm import periods as p
from tests.llm import helpers as h


def _runs(words, least=12):
    """All runs by start, then period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - i >= max(least, 2 * q) and (i, k + q) not in found:
                found[i, k + q] = q
            i = k + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _found(texts, least=12):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    ids = np.array([x for t in texts for x in t], np.int64)
    rows = list(zip(*(x.tolist() for x in p.find_runs(ids, bounds, least))))
    return [[r[1:] for r in rows if r[0] == k] for k in range(len(texts))]


def _texts(rng, n):
    """Words of small alphabets, with planted repeats, Fibonacci words and copies."""
    for _ in range(n):
        kind = rng.randrange(6)
        size = rng.randint(0, 160)
        text = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(size)]
        if kind == 1:
            part = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
            text[size // 2:size // 2] = (part * rng.randint(2, 9))[:rng.randint(1, 300)]
        elif kind == 2:
            a, b = [0], [0, 1]
            while len(b) < size:
                a, b = b, b + a
            text = b
        elif kind == 3:
            text = [7] * size
        elif kind == 4:
            text = text + text + text[: size // 3]
        yield text


def test_cover():
    v = p.COVER_PERIOD
    assert {(a - b) % v for a in p.COVER for b in p.COVER} == set(range(v))


@pytest.mark.parametrize("slide, block", [(64, 500_000), (1, 7), (5, 100)])
def test_runs_equal_brute_force(monkeypatch, slide, block):
    monkeypatch.setattr(p, "SLIDE", slide)
    monkeypatch.setattr(p, "BLOCK", block)
    texts = list(_texts(random.Random(slide), 60))
    assert _found(texts) == [_runs(t) for t in texts]
    assert _found(texts, 3) == [_runs(t, 3) for t in texts]
    assert _found([]) == [] and _found([[], [1]]) == [[], []]


@pytest.mark.parametrize("wide, block", [(1, 7), (8, 100), (30, 500_000)])
def test_questions_within_long_stretches(monkeypatch, wide, block):
    monkeypatch.setattr(p, "WIDE", wide)
    monkeypatch.setattr(p, "BLOCK", block)
    rng = random.Random(wide)
    texts = list(_texts(rng, 40))
    # Powers of powers: long stretches inside each other, broken off and begun anew.
    for _ in range(20):
        text = [rng.randrange(2)]
        while len(text) < 400:
            text = text * rng.randint(1, 6) + [rng.randrange(3) for _ in range(rng.randrange(3))]
        texts.append(text[:600])
    assert _found(texts) == [_runs(t) for t in texts]
    assert _found(texts, 2) == [_runs(t, 2) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=5))
def test_short_alphabets(texts):
    assert _found(texts, 2) == [_runs(t, 2) for t in texts]


def test_extensions():
    rng = np.random.default_rng(4)
    parts = [rng.integers(0, 2, n) for n in (300, 5, 700)] + [np.tile(rng.integers(0, 9, 50), 8)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    words, first = p._fenced(np.concatenate(parts), bounds)
    text_of = np.searchsorted(first, np.arange(len(words)), "right") - 1
    text_of[0] = 0
    index = p.Extensions(words, text_of)
    for k, part in enumerate(parts):
        a, b = np.sort(rng.integers(0, len(part), (2, 400)), axis=0)
        a, b = a[a < b], b[a < b]
        wanted = []
        for x, y in zip(a, b):
            n = 0
            while y + n < len(part) and part[x + n] == part[y + n]:
                n += 1
            wanted.append(n)
        assert index.lce(first[k] + a, first[k] + b).tolist() == wanted


def test_long_text():
    rng = np.random.default_rng(6)
    part = rng.integers(0, 5000, 9000)
    words = np.concatenate([rng.integers(5000, 9999, 4000), np.tile(part, 3)[:25000], np.full(3000, 7000)])
    found = _found([words.tolist(), words[::-1].tolist()])
    assert found == [[(4000, 25000, 9000), (29000, 3000, 1)], [(0, 3000, 1), (3000, 25000, 9000)]]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _planted(doc, words):
    code = zlib.crc32(str(doc).encode())
    n, g = len(words), code // 10
    if doc is None or code % 10 or not n:
        return words
    a = g % n
    q = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % q] for i in range(a, n)]


def test_columns(spark):
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "a " * 40), (4, "\xa0x y　" * 9), (None, "b c " * 20), (3, "a " * 40), (5, "once")]
    rows += [(10 + i, " ".join(f"w{x}" for x in t)) for i, t in enumerate(_texts(rng, 30))]
    docs = h.documents(spark, rows, ("runs", "words"))
    got = sorted(((r.doc_id, r.p.n_words, [tuple(x) for x in r.p.runs], r.p.collapsed) for r in p.periods(docs, name="p").collect()), key=str)
    wanted = []
    for doc, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
        runs = _runs(words)
        wanted.append((doc, len(words), runs, _collapsed(words, runs)))
    assert got == sorted(wanted, key=str)
    assert p.periods(h.documents(spark, [])).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(200, None), (None, "x y " * 30), (201, "\t")]
    planted = sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150))
    assert planted > 5
    h.documents(spark, rows, ("best",)).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, p.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    wanted = []
    for doc, text in rows:
        words = _planted(doc, [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w])
        runs = _runs(words)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        best = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        wanted.append((doc, len(runs), *best, _sha(lines), _sha(_collapsed(words, runs))))
    assert found == sorted(wanted, key=str)
