"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from edgeloom.llm import phrases as p
from tests.llm import helpers as h


def _pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", x) for x in re.split("[.,;:!?\x0A-\x0D]", lowered)]


def _brute(rows, least, top=2000, absorbed=100):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in _pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    found = {}
    for (lang, words), a in often.items():
        inside = any(
            lang == other and len(w) > len(words) and 100 * b >= absorbed * a
            and any(w[i:i + len(words)] == words for i in range(len(w)))
            for (other, w), b in often.items())
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                for k in range(1, len(words))]
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, items in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(items)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _rows(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "A", "b", "Ünd", "zwei", "naïve", "x" * 30, "'s", "\xa0", "日本", "\x00", "(c)"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary[:rng.choice([3, 13])]) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0c "]) for w in words)
        if rng.random() < 0.3:
            text += " in the first place of all" * rng.randint(1, 3) + ";New York City"
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, " .,\t", "fr"), (n + 3, "fr only. once", "fr"), (None, "the of a", "en")]


def _docs(spark, rows, extra=()):
    return h.documents(spark, [(d, t, x, "s") for d, t, x in rows], extra)


def _got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


# With few bits, many phrases share a fingerprint.
@pytest.mark.parametrize("width", [62, 9, 1])
def test_equals_brute_force(spark, width):
    rows = _rows(1, 150)
    docs = _docs(spark, rows, ("fp", "phrase", "word"))
    for least, absorbed, top in ((5, 100, 2000), (2, 60, 7))[width < 10:]:
        wanted = _brute(rows, least, top, absorbed)
        assert wanted
        assert _got(p.collocations(docs, least=least, top=top, absorbed=absorbed, width=width)) == wanted


def test_small_chunks_and_full_filters(spark, monkeypatch):
    rows = _rows(2, 80) + [(500, "a b c " * 400, "en"), (501, ", ".join(["one two three"] * 90), "en")]
    docs = _docs(spark, rows)
    monkeypatch.setattr(p, "CHARS", 100)
    monkeypatch.setattr(p, "HELD", 20)
    monkeypatch.setattr(p, "FILTER_BITS", 6)
    assert _got(p.collocations(docs, least=4)) == _brute(rows, 4)


def test_pointers(spark, monkeypatch):
    monkeypatch.setattr(p, "CHARS", 50)
    rows = [(i, t, x) for i, t, x in _rows(3, 60) if i is not None] + [(900, "one two. " * 30, "en")]
    texts = {i: [w for words in _pieces(t) for w in words] for i, t, _ in rows}
    docs = _docs(spark, rows)
    named = docs.withColumn("doc_id", docs.doc_id.cast("string"))
    found = p.frequent_phrases(docs, least=4).where("phrase is not null").collect()
    assert {(r.lang, r.phrase, r.f) for r in p.frequent_phrases(named, least=4).collect() if r.phrase} == {(r.lang, r.phrase, r.f) for r in found}
    assert len(found) > 20
    for r in found:
        words = r.phrase.split(" ")
        assert texts[r.doc_id][r.word:r.word + len(words)] == words


def test_nothing(spark):
    assert _got(p.collocations(_docs(spark, []))) == []
    assert _got(p.collocations(_docs(spark, [(1, None, None), (2, " . ", "en"), (3, "a b", "en")]))) == []
    assert _got(p.collocations(_docs(spark, [(1, "a " * 99, "en")]))) == []


def test_skewed(spark, mode):
    rows = _rows(4, 60)
    assert _got(p.collocations(_docs(spark, rows), least=3)) == _brute(rows, 3)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_007
    rows = [("x", None, 4 * big), ("x", "a", big), ("x", "b", big + 1), ("x", "a b", big - 1)]
    counted = spark.createDataFrame(rows, "lang string, phrase string, f bigint").selectExpr("*", "1L AS doc_id", "0L AS word")
    original = p.frequent_phrases
    try:
        p.frequent_phrases = lambda *_: counted
        found = _got(p.collocations(spark.range(1).selectExpr("1 AS doc_id", "'' AS text", "'' AS lang")))
    finally:
        p.frequent_phrases = original
    score = 1000 * (big - 1) * 4 * big // (big * (big + 1))
    assert found == [("x", 1, "a b", big - 1, big, big + 1, 4 * big, score)]


def test_fingerprints_do_not_depend_on_the_place():
    salts = np.zeros(2, np.int64)
    a = p.Chunk(["the  first, place of all things", "x"], salts)
    b = p.Chunk(["Some words before. of\tALL things", "place of all"], salts)
    one, two = a.fingerprints(np.array([3]), 2), b.fingerprints(np.array([3, 7]), 2)
    assert one[0] == two[0] == two[1]
    assert a.fingerprints(np.array([0]), 1)[0] != a.fingerprints(np.array([1]), 1)[0]
