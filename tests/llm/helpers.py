"""Small tables and straightforward answers to compare with."""

import random
import re

import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows, extra=()):
    """``rows`` of (doc_id, text[, lang, source]) with columns that clash with internal names."""
    filled = [(r[0], r[1], *(r[2:] + ("en", "a")[len(r) - 2:]), len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(filled, DOCS)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def sentence(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(size, pairs):
    """Smallest index that each index reaches."""
    up = list(range(size))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(size)]


def simhash_groups(rows, threshold=4):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    pairs = []
    for i in range(len(rows)):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= threshold) + i + 1
        pairs += [(i, int(j)) for j in near]
    label = union(len(rows), pairs)
    least = {}
    for (doc, _), k in zip(rows, label):
        if doc is not None:
            least[k] = min(doc, least.get(k, doc))
    return sorted(((d, int(p), least.get(k)) for (d, _), p, k in zip(rows, prints, label)), key=str)


def contamination(text, items, width=10):
    """Number of words, hit words, and the items found."""
    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())

    of_text, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            window = w[i:i + width]
            for k in range(len(of_text) - len(window) + 1):
                if of_text[k:k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    found.add(str(item))
    return len(of_text), len(hit), sorted(found)


def random_documents(seed, n):
    """Texts with exact and near copies, odd white space, null and empty ones."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.4:
            words = (rng.choice(rows)[1] or "a").split()
            if len(words) > 1:
                words[rng.randrange(len(words))] = "Changed"
            text = " ".join(words)
        elif kind < 0.43:
            text = None
        elif kind < 0.46:
            text = rng.choice(["", " \t\n", "é", "one Two", " x　y"])
        else:
            text = sentence(rng, rng.randint(1, 120)).capitalize()
        rows.append((i, text))
    return rows
