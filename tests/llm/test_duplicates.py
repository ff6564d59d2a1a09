"""SimHash groups, embeddings and sharding."""

import random

import numpy as np
import pytest

from edgeloom.llm.rpforest import embedding_groups, fit_forest, leaves_of, plan_forest
from edgeloom.llm.sharding import shard
from edgeloom.llm.simhash import anchors, error_patterns, keep_one, simhash_groups
from tests.llm import helpers as h


def test_golay_code_is_perfect():
    _, start, end = error_patterns(3)
    assert (end - start == 1).all()  # one codeword within 3 of every word


def test_anchor_of_close_words_is_shared():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    y = x.copy()
    for _ in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
    places = [set(zip(*[a[m].tolist() for a in (rows, keys)])) for rows, keys, m in (
        (lambda r, k, f: (r, k, f))(*anchors(x, 4)),
        (lambda r, k, f: (r, k, np.ones(len(r), bool)))(*anchors(y, 4)),
    )]
    assert {r for r, _ in places[0] & places[1]} == set(range(300))


@pytest.mark.parametrize("tile", [(2048, 4096), (3, 4)])
def test_simhash_equals_all_pairs(spark, tile, monkeypatch):
    monkeypatch.setattr("edgeloom.llm.simhash.links.__defaults__", (4, *tile))
    rows = h.random_documents(3, 150) + [(900, None), (None, "x y"), (5, "again the same id")]
    docs = h.documents(spark, rows, ("fp", "component_id", "_kept"))
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_groups(docs).collect()), key=str)
    assert got == h.simhash_groups(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = h.sentence(rng, 300).split()
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(300)] = f"w{i}"
        rows.append((i, " ".join(words)))
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_groups(h.documents(spark, rows)).collect()), key=str)
    assert got == h.simhash_groups(rows)


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (8, "quite another text it is")]
    kept = keep_one(h.documents(spark, rows, ("fp",)))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "8", "None"]
    assert "fp" in kept.columns


def test_empty_tables(spark):
    docs = h.documents(spark, [])
    assert simhash_groups(docs).count() == keep_one(docs).count() == shard(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_groups(vectors).count() == 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(5)
    one, two, three = (h.sentence(rng, 60) for _ in range(3))
    # An id with two texts, copies without an id, and a copy with one.
    rows = [(1, one), (1, two), (None, three), (None, three), (7, one), (None, two), (None, one)]
    kept = keep_one(h.documents(spark, rows, ("row", "fp", "_row"))).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, one), (1, two)] + [(0, t) for d, t in rows if d is None])


def _brute(rows, threshold=0.93):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v, _ in rows]
    links, pairs = [0] * len(rows), []
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] is not None and rows[i][2] == rows[j][2]:
                if float(a @ b) >= threshold:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    pairs.append((i, j))
    label = h.union(len(rows), pairs)
    least = {}
    for (vec, _, _), k in zip(rows, label):
        least[k] = min(vec, least.get(k, vec))
    return {r[0]: (n, least[k]) for r, n, k in zip(rows, links, label)}


def _vectors(seed, n, dim, labels, copies):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        if rows and rng.random() < copies:
            _, v, label = rows[int(rng.integers(len(rows)))]
            v = np.array(v, np.float32) + rng.normal(0, rng.choice([0, 0.02, 0.06]), dim).astype(np.float32)
        else:
            v = rng.normal(size=dim).astype(np.float32)
        rows.append((i, [float(np.float32(x)) for x in v], label))
    return rows


def test_embeddings_odd_cases(spark):
    rows = _vectors(1, 40, 4, 2, 0.6) + [
        (100, None, 1), (101, [0.0] * 4, 1), (102, [1.0, None, 0.0, 0.0], 1), (103, [float("nan"), 1.0, 0.0, 0.0], 1),
        (104, [1.0, 0.0, 0.0, 0.0], None), (105, [1e30, 0.0, 0.0, 0.0], 1), (106, [1e-30, 0.0, 0.0, 0.0], 1), (107, [], 1),
        (108, [float("inf"), 1.0, 0.0, 0.0], 1), (109, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 AS cid", "2 AS leaf")
    got = {r.id: (r.n_links, r.component_id) for r in embedding_groups(df, leaf_rows=8, tile_rows=4).collect()}
    assert got == _brute(rows)


def test_embedding_recall_in_deep_trees(spark):
    rows = _vectors(2, 1500, 32, 2, 0.5)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.id: r.n_links for r in embedding_groups(df, leaf_rows=24, tile_rows=64, sample_rows=500).collect()}
    wanted = {k: n for k, (n, _) in _brute(rows).items()}
    assert all(got[k] <= n for k, n in wanted.items())
    assert sum(got.values()) >= 0.97 * sum(wanted.values())


def test_embedding_recall_off_centre(spark):
    # Pairs just within the threshold, far from the origin: they are wide beside the spread of the vectors.
    rng = np.random.default_rng(3)
    centre = rng.normal(size=48)
    x = rng.normal(size=(1200, 48)) + centre
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    x = np.concatenate([x, 0.932 * x + np.sqrt(1 - 0.932 ** 2) * aside])
    small = np.concatenate([x[:3], x[1200:1203]])  # a label of few rows needs no trees
    df = spark.createDataFrame(
        [(i, v.tolist(), "many") for i, v in enumerate(x)] + [(9000 + i, v.tolist(), "few") for i, v in enumerate(small)],
        "vec_id bigint, embedding array<double>, label string",
    )
    wanted = (x @ x.T >= 0.93).sum(1) - 1
    got = {r.id: r.n_links for r in embedding_groups(df, leaf_rows=1).collect()}  # 12 levels
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= wanted).all() and wanted.sum() >= 2400
    assert found.sum() >= 0.98 * wanted.sum()
    assert all(got[9000 + i] == 1 for i in range(6))


def test_trees_follow_the_depth():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 48)) + rng.normal(size=48)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = plan_forest(x, 12, 0.93)
    assert forest["trees"][0] == 1 and forest["trees"] == sorted(forest["trees"])
    assert all(10 <= n <= 40 for n in forest["trees"][1:])
    few = plan_forest(x, 12, 0.93, trees=2, most_trees=4)
    assert few["depth"] < 12 and all(len(levels) == few["depth"] for levels in few["limits"])


def test_spilled_rows_reach_both_sides():
    x = np.random.default_rng(0).normal(size=(2000, 16))
    forest = fit_forest(x, 3, trees=2)
    rows, codes = leaves_of(forest, x)
    assert set(rows.tolist()) == set(range(2000))
    assert len(rows) > 2 * 2000 and len(set(zip(rows.tolist(), codes.tolist()))) == len(rows)


@pytest.mark.parametrize("hot", [0, 150])
def test_shards_are_even_and_keep_groups(spark, hot):
    rows = h.random_documents(9, 240) + [(1000 + i, "one text of very many") for i in range(hot)]
    placed = shard(h.documents(spark, rows, ("row", "link", "shard", "n")), shards=7).collect()
    assert sorted(str(r.doc_id) for r in placed) == sorted(str(d) for d, _ in rows)
    sizes = [sorted(r.slot for r in placed if r.shard == s) for s in range(7)]
    assert all(slots == list(range(len(slots))) for slots in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    texts = dict(rows)
    where = {}
    for r in placed:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 16
    apart = sum(len(s) > 1 for t, s in where.items() if t != "one text of very many")
    assert apart <= (0 if not hot else 12)
    if hot:
        held = sorted(sum(r.shard == s and r.doc_id >= 1000 for r in placed) for s in range(7))
        assert sum(held[-4:]) >= 0.8 * hot  # three shards would do if nothing else were linked
