"""Decontamination, licences, language, quality, mixing, surrogates."""

import random
import re
import zlib

import numpy as np

from edgeloom.llm import langid, licenses, mixing, quality, surrogates
from edgeloom.llm.decontaminate import contamination, decontaminate
from tests.llm import helpers as h


def _contaminated(spark, rows, items, **options):
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS words")
    found = contamination(h.documents(spark, rows, ("hits", "items")), bench, name="c", **options)
    return sorted(((r.doc_id, r.c.n_words, r.c.n_hit, list(r.c["items"])) for r in found.collect()), key=str)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    items = [(i, h.sentence(rng, n)) for i, n in enumerate([1, 2, 3, 9, 10, 11, 30, 0])]
    items += [(20, items[6][1]), (21, None), (22, "  !! "), (23, "a a a a a a a a a a a a"), (24, "Élan vital ünd 42")]
    rows = []
    for i in range(120):
        parts = [h.sentence(rng, rng.randint(0, 25)) for _ in range(3)]
        item = rng.choice(items)[1] or ""
        cut = item.split()[rng.randint(0, 3):]
        rows.append((i, rng.choice([" ", "\n", "--", ""]).join([parts[0], " ".join(cut).upper(), parts[1], item, parts[2]])))
    rows += [(200, None), (201, ""), (202, "a " * 40), (203, "élan VITAL ünd 42"), (204, "Élan vital, ünd-42")]
    wanted = sorted(((d, *h.contamination(t, items)) for d, t in rows), key=str)
    assert _contaminated(spark, rows, items) == wanted
    # In blocks of few windows, one pass each, the answer is the same.
    assert _contaminated(spark, rows, items, windows_per_block=20) == wanted


def test_decontamination_odd_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    docs = h.documents(spark, [(1, "a b"), (2, None)])
    assert decontaminate(docs, bench).count() == 2
    named = spark.createDataFrame([(None, "a b")], "item_id bigint, text string")
    assert [r.doc_id for r in decontaminate(docs, named).collect()] == [2]
    assert decontaminate(h.documents(spark, []), named).count() == 0


def test_licences(spark):
    rng = random.Random(4)
    notices = licenses.TEMPLATES
    rows = [(0, None), (1, ""), (2, "MIT license"), (3, "All\nRIGHTS -- reserved")]
    wanted = {3: "all-rights-reserved"}
    for i, (name, text) in enumerate(sorted(notices.items()), 10):
        rows.append((i, f"{h.sentence(rng, rng.randint(0, 300))} {text} {h.sentence(rng, rng.randint(0, 300))}"))
        wanted[i] = name
        words = text.split()
        if len(words) > 25:  # one changed word costs five shingles at most
            words[len(words) // 2] = "changed"
            rows.append((i + 100, f"{h.sentence(rng, 50)} {' '.join(words)} {h.sentence(rng, 50)}"))
            wanted[i + 100] = name
            rows.append((i + 200, f"{h.sentence(rng, 50)} {' '.join(words[:len(words) // 2])}"))
    docs = h.documents(spark, rows, ("licenses_", "index"))
    found = licenses.license_matches(docs, licenses.template_table(spark), name="m").collect()
    got = {r.doc_id: sorted(m.template_id for m in r.m) for r in found}
    for doc, name in wanted.items():
        assert name in got[doc], (doc, name)
    assert not got[0] and not got[1] and not got[2]
    assert all("changed" not in t or len(got[d]) >= 1 for d, t in rows if t and d > 100 and d < 200)
    assert all(not [n for n in got[d] if n == wanted.get(d - 200)] for d, _ in rows if d >= 200)
    in_passes = licenses.license_matches(docs, licenses.template_table(spark), name="m", per_pass=2).collect()
    assert {r.doc_id: sorted(m.template_id for m in r.m) for r in in_passes} == got


def _languages(seed, n):
    rng, rows = random.Random(seed), []
    letters = {"aa": "abcdefg", "bb": "efghijk", "cc": "абвгдеж"}
    for i in range(n):
        lang = rng.choice(list(letters))
        rows.append((i, h.sentence(rng, rng.randint(1, 40), letters[lang]), lang, "s"))
    return rows


def test_language(spark):
    rows = _languages(1, 400) + [(900, None, "aa", "s"), (901, "123 !?", "aa", "s"), (902, "", None, "s"), (None, "abc dab", "aa", "s"),
                                 (903, "ab" * 300_000, None, "s")]
    docs = h.documents(spark, rows, ("score", "lang_pred", "fold"))
    model = langid.train_model(docs)
    found = {r.doc_id: r.l for r in langid.predict(docs, model, name="l").collect()}
    held = [r for r in rows[:400] if len(r[1]) > 30 and r[0] is not None]
    assert sum(found[r[0]].lang_pred == r[2] for r in held) >= 0.99 * len(held)
    for doc in (900, 901, 902):
        assert found[doc].lang_pred == "und" and found[doc].score == 0 and found[doc].rejected
    assert all(0 <= f.score <= 1 for f in found.values())
    nothing = langid.train_model(h.documents(spark, [(1, "abc", None, "s")]))
    assert langid.predict(docs, nothing, name="l").select("l.lang_pred").distinct().collect()[0][0] == "und"
    assert langid.predict(h.documents(spark, []), model, name="l").count() == 0


def test_language_of_the_calibration_fold_alone(spark):
    alone = [i for i in range(500, 600) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = _languages(2, 200) + [(i, "λόγος και μύθος " * 5, "dd", "s") for i in alone] + [(900, "μύθος λόγος", None, "s")]
    model = langid.train_model(h.documents(spark, rows))
    assert model["langs"] == ["aa", "bb", "cc", "dd"] and len(model["most"]) == 4
    found = {r.doc_id: r.l for r in langid.predict(h.documents(spark, rows), model, name="l").collect()}
    assert found[900].lang_pred == "dd" and not found[900].rejected
    only = langid.train_model(h.documents(spark, [(alone[0], "λόγος", "dd", "s")]))
    assert only["langs"] == ["dd"]


def test_kneser_ney_sums_to_one():
    symbols = langid.symbol_table()
    keys, counts = np.unique(langid.keys_of(["abra cadabra abc", "bacab rabarber"], symbols)[0], return_counts=True)
    model = langid.build_model(["x"], {"x": (keys.astype(np.int64), counts)})
    for context in ("", "a", "ab", "rab", "zzz"):
        codes = [int(symbols[ord(c)]) for c in context]
        past = 0
        for c in codes:
            past = past << langid.BITS | c
        every = np.array([past << langid.BITS | s for s in range(langid.SYMBOLS)], np.uint32)
        assert abs(np.exp(langid._log_probabilities(model, every).astype(float)).sum() - 1) < 1e-4


def test_keys_stop_at_word_starts():
    symbols = langid.symbol_table()
    keys, ends = langid.keys_of(["ab, c", "", "ab"], symbols)
    assert ends.tolist() == [5, 5, 8]
    assert keys[:3].tolist() == keys[5:].tolist()


def _bags(seed, n):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        good = rng.random() < 0.6
        parts = [h.sentence(rng, 60) for _ in range(rng.randint(1, 5))]
        if not good:
            parts[rng.randrange(len(parts))] = "SPAM!! " * 60
        rows.append((i, "\n".join(parts)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality(spark):
    rows, marks = _bags(1, 500)
    rows += [(900, None), (901, ""), (902, "x" * 100_000), (3, "again"), (None, "no id")]
    marks += [(3, 1 - marks[3][1], 0), (None, 1, 0), (5000, 1, 0), (901, None, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    docs = h.documents(spark, rows, ("score", "label", "doc"))
    model = quality.train(docs, labels)
    found = {r.doc_id: r.p for r in quality.score(docs, model, name="p").collect()}
    assert all(0 <= p <= 1 for p in found.values())
    truth = {d: q for d, q, _ in marks[:500]}
    right = sum((found[d] >= 0.5) == (q == 1) for d, q in truth.items() if d != 3)
    assert right >= 0.97 * 499
    # The gate finds the passage that spoils the document.
    bad = "\n".join([h.sentence(random.Random(8), 60), "SPAM!! " * 60, h.sentence(random.Random(9), 60)])
    features, many = quality.passage_features([bad])
    assert model.scores(features, many)[0][0] < 0.5
    assert quality.keep_good(docs, labels).columns == docs.columns
    none = quality.train(docs, labels.where("false"))
    assert quality.score(docs, none, name="p").where("p <> 0.5").count() == 0
    assert quality.score(h.documents(spark, []), model).count() == 0


def test_quality_with_a_very_long_text(spark):
    rows, marks = _bags(2, 300)
    # Whatever the order of the sample, the longest texts come early in it.
    rows = [(d, t + " " + h.sentence(random.Random(d), 60) * 300 if d % 10 == 0 and q else t) for (d, t), (_, q, _) in zip(rows, marks)]
    docs = h.documents(spark, rows)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    sample, share = quality._sampled(docs, labels, "doc_id", "text", "quality", 1, 3, 6000, 600)
    learned = {d for d, _, _ in marks if zlib.crc32(str(d).encode()) % 3 != 1}
    assert {r.doc for r in sample.select("doc").collect()} == learned and 1 <= share < 10
    model = quality.train(docs, labels, sample_passages=800)
    found = {r.doc_id: r.p for r in quality.score(docs, model, name="p").collect()}
    assert sum((found[d] >= 0.5) == (q == 1) for d, q, _ in marks) >= 0.8 * len(marks)


def test_shares_of_passages():
    sizes = np.array([1, 2, 500, 9])
    assert quality._share(sizes, 1000) == 500 and quality._share(sizes, 20) == 8 and quality._share(sizes, 2) == 1
    places = quality._drawn("7", 500, 8)
    assert len(set(places.tolist())) == 8 and (np.diff(places) > 0).all() and places.max() < 500


def test_passage_features_do_not_depend_on_the_batch():
    texts = ["One two. Two two!", "", "É" * 900, "a\nb " * 300]
    together, many = quality.passage_features(texts)
    alone = [quality.passage_features([t])[0] for t in texts]
    assert np.allclose(together, np.concatenate(alone))
    assert many.tolist() == [1, 1, 3, 3]


def _mixed(rows, share):
    """The same fit on one machine: probability of each document."""
    tokens = {d: max(1, len(re.findall(r"[^ \t\n\r]+", t or ""))) for d, t, *_ in rows}
    cell = {d: (s, lang) for d, _, lang, s in rows}
    total = {}
    for d, c in cell.items():
        total[c] = total.get(c, 0) + tokens[d]
    return tokens, cell, total


def test_mixing_meets_targets(spark):
    rng = random.Random(6)
    rows = [(i, h.sentence(rng, rng.randint(5, 60)), rng.choice(["en", "en", "en", "de"]), rng.choice(["a", "a", "a", "b", "c"]))
            for i in range(600)] + [(700, None, None, None), (701, "", "en", "a")]
    targets = {
        "source": spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("nowhere", 5.0)], "value string, share double"),
        "lang": spark.createDataFrame([("en", 0.5), ("de", 0.5)], "value string, share double"),
    }
    docs = h.documents(spark, rows, ("tokens", "weight", "p", "_cell"))
    found = mixing.mixed(docs, targets, 0.2).select("doc_id", "mix.*").collect()
    assert len(found) == len(rows)
    tokens, _, total = _mixed(rows, 0.2)
    expected = sum(r.tokens * r.p for r in found)
    assert abs(expected - 0.2 * sum(tokens.values())) < 1e-6 * expected
    by_cell = {(r.source, r.lang, r.topic): r.weight for r in found}
    for k, shares in ((0, {"a": 0.25, "b": 0.25, "c": 0.5}), (1, {"en": 0.5, "de": 0.5})):
        for value, share in shares.items():
            assert abs(sum(w for c, w in by_cell.items() if c[k] == value) - share) < 1e-6
    assert next(r for r in found if r.doc_id == 700).p == 0  # no target, no weight
    drawn = mixing.sample(docs, targets, 0.2)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in found if r.drawn}
    assert mixing.sample(h.documents(spark, [])).count() == 0
    assert mixing.sample(docs, None, 1.0).count() > 0.9 * len(rows)


def test_mixing_draws_follow_probabilities(spark):
    rows = [(i, "some words here", "en", "a" if i % 3 else "b") for i in range(3000)]
    found = mixing.mixed(h.documents(spark, rows), None, 0.5).select("mix.*").collect()
    assert abs(sum(r.drawn for r in found) - sum(r.p for r in found)) < 100


def test_surrogates(spark):
    text = ("Write to anna.b-7@mail3.example.com or +1 (017) 555-7713, card 4952-9359 0025 3052 x 4952935900253052. "
            "Mr. John Miller met Mrs Jane Miller; Frau Müller and г-жа Анна Петрова came from 169.122.221.182. "
            "Mr Miller again. token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" v1.2.3.4.5 300.1.1.1")
    rows = [(0, text), (1, text), (2, None), (3, ""), (4, "nothing here. 12 34"), (5, "anna.b-7@mail3.example.com")]
    docs = h.documents(spark, rows, ("n_entities", "kind", "value", "_row"))
    found = {r.doc_id: r for r in surrogates.replace_entities(docs, "k", count="n").collect()}
    assert found[2].text is None and found[3].text == "" and found[4].text == rows[4][1] and found[4].n == 0
    new = found[0].text
    assert new == found[1].text and found[0].n == 14
    for gone in ("anna", "017", "4952", "Miller", "Jane", "Müller", "Анна", "Петрова", "169.122", "2abc3ff2"):
        assert gone not in new
    shape = re.match(r"Write to [a-z]{4}\.[a-z]-\d@[a-z]{4}\d\.example\.com or \+1 \(\d{3}\) \d{3}-\d{4}, card (?:\d{4}[- ]?){4} x \d{16}\. "
                     r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+); Frau (\w+) and г-жа ([а-яА-Я]+) ([а-яА-Я]+) came from (?:\d{1,3}\.){3}\d{1,3}\. "
                     r"Mr (\w+) again\. token = \"[0-9a-f]{40}\" v1\.2\.3\.4\.5 300\.1\.1\.1$", new)
    assert shape, new
    john, miller, jane, miller2, mueller, anna, _, miller3 = shape.groups()
    assert miller == miller2 == miller3 and len({john, miller, jane, mueller}) == 4
    assert jane[-1] == "a" and anna[-1] in "ая"
    assert found[5].text == re.search(r"\S+@\S+", new)[0]
    other = {r.doc_id: r.text for r in surrogates.replace_entities(docs, "another key", count="n").collect()}
    assert other[0] != new


def test_surrogates_of_keys_in_any_case(spark):
    small = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    mixed = "".join(c.upper() if i % 2 else c for i, c in enumerate(small))
    rows = [(0, f'TOKEN = "{small.upper()}"'), (1, f"token {small}."), (2, f"{mixed} and {small.upper()}")]
    found = {r.doc_id: r for r in surrogates.replace_entities(h.documents(spark, rows), "k", count="n").collect()}
    new = re.fullmatch(r'TOKEN = "([0-9A-F]{40})"', found[0].text)[1]
    assert new != small.upper() and found[1].text == f"token {new.lower()}."
    first, second = found[2].text.split(" and ")
    assert second == new and first.lower() == new.lower() and found[2].n == 2
    assert all(a.isupper() == b.isupper() for a, b in zip(first, mixed) if a.isalpha() and b.isalpha())


def _check_sum(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))


def test_surrogates_of_numbers(spark):
    secret = "1234567890123456" + "abc1" * 6  # begins like a card number
    text = ("4952935900253052 or 4952-9359-0025-3052, 4952 9359 0025 3052; not 9807915762804490, 1111 2222 3333 4445. "
            f"+1 (017) 555-7713 is +1 017.555.7713, +44 20 7946 0018 another. {secret}")
    rows = [(1, text), (2, "only 9807915762804490, no card"), (3, "9807915762804490 for Mr Miller, Miller said"), (4, None)]
    found = {r.doc_id: r for r in surrogates.replace_entities(h.documents(spark, rows), "key").collect()}
    got = found[1].text
    shape = re.fullmatch(
        r"(\d{16}) or (\d{4}-\d{4}-\d{4}-\d{4}), (\d{4} \d{4} \d{4} \d{4}); not 9807915762804490, 1111 2222 3333 4445\. "
        r"(\+1 \(\d{3}\) \d{3}-\d{4}) is (\+1 \d{3}\.\d{3}\.\d{4}), (\+44 \d\d \d{4} \d{4}) another\. ([0-9a-f]{40})", got)
    assert shape, got
    cards = {re.sub(r"\D", "", x) for x in shape.groups()[:3]}
    assert len(cards) == 1 and "4952935900253052" not in cards and _check_sum(cards.pop()) % 10 == 0
    phones = [re.sub(r"\D", "", x) for x in shape.groups()[3:6]]
    assert phones[0] == phones[1] != phones[2] and "10175557713" not in phones
    assert secret[:16] not in got and found[1].n_entities == 7
    assert (found[2].text, found[2].n_entities) == (rows[1][1], 0)
    assert re.fullmatch(r"9807915762804490 for Mr (\w+), \1 said", found[3].text) and "Miller" not in found[3].text
    assert found[4].text is None


def test_surrogates_of_whole_names(spark):
    text = ("Mr John Paul Smith, Mr McDonald, Mr O'Brien's, Mr. J. Smith, Mr J.R. Tolkien, Mrs SMITH, Dr van der Berg-Jones and "
            "Sr d'Artagnan. Later John Smith, MCDONALD and Smith's Tolkiens met Paul.")
    found = {r.doc_id: r for r in surrogates.replace_entities(h.documents(spark, [(0, text), (1, "John Smith")]), "k", count="n").collect()}
    new = found[0].text
    for gone in ("John", "Paul", "Smith", "SMITH", "Donald", "DONALD", "Brien", "Berg", "Jones", "Artagnan"):
        assert gone not in new, (gone, new)
    shape = re.fullmatch(r"Mr (\w+) (\w+) (\w+), Mr (\w+), Mr \w+'s, Mr\. \w\. (\w+), Mr \w\.\w\. \w+, Mrs (\w+), Dr van der \w+ and "
                         r"Sr \w+\. Later (\w+) (\w+), (\w+) and (\w+)'s Tolkiens met (\w+)\.", new)
    assert shape, new
    john, paul, smith, mc, smith2, smith3, john2, smith4, mc2, smith5, paul2 = shape.groups()
    assert (john, paul, mc.upper()) == (john2, paul2, mc2) and {smith2, smith3.title(), smith4, smith5} == {smith}
    assert found[1].text == "John Smith" and found[0].n == 18


def test_surrogates_stay_distinct(spark):
    # Short entities collide often, so tries must be repeated.
    small = spark.createDataFrame([("ip", f"10.0.0.{i}") for i in range(200)] + [("card", f"{i:02d}") for i in range(40)], "kind string, value string")
    got = surrogates.assign(small, "k").collect()
    assert len(got) == 240 and len({(r.kind, r.surrogate) for r in got}) == 240
    assert not {(r.kind, r.surrogate) for r in got} & {(r.kind, r.value) for r in got}
    assert surrogates.assign(small.where("false"), "k").count() == 0
