"""Licence scans: every notice in many surroundings, versions told apart, and exact shares by brute force."""

import random
import re

import pytest

from edgeloom.llm import licenses as l
from tests.llm import helpers as h

SPDX = {name: spdx for name, spdx, *_ in l.NOTICE_ROWS}


def _words(text):
    return re.findall("[a-z0-9]+", text.lower())


def _grams(words, width):
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def _best(text, template):
    """Largest share of the template's shingles in any stretch as long as the template."""
    wanted = _words(template)
    width = min(l.SHINGLE, len(wanted))
    of_text, own = _grams(_words(text), width), set(_grams(wanted, width))
    span = len(wanted) - width + 1
    return max((len(own & set(of_text[i:i + span])) / len(own) for i in range(max(1, len(of_text) - span + 1))), default=0)


def _damaged(rng, text, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = "altered"
    return " ".join(words)


@pytest.mark.parametrize("alone", [True, False])
def test_found_as_by_brute_force(alone):
    rng = random.Random(alone)
    texts = []
    for _, text in sorted(l.TEMPLATES.items()):
        for times in (0, 1, 3):
            size = 0 if alone else rng.choice([1, 30, 400])
            around = [h.sentence(rng, rng.randint(0, size)) if size else "" for _ in range(2)]
            texts.append(f"{around[0]} {_damaged(rng, text, times)} {around[1]}".encode())
    found = l.scan(texts, l.build_index(sorted(l.TEMPLATES.items())))
    for text, got in zip(texts, found):
        for name, template in l.TEMPLATES.items():
            best = _best(text.decode(), template)
            if best >= l.LEAST:
                assert got[name][0] >= best - 1e-12
            elif name in got:  # a window may be longer than the template
                assert best > 0
        for name, (share, first, end) in got.items():
            width = min(l.SHINGLE, len(_words(l.TEMPLATES[name])))
            own = set(_grams(_words(l.TEMPLATES[name]), width))
            there = _grams(_words(text.decode())[first:end], width)
            assert share == len(own & set(there)) / len(own) and there[0] in own and there[-1] in own


def test_insertions():
    rng = random.Random(2)
    index = l.build_index(sorted(l.TEMPLATES.items()))
    for name, text in l.TEMPLATES.items():
        words = text.split()
        if len(words) < 30:
            continue
        more = h.sentence(rng, len(words) // 2 - 6).split()
        cut = rng.randrange(5, len(words) - 5)
        document = h.sentence(rng, 200).split() + words[:cut] + more + words[cut:] + h.sentence(rng, 200).split()
        assert name in l.scan([" ".join(document).encode()], index)[0]


def test_best_of_family(spark, tmp_path):
    rng = random.Random(3)
    rows, wanted = [(0, None), (1, ""), (2, "no notice at all"), (3, "MIT license")], {0: "", 1: "", 2: "", 3: ""}
    for i, (name, text) in enumerate(sorted(l.TEMPLATES.items()), 10):
        rows.append((i, f"{h.sentence(rng, rng.randint(0, 90))}. {text} {h.sentence(rng, rng.randint(1, 90))}"))
        wanted[i] = SPDX[name]
    both = "BSD-2-Clause,GPL-3.0-or-later"
    rows += [(900, f"{l.TEMPLATES['GPL-or-later-header']} {l.TEMPLATES['BSD-conditions']}"), (900, l.TEMPLATES["ISC-grant"])]
    h.documents(spark, rows, ("all", "m")).write.parquet(f"{tmp_path}/documents.parquet")
    found = l.op10_license_scan(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    assert sorted(r.spdx for r in found if r.doc_id == 900) == sorted([both, "ISC"])
    got = {r.doc_id: r for r in found if r.doc_id != 900}
    for doc, spdx in wanted.items():
        # Some longer notices hold a whole shorter one of another family.
        assert spdx in got[doc].spdx.split(","), (doc, spdx, got[doc])
        assert len(got[doc].spdx.split(",")) == 1 or got[doc].n_licenses > 1


def test_versions(spark, tmp_path):
    names = [n for n, _, family, _ in l.NOTICE_ROWS if family in ("gpl-header", "gpl-line", "isc", "cc-line", "cc-long", "epl")]
    rows = [(i, f"Some words before. {l.TEMPLATES[n]} And some after.") for i, n in enumerate(names)]
    h.documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spdx for r in l.op10_license_scan(spark, str(tmp_path)).collect()}
    assert got == {i: SPDX[n] for i, n in enumerate(names)}


def test_tables():
    names = [n for n, *_ in l.NOTICE_ROWS]
    assert len(set(names)) == len(names) >= 80
    assert len({t for *_, t in l.NOTICE_ROWS}) == len(names)
    assert l.build_index([("empty", ""), ("none", None), ("marks", "!?")]) == []
    assert l.scan([b"any text"], []) == [{}] and l.scan([], l.build_index([("a", "b c")])) == []
