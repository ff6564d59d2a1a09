"""Token counts against the library that the vocabulary is made for."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from edgeloom.llm import token_counts as t
from tests.llm import helpers as h

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = t.read_model(PATH)
ODD = [
    "", " ", "  a  b   ", "\n", "\t a\r\nb", "a\x00b", "<s>hi</s><unk><0x0A>", "▁a ▁▁ b▁", "ﬁ Å 　x\xa0y",
    "﻿a", "\xe9\U00013000x", " " * 70 + "x" + " " * 33, "$12,345.67-\xbd\xb2٣", "a_b__c-d...e", "日本語の文章です。" * 4,
    "é‍\U0001f468‍\U0001f469", "=" * 50, "aaaaaaaaaaaaaaaa", "\\u0041 {\"k\": [1, 2]}", "ΑΣ đại مرحبا",
]


def _wanted(text):
    return len(LIBRARY.encode(text))


@pytest.mark.parametrize("cut", range(len(t.CUTS)))
def test_odd_texts(cut):
    assert MODEL["cut"] == 0
    count = t.counter(MODEL | {"cut": cut})
    assert [count(x) for x in ODD] == [_wanted(x) for x in ODD]


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(max_size=60), st.text("abeinorst ,.'-_19\n▁", max_size=120),
    st.lists(st.sampled_from(sorted(MODEL["rank"])), max_size=20).map("".join),
))
def test_equals_the_library(text):
    if any("\ud800" <= c <= "\udfff" for c in text):
        return
    assert t.counter(MODEL)(text) == _wanted(text)


def test_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = [h.sentence(rng, 3000) + "  " * 40 + "x" * 5000, "漢字仮名" * 3000 + " a", "ab " * 4000 + " " * 4000]
    for slice_chars in (t.SLICE, 500):
        monkeypatch.setattr(t, "SLICE", slice_chars)
        monkeypatch.setattr(t, "REMEMBERED", 50)
        assert [t.counter(MODEL)(x) for x in texts] == [_wanted(x) for x in texts]


def test_column(spark):
    rng = random.Random(5)
    rows = [(i, x) for i, x in enumerate(ODD)] + [(100, None), (None, "no id"), (3, "again"), (3, "again")]
    rows += [(200 + i, h.sentence(rng, rng.randint(0, 300))) for i in range(40)]
    docs = h.documents(spark, rows, ("rank", "counted"))
    found = sorted(((r.doc_id, r.n) for r in t.token_counts(docs, MODEL, name="n").collect()), key=str)
    assert found == sorted(((d, _wanted(x or "")) for d, x in rows), key=str)
    assert t.token_counts(docs, MODEL, name="n").columns == docs.columns + ["n"]
    assert t.token_counts(h.documents(spark, []), MODEL).count() == 0


def test_query(spark):
    found = {r.doc_id: r for r in t.op13_token_counts(spark, h.SMALL).collect()}
    rows = spark.read.parquet(f"{h.SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        text = r.text or ""
        n = _wanted(text)
        assert tuple(found[r.doc_id]) == (r.doc_id, len(text.encode()), n, n > 4096)


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "m.model"
    path.write_bytes(b"\x12\x02\x18\x01")  # a trainer of another type
    with pytest.raises(ValueError):
        t.read_model(str(path))
