"""Token-id blocks: exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from edgeloom.llm import tokens
from tests.llm import helpers as h

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 65535), st.sampled_from([0, 1, 65535])), max_size=60), min_size=1, max_size=6))
def test_round_trip(blocks):
    arrays = [np.array(b, np.uint32) for b in blocks]
    words = tokens.encode_blocks(arrays)
    back = tokens.decode_blocks(words, np.array([len(b) for b in arrays], np.int64))
    assert [b.tolist() for b in back] == blocks


def test_repetition_is_cheap_and_blocks_are_independent():
    ids = np.tile(np.array([5, 40000, 7, 123, 9], np.uint32), 800)
    both = tokens.encode_blocks([ids, ids[:100]])
    alone = tokens.encode_blocks([ids[:100]])
    assert np.array_equal(both[1], alone[0])
    assert 2 * len(both[0]) < 0.2 * 2 * len(ids)


def test_late_nibbles_follow_two_ids(monkeypatch):
    ids = [1, 2]
    draw = np.random.default_rng(5).integers(0, 2, 8000).tolist()
    for x in draw:
        ids.append(ids[-1] if x and len(ids) % 7 == 0 else 1 + (3 * ids[-1] + 5 * ids[-2]) % 61)
    block = np.array(ids, np.uint16)
    size = len(tokens.encode_blocks([block])[0])
    monkeypatch.setattr(tokens, "MODELS", (3, 3, 2, 2))
    assert size < 0.95 * len(tokens.encode_blocks([block])[0])


def test_unlikely_ids_after_likely_ones_come_back():
    rng = np.random.default_rng(6)
    turns = [np.concatenate([np.full(k, 7), rng.integers(0, 65536, 1 + k % 3), [65535, 0, 65535]]) for k in range(0, 700, 25)]
    block = np.concatenate(turns).astype(np.uint32)
    blocks = [block, block[:1], block[::-1].copy(), block[:0]]
    back = tokens.decode_blocks(tokens.encode_blocks(blocks), np.array([len(b) for b in blocks]))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_words_are_encoded_once_in_all_batches(monkeypatch):
    asked = []
    plain = tokens.WordEncoder.words
    monkeypatch.setattr(tokens.WordEncoder, "words", lambda self, words: asked.extend(words) or plain(self, words))
    encoder = tokens.WordEncoder(PATH)
    texts = ["The cat, the CAT. l'été cat!", "the Cat; été l'été, 42", "the cat"]
    for text in texts:
        ids, many = encoder.encode(pa.array([text]))
        assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids and many.tolist() == [len(ids)]
    assert len(asked) == len(set(asked)) and {"the", "cat", "l'été"} < set(asked)
    assert not {"The", "cat,", "CAT.", "Cat;"} & set(asked)


def test_words_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 70)
    encoder = tokens.WordEncoder(PATH)
    for text in ("one two three", "four five six", "one two three four five six seven", "", "six 7", "42 eight 9 nine", "一" * 50):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert set(encoder.known) <= {"一" * 50, ""}


ENCODER = tokens.WordEncoder(PATH)
LETTERS = "aAzZéÉßſİΣσςÀà\u0300\u0338Kªµǆǅ中가1²½'’s.,;!?<>|=`^~-_\"*%\u00a0\u200b\u3000 \t\n"


def test_latin_letters_before_signs():
    letters = [chr(i) for i in [*range(65, 91), *range(97, 123), *range(0xAA, 0x260)]]
    texts = [a + c + signs for c in letters for a in ("", "tH") for signs in (",", "'!", "^", "-")]
    ids, many = ENCODER.encode(pa.array(texts))
    wanted = ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])] == [e.ids for e in wanted]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.text(LETTERS, max_size=12), st.text(max_size=6),
    st.sampled_from(["don't", "I'LL", "l'été,", "<|startoftext|>", "<|ENDOFTEXT|>", "A.", "é!!", "x'", "Ça»"]),
), max_size=12))
def test_ids_are_the_library_s(words):
    texts = [" ".join(words), *words]
    ids, many = ENCODER.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(many)[:-1])] == [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_damage_is_found():
    payload = tokens.pack(tokens.encode_blocks([np.arange(50, dtype=np.uint32)])[0], 50, [50], [3])
    assert tokens.unpack(payload)[1:] == (50, [50], [3])
    broken = bytearray(payload)
    broken[-3] ^= 1
    with pytest.raises(ValueError):
        tokens.unpack(bytes(broken))


@pytest.mark.parametrize("block, lanes", [(8192, 1024), (7, 3)])
def test_documents_come_back(spark, tmp_path, block, lanes):
    rng = random.Random(block)
    rows = [(i, h.sentence(rng, rng.randint(0, 40))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "L'été—«Ça»  va?\n\t42 %%% ΣΑΣ   é"), (None, "without an id"), (5, "the id again"), (73, " \n")]
    rng.shuffle(rows)
    docs = h.documents(spark, rows, ("tie", "block", "part"))
    path = str(tmp_path / "ids")
    tokens.write_ids(docs, path, PATH, block=block, lanes=lanes)
    found = tokens.read_ids(spark, path, lanes=lanes, with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    wanted = {}
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        wanted.setdefault(doc, []).append(np.array(ids, "<u4").tobytes())
    start = 0
    for r in found:
        raw = bytes(r.ids)
        assert raw in wanted[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(raw) // 4, zlib.crc32(raw))
        start += r.n_tokens
    assert [r.doc_id for r in found] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "ids")
    tokens.write_ids(h.documents(spark, []), path, PATH)
    assert tokens.read_ids(spark, path).count() == 0
