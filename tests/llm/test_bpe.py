import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import clashing
from tillroll.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), bpe.Bpe(PATH)
ODD = [
    "", "  a  b\n\n c ", "<|endoftext|>x <|endoftext|> y <|endoftext", "it's I'll we've 'S", "日本語テキスト 123 ½ ٣", "a\x1cb\x85c d",
    "é ́x", "😀😀 naïve", "    x", "\t\ttab\r\n\r\n  z", "\x00\x7f", "aaaa" * 200, "=" * 700, "\n" * 50,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=80))
def test_any_text(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == text


def test_every_character_is_split_like_the_library():
    for start in range(0, 0x110000, 0x1000):
        chars = [chr(c) for c in range(start, start + 0x1000) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}'s 1{c}1 {c}{c}.{c}'ll\n" for c in chars)
        own = [w for w in OWN.split(text)]
        theirs = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert own == theirs, hex(start)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(sorted(map(chr, OWN.disputed))[:400] + list("a1 's.\n")), st.characters(codec="utf-8")), max_size=40))
def test_newer_scripts(text):
    assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_words_merge_alike():
    rnd = random.Random(4)
    for _ in range(20):
        ids = [OWN.first[b] for b in "".join(rnd.choices("abetho ", k=400)).encode()]
        assert OWN._by_heap(list(ids)) == OWN._by_scan(list(ids))


def test_broken_bytes_decode_like_the_library():
    ids = LIBRARY.encode("日本 😀", add_special_tokens=False).ids
    for cut in range(len(ids)):
        assert OWN.decode(ids[cut:]) == LIBRARY.decode(ids[cut:], skip_special_tokens=False)


def test_round_trip(docs, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 4)
    texts = [*ODD, None]
    got = {r.doc_id: r for r in bpe.round_trip(clashing(docs(texts)), PATH).collect()}
    for i, text in enumerate(texts):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_decode_frames(docs):
    texts = ["hello world", "", None, "hello world"]
    back = bpe.decode(bpe.encode(docs(texts), PATH), PATH)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(0, "hello world"), (1, ""), (2, ""), (3, "hello world")]
    assert bpe.round_trip(docs([]), PATH).count() == 0
