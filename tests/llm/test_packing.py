import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import clashing
from tillroll.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "  a  b\n\n c", "<|endoftext|>x <|startoftext|> y", "it's I'll", "日本語 123 ½", "a\x1cb\x85c d", "é ́x ΑΣ ΑΣΑ",
    "Wow!? Été. Ça, fin; A.B. c.", "<|ENDOFTEXT|> It'S. NO.", "a.\u0301 b\u0301. x'. y.,z \u00d7. ß!", "end.", "A\u030a. ĳ. µ, ª.",
    "İstanbul K", "\t\ttab\r\n", "x" * 5000 + " " + "ab " * 9000,
]


def plain_fit(sizes, capacity, open_bins):
    """Best fit by looking at every open bin."""
    free, order, out = {}, 0, []
    for size in sizes:
        fitting = [(f, b) for b, f in free.items() if f >= size]
        if fitting:
            room = min(f for f, _ in fitting)
            out.append((None, capacity - room, room))
            number = next(b for f, b in fitting if f == room)
        else:
            if len(free) >= open_bins:
                del free[min(free, key=lambda b: free[b])]
            number, order, room = order, order + 1, capacity
            out.append((None, 0, capacity))
        free.pop(number, None)
        if room - size:
            free[number] = room - size
    return order, out


@pytest.mark.parametrize("open_bins", [1, 4, 1000])
def test_best_fit(open_bins):
    rnd = random.Random(open_bins)
    sizes = [rnd.randint(1, 64) for _ in range(2000)]
    fit = packing.BestFit(64, open_bins)
    places = [fit.put(s) for s in sizes]
    count, plain = plain_fit(sizes, 64, open_bins)
    assert fit.opened == count
    assert [o for _, o in places] == [o for _, o, _ in plain]
    assert fit.still_open <= open_bins


def check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for doc_id, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        got = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in got] == [
            (n, at, min(capacity, len(ids) - at)) for n, at in enumerate(range(0, len(ids), capacity))
        ]
        assert [r.ids_crc32 for r in got] == [
            zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in got
        ]
    for pieces in by_bin.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= capacity
    return len(by_bin)


def test_pack(docs):
    rnd = random.Random(2)
    texts = ODD + [" ".join(rnd.choices(["alpha", "be", "Gamma,", "δ"], k=rnd.randint(0, 900))) for _ in range(150)]
    rows = packing.pack(clashing(docs(texts)), PATH).collect()
    assert check(rows, texts, 4096) <= sum(r.length for r in rows) / 4096 * 1.1 + 1


def test_small_capacity_and_memory(docs, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 3)
    texts = ["a b c d e f g h", "i j k " + "l" * 100, "", "m n o p q"]
    check(packing.pack(docs(texts), PATH, capacity=5).collect(), texts, 5)


def test_repeated_rows_and_empty_table(docs):
    rows = packing.pack(docs([(3, "a b"), (3, "a b"), (None, "a b")]), PATH).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("3", 3), ("3", 3), ("None", 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(docs([]), PATH).count() == 0
