import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import clashing
from tillroll.llm import phrases
from tillroll.llm.phrases import DoubleArray

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute(rows, min_count, best=2000, max_words=5, percent=100):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(str.maketrans(UPPER, UPPER.lower()))):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if a >= min_count and len(p[1]) > 1}
    out = {}
    for (lang, p), a in candidates.items():
        longer = (
            b for (other, q), b in candidates.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        )
        if any(100 * b >= percent * a for b in longer):
            continue
        cuts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        scored = [(1000 * a * total[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts)]
        score, _, l, r = min(scored)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, total[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:best], 1)
    )


def mined(docs, rows, **options):
    table = docs([(i, text) for i, (_, text) in enumerate(rows)]).drop("lang")
    langs = table.sparkSession.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, lang string")
    return sorted(tuple(r) for r in phrases.collocations(table.join(langs, "doc_id"), **options).collect())


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["New", "york", "of", "the", "a", "é", "İ", "x_y", " ", "city", ".", "of the", "a,b", "\t", "\n", "the the the"]
    langs = ["en", "de", None, "und", ""]
    return [(langs[rng.integers(0, 5)], " ".join(rng.choice(words, rng.integers(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"max_vocabulary": 4, "max_phrases": 5}, {"best": 3}, {"max_words": 3}])
def test_equals_brute_force(docs, options):
    rows = [*texts(3, 60), ("en", None), ("en", ""), ("en", " .,;\n"), (None, "one")]
    kept = {k: v for k, v in options.items() if k in ("best", "max_words")}
    assert mined(docs, rows, min_count=4, **options) == brute(rows, 4, **kept)


def test_contained_phrases_go_by_percent(docs):
    rows = [("en", "a b c. a b c. a b c. a b d. a b e")]
    for percent in (50, 60, 61, 100):
        assert mined(docs, rows, min_count=2, contained_percent=percent) == brute(rows, 2, percent=percent)


def test_ties_at_the_end_go_by_bytes(docs):
    rows = [("en", ". ".join(f"{w}1 {w}2" for w in ["z", "é", "a", "Z", "𝒳", "b"] for _ in range(3)))]
    assert mined(docs, rows, min_count=3, best=4) == brute(rows, 3, best=4)


def test_long_texts_and_slices(docs, monkeypatch):
    long = "spark moves rows. " * 20_000
    assert mined(docs, [("en", long), ("en", "spark moves")], min_count=100) == brute([("en", long), ("en", "spark moves")], 100)
    rows = texts(5, 30)
    monkeypatch.setattr(phrases, "_SLICE_BYTES", 64)
    assert mined(docs, rows, min_count=3) == brute(rows, 3)


def test_empty_tables_clashing_names_and_scarce_words(docs):
    assert mined(docs, [("en", "a b"), ("en", "c d")], min_count=2) == []
    assert mined(docs, [("en", "a. a. b, b")], min_count=2) == []
    assert phrases.collocations(docs([]), min_count=1).collect() == []
    rows = [("en", "a b a b")] * 3
    table = clashing(docs([t for _, t in rows]))
    assert sorted(tuple(r) for r in phrases.collocations(table, min_count=2).collect()) == brute(rows, 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 5), st.sampled_from([2, 9, 70, 5000]))
def test_double_array_finds_what_a_dictionary_finds(seed, words, most):
    rng = np.random.default_rng(seed)
    known = np.unique(rng.integers(1, most, (rng.integers(1, 300), words)), axis=0)
    trie = DoubleArray(known, np.arange(1, len(known) + 1))
    text = [np.append(known[rng.integers(0, len(known))], rng.integers(0, 3 * most, 2)) for _ in range(30)]
    ids = np.concatenate(text).astype(np.int32)
    expected = {tuple(p): i for i, p in enumerate(known.tolist(), 1)}
    assert trie.states(ids).tolist() == [expected.get(tuple(ids[i : i + words].tolist()), 0) for i in range(len(ids))]
