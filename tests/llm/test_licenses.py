import random
import re

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import licenses

TEXTS = [
    "MIT License, the mit\nlicense general-public license X mit licensé",
    "apache license apache license apache license",
    "general public license public license general public",
    "nothing here", "", None, "mit", "MİT LİCENSE K", "x" * 100_000 + " mit license " + "y " * 50_000 + "mit license",
    "This file: licensed under the Apache License, Version 2.0 (the License).",
    "Permission is hereby granted, free of any charge, to any person obtaining the copy of this software",
    "permission granted to any person",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
]


def plain(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_phrases_equal_brute_force(docs):
    rows = {r.doc_id: r for r in licenses.scan(clashing(docs(TEXTS))).collect()}
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1.0 or not r.n_base)


@pytest.mark.parametrize(
    "number, labels, score",
    [(9, "apache,apache-2.0", 1.0), (10, "mit", 0.8), (11, "", 0.0), (12, "cc-by-nc-4.0", 1.0), (13, "gpl,gpl-3.0", 1.0)],
)
def test_notices(docs, number, labels, score):
    row = licenses.scan(docs([TEXTS[number]])).first()
    assert (row.labels, row.score) == (labels, score)


def test_every_notice_is_found_with_a_word_more(docs):
    texts = [f"so {' '.join(p.split()[:-2])} surely {' '.join(p.split()[-2:])} it says" for p in licenses.NOTICES]
    rows = {r.doc_id: r for r in licenses.scan(docs(texts)).collect()}
    for i, label in enumerate(licenses.NOTICES.values()):
        assert label in rows[i].labels.split(",")


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under the terms of the GNU General Public License", "gpl"),
        ("Licensed under the GNU General Public License", "gpl"),
        ("Licensed under the Apache License, Version 1.1", "apache"),
        ("under the terms of the GNU Lesser General Public License", "gpl,lgpl"),
        ("Licensed under the GNU General Public License version 2", "gpl,gpl-2.0"),
        ("Licensed under the GNU Lesser General Public License version 3", "gpl,lgpl"),
        ("Licensed under the GNU Affero General Public License, version 3", "agpl,gpl"),
        ("Licensed under CC BY-ND 4.0", "cc-by-nd-4.0"),
        ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"),
        ("Licensed under CC BY-SA-NC 4.0", ""),
        (
            "under the terms of the GNU General Public License as published by the Free Software Foundation; "
            "either version 2 of the License, or (at your option) any later version",
            "gpl,gpl-2.0",
        ),
    ],
)
def test_variants_need_their_telling_words(docs, text, labels):
    assert licenses.scan(docs([text])).first().labels == labels


def plain_notices(text, least_cover=0.7, width=4):
    """Labels of the notices by votes that are counted one by one."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    spans = []
    for phrase, label in licenses.NOTICES.items():
        parts = phrase.split()
        places = {}
        for i in range(len(words) - 1):
            for p in range(len(parts) - 1):
                if words[i : i + 2] == parts[p : p + 2]:
                    places.setdefault(i - p, set()).add(p)
        needed = [p for p, w in enumerate(parts) if w in licenses.TELLING]
        for start in places:
            run = [(d, p) for d in places if start <= d <= start + width for p in places[d]]
            covered = {p for _, p in run}
            inside = words[min(d + p for d, p in run) : max(d + p for d, p in run) + 2]
            rest = iter(inside)
            told = all(p in covered or p - 1 in covered for p in needed) and all(parts[p] in rest for p in needed)
            other = any(w in licenses.FORBIDDING and w not in parts for w in inside)
            if len(covered) / (len(parts) - 1) >= least_cover and told and not other:
                spans.append((start, len(covered) / (len(parts) - 1), label))
    return {s[2] for s in spans if s[1] == max(t[1] for t in spans if abs(t[0] - s[0]) <= width)}


def test_labels_of_the_vote_equal_brute_force(docs):
    rnd = random.Random(8)
    extra = ["lesser", "nd", "version", "2", "word", "the", "sa", "gnu"]
    texts = []
    for _ in range(150):
        words = []
        for phrase in rnd.sample(list(licenses.NOTICES), 2):
            part = phrase.split()
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(part))
                part[at : at + rnd.randint(0, 1)] = [rnd.choice(extra)] * rnd.randint(0, 2)
            words += part + [rnd.choice(extra)] * rnd.randint(0, 6)
        texts.append(" ".join(words))
    for row in licenses.scan(docs(texts)).collect():
        base = set(filter(None, row.base_labels.split(",")))
        assert set(filter(None, row.labels.split(","))) == base | plain_notices(texts[row.doc_id])


def test_repeated_rows_and_empty_table(docs):
    rows = [(1, "mit license"), (1, "mit license"), (1, "apache license"), (None, "mit license")]
    got = sorted((str(r.doc_id), r.n_base, r.base_labels) for r in licenses.scan(docs(rows)).collect())
    assert got == [("1", 1, "apache"), ("1", 1, "mit"), ("1", 1, "mit"), ("None", 1, "mit")]
    assert licenses.scan(docs([])).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(docs(["x"]), base={"mit": "mit"})


def test_no_python_in_the_plan(docs):
    plan = licenses.scan(docs(["mit license"]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
