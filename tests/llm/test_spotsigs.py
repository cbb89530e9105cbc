import hashlib
import random
import re

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import spotsigs


def plain_signatures(text, chain=2):
    words = re.findall(r"[^\W_]+", text.lower())
    content = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out, before = set(), -1
    for k, i in enumerate(content):
        out |= {(words[a], *(words[c] for c in content[k : k + chain])) for a in range(before + 1, i)}
        before = i
    return out or {tuple(words[i : i + chain]) for i in range(len(words))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def corpus():
    rnd = random.Random(12)
    common, rare = ["the", "of", "and", "der", "la", "is"], [f"word{i}" for i in range(200)]

    def text(n):
        return " ".join(rnd.choice(common if rnd.random() < 0.4 else rare) for _ in range(n))

    base = [text(n) for n in (0, 1, 2, 5, 40, 60, 80, 120)]
    texts = list(base)
    for _ in range(60):
        words = rnd.choice(base[4:]).split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(rare)
        texts.append(" ".join(words))
    return texts + [None, "", "rare words only here", "the of and", "ÄÖÜ émile 😀 the ½ x_y"]


@pytest.mark.parametrize("pivots", [1, 3])
def test_fingerprints_equal_brute_force(docs, monkeypatch, pivots):
    monkeypatch.setattr(spotsigs, "_PIVOTS", pivots)
    texts = corpus()
    frame = clashing(docs([(3 * i, t) for i, t in enumerate(texts)]))
    rows = {r.doc_id: r for r in spotsigs.fingerprints(frame).collect()}
    found = {r.doc_id: r for r in spotsigs.classes(frame).collect()}
    texts = [t or "" for t in texts]
    sets = [plain_signatures(t) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for i, text in enumerate(texts):
        row, following = rows[3 * i], (i + 1) % len(texts)
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[following][:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == pytest.approx(jaccard(sets[i], plain_signatures(edited)))
        assert row.near_next == pytest.approx(jaccard(sets[i], sets[following]))
        for j in range(i):
            assert (rows[3 * j].fingerprint == row.fingerprint) == (sets[i] == sets[j])
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    assert all(found[i].fingerprint == rows[i].fingerprint for i in rows)
    assert [found[3 * i].class_id for i in range(len(texts))] == [3 * top(i) for i in range(len(texts))]


@pytest.mark.parametrize("rows_per_range, most", [(37, 4096), (1, 5), (10**6, 4096)])
def test_order_over_many_ranges(docs, rows_per_range, most):
    rnd = random.Random(13)
    ids = {rnd.choice([-5, 0, 7, rnd.randint(-(10**12), 10**12)]) for _ in range(400)}
    rows = [(i, f"text {i}") for i in ids] + [(7, "text 7"), (0, "text 0")]
    frame = spotsigs.with_next_text(docs(rows), rows_per_range, most)
    order = sorted(ids)
    expected = dict(zip(order, order[1:] + order[:1]))
    got = [(r.id, r.next_text) for r in frame.collect()]
    assert sorted(got) == sorted((i, f"text {expected[i]}") for i, _ in rows)


def test_repeated_rows_nulls_and_empty_table(docs):
    rows = [(1, "the house of cards"), (1, "the house of cards"), (2, "the house of cards"), (None, "x the y")]
    got = sorted((str(r.doc_id), r.near_next) for r in spotsigs.fingerprints(docs(rows)).collect())
    assert got == [("1", 1.0), ("1", 1.0), ("2", 0.0), ("None", 0.0)]
    assert sorted(f"{r.doc_id} {r.class_id}" for r in spotsigs.classes(docs(rows)).collect()) == ["1 1", "1 1", "2 1", "None None"]
    assert spotsigs.fingerprints(docs([])).count() == 0 and spotsigs.classes(docs([])).count() == 0
    only = spotsigs.fingerprints(docs([(9, "abcd")])).first()
    assert (only.near_next, only.edited_sha256) == (1.0, hashlib.sha256(b"abab").hexdigest())


def test_no_python_in_the_plan(docs):
    plan = spotsigs.fingerprints(docs(["the a b"] * 3))._jdf.queryExecution().toString()
    plan += spotsigs.classes(docs(["the a b"] * 3))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_a_hot_group_of_near_copies_equals_brute_force(docs):
    rnd = random.Random(14)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choice(["the", "of"]) if i % 3 == 0 else rnd.choice(words) for i in range(120)]
    texts = []
    for _ in range(1200):
        copy = list(base)
        for _ in range(rnd.randint(0, 7)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        texts.append(" ".join(copy))
    sets = [plain_signatures(t) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sorted((top(i), top(j)))
            if a != b and jaccard(sets[i], sets[j]) >= 0.8:
                parent[b] = a
    found = {r.doc_id: r.class_id for r in spotsigs.classes(docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == [top(i) for i in range(len(texts))]
    assert len(set(found.values())) > 1


def test_more_rounds_of_pivots_leave_fewer_pairs_between_parts(spark, monkeypatch):
    rnd = random.Random(5)
    own = [sorted(rnd.sample(range(27), 24)) for _ in range(400)]
    own = sorted({tuple(o) for o in own})
    schema = "node long, n int, own array<bigint>"
    sets = spark.createDataFrame([(i, len(o), list(o)) for i, o in enumerate(own)], schema)
    between, made = spotsigs._between_parts, []

    def counted(*args):
        pairs = between(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(spotsigs, "_between_parts", counted)
    monkeypatch.setattr(spotsigs, "_PIVOTS", 1)
    labels = []
    for rounds in (1, 3):
        monkeypatch.setattr(spotsigs, "_ROUNDS", rounds)
        found = spotsigs.links(sets, spotsigs._ranks(sets), 80)
        labels.append({tuple(r) for r in spotsigs.components(found).collect()})
    assert labels[0] == labels[1] and made[1] * 2 < made[0]
