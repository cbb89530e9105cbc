import random

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import linededup


def plain(rows, percent=80):
    """Numbers of the lines that match an earlier line, by comparing all sets."""
    seen, out = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        for number, line in enumerate((text or "").split("\n")):
            words = frozenset(line.lower().split())
            if words:
                if any(100 * len(words & s) >= percent * len(words | s) for s in seen):
                    out.setdefault(doc_id, []).append(number)
                seen.append(words)
    return out


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]

    def line():
        return rnd.choices(words[:30] if rnd.random() < 0.3 else words, k=rnd.choice([1, 2, 3, 4, 5, 6, 10, 30]))

    pool, rows = [line() for _ in range(60)], []
    for doc_id in range(n):
        lines = []
        for _ in range(rnd.randint(0, 8)):
            own = list(rnd.choice(pool)) if rnd.random() < 0.6 else line()
            if rnd.random() < 0.5 and len(own) > 3:
                own[rnd.randrange(len(own))] = rnd.choice(words)
            lines.append(rnd.choice([" ".join(own), "\t" + "  ".join(own), " ".join(own).upper(), "", " ".join(own) + "\r"]))
        rows.append((doc_id, "\n".join(lines)))
    return rows + [(n, None), (None, rows[3][1])]


@pytest.mark.parametrize("picked", [1 << 18, 4])
@pytest.mark.parametrize("percent", [80, 60])
def test_equals_brute_force(docs, monkeypatch, picked, percent):
    monkeypatch.setattr(linededup, "_PICKED", picked)
    rows = corpus(percent)
    expected = plain(rows, percent)
    got = {r.doc_id: r for r in linededup.deduplicate(clashing(docs(rows)), percent).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        gone = expected.get(doc_id, [])
        lines = (text or "").split("\n")
        assert list(got[doc_id].removed_lines) == gone
        assert got[doc_id].n_lines == len(lines)
        assert got[doc_id].text == (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
        assert got[doc_id].n_chars == (None if text is None else len(got[doc_id].text))
    assert sum(map(len, expected.values())) > 100


def test_repeated_rows_long_line_and_empty_table(docs):
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, long), (3, long + " more"), (4, "a b c d e f")]
    got = sorted((r.doc_id, list(r.removed_lines)) for r in linededup.deduplicate(docs(rows)).collect())
    assert got == [(1, []), (1, []), (2, []), (3, [0]), (4, [0])]
    out = linededup.deduplicate(docs([]))
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "removed_lines"]


def test_no_python_in_the_plan(docs):
    plan = linededup.deduplicate(docs(["a b c d e"] * 3))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pairs_that_only_few_parity_bits_take_for_similar_are_not_made(spark, docs, monkeypatch):
    hashed = spark.range(4000).selectExpr("concat('w', id) AS word", "CAST(xxhash64(concat('w', id)) >> 32 AS INT) AS h").collect()
    alike = {}
    for r in hashed:  # two words each that fall on one of 64 bits, and on different ones of 256
        alike.setdefault(r.h & 63, {}).setdefault(r.h >> 6 & 3, r.word)
    (a, c), (b, d) = ([own[k] for k in sorted(own)][:2] for own in list(alike.values())[:2])
    common = [f"common{i}" for i in range(7)]
    often = [" ".join(x) for x in (common[:3], common[3:6], [common[6]], [a, b], [c, d])]
    texts = ["\n".join(often)] * 10 + [" ".join(["rare", *common, *two]) for two in ((a, b), (c, d))]
    hashes = linededup._hashed(linededup._words(linededup._texts(docs(texts))))
    sets = linededup._sets(hashes, linededup._ranks(hashes), 80)
    words = sets.selectExpr("*", "posexplode(prefix) AS (p, token)").drop("prefix")
    assert sets.count() == 2 and words.groupBy("token").count().where("count > 1").count() == 1
    assert linededup._candidates(words, 80).count() == 0


def test_only_wanted_lines_are_split_into_words(docs, monkeypatch):
    monkeypatch.setattr(linededup, "_PICKED", 1)
    texts = linededup._texts(docs(["\n".join(f"Word{i} a{j}" for j in range(50)) for i in range(40)] + [(None, "x\ny")]))
    places = texts.selectExpr("doc_id", "digest << 31 | 1 AS place").where("doc_id IS NULL OR doc_id < 20")
    wanted = places.unionByName(places.selectExpr("doc_id", "place + 0 AS place").where("doc_id = 3").selectExpr("doc_id", "place + 4 AS place"))
    got = {(r.doc_id, r.place & 2147483647): list(r.words) for r in linededup._picked(texts, wanted).collect()}
    assert got == {(i, 1): [f"word{i}", "a1"] for i in range(20)} | {(3, 5): ["word3", "a5"], (None, 1): ["y"]}


@pytest.mark.parametrize("percent", [55, 80, 95])
def test_sets_of_different_classes_of_size_meet(docs, percent):
    rnd, rows = random.Random(percent), []
    for group in range(40):
        words = [f"g{group}w{i}" for i in range(rnd.randint(4, 90))]
        shorter = [words[: max(1, -(-len(words) * percent // 100) + d)] for d in (-1, 0, 1)]
        rows.append((group, "\n".join(" ".join(x) for x in rnd.sample([words, rnd.choice(shorter), rnd.choice(shorter)], 3))))
    expected = plain(rows, percent)
    got = {r.doc_id: list(r.removed_lines) for r in linededup.deduplicate(docs(rows), percent).collect()}
    assert got == {doc_id: expected.get(doc_id, []) for doc_id, _ in rows}


def test_sets_of_other_sizes_do_not_meet(spark):
    words = spark.range(200).selectExpr("id AS doc_id", "id AS place", "CAST(id + 5 AS INT) AS n", *(f"0L AS s{k}" for k in range(4)), "0 AS p", "7 AS token")
    met = linededup._classed(words, 80)
    assert met.groupBy("meeting").count().agg({"count": "max"}).first()[0] < 150
    assert met.where("home").count() == 200
