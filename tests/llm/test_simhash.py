import random

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import clashing
from tillroll.llm import simhash
from tillroll.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    """Smallest index by breadth-first search over all pairs."""
    seen = {}
    for start in range(len(prints)):
        if start in seen:
            continue
        todo = [start]
        while todo:
            i = todo.pop()
            if i not in seen:
                seen[i] = start
                todo += [j for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= bits]
    return [seen[i] for i in range(len(prints))]


@pytest.mark.parametrize(
    "text",
    [None, "", " \n\t", "one", "one two", "One TWO three", "a b c d", "É é x Ä", "x " * 70_000, "w\x1cv u", "tab\tcr\r\x0bvt\x0cff"],
)
def test_fingerprint(text):
    assert simhash.simhash(text) == plain_fingerprint(text)


def test_near_duplicates_equal_brute_force(spark, docs):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 2, 40, 200]))) for _ in range(40)]
    texts = list(base)
    for text in base:
        parts = text.split()
        if len(parts) > 100:
            for _ in range(3):
                parts[rnd.randrange(len(parts))] = rnd.choice(words)
                texts.append(" ".join(parts))
    texts += [None, "", base[3], base[3].upper()]
    prints = [plain_fingerprint(t) for t in texts]
    expected = plain_components(prints)
    got = {r.doc_id: r for r in simhash.near_duplicates(clashing(docs(texts))).collect()}
    assert [got[i].component_id for i in range(len(texts))] == expected
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert len(set(expected)) < len(set(prints))


@pytest.mark.parametrize("bits", [2, 3])
@pytest.mark.parametrize("bucket", [2048, 2])
def test_links_of_crowded_buckets(spark, monkeypatch, bits, bucket):
    if bits == 3 and bucket == 2:
        count = 12
    else:
        count = 60
    monkeypatch.setattr(simhash, "_BUCKET", bucket)
    rnd = random.Random(bits)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    prints = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for c in centres for _ in range(count // 3)})
    signed = np.array(prints, "<u8").view("<i8").tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = components(simhash.links(df, bits)).collect()
    groups = {}
    for r in links:
        groups.setdefault(r.component, set()).add(r.node)
    expected = {}
    for i, c in enumerate(plain_components(prints, bits)):
        expected.setdefault(c, set()).add(signed[i])
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_ids_and_empty_table(spark, docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "z y x w"), (None, "a b c d"), (None, "only nameless one"), (7, "z y x w")]
    got = sorted(f"{r.doc_id} {r.component_id}" for r in simhash.near_duplicates(docs(rows)).collect())
    assert got == ["5 5", "5 5", "5 5", "7 5", "None 5", "None None"]
    assert simhash.near_duplicates(docs([])).count() == 0
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(docs(rows)).collect())
    assert kept == [("5", "a b c d"), ("5", "z y x w"), ("None", "only nameless one")]
    assert simhash.keep_one(docs([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000 + i, 5000) for i in range(100)]
    rnd = random.Random(1)
    links = chain + star + [(7, 7), (9000, 9001)]
    rnd.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    expected = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(100)} | {5000: 1000, 9000: 9000, 9001: 9000}
    assert got == expected
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
