import random
import zlib
from itertools import product

from tests.llm.conftest import clashing
from tillroll.llm import sharding


def test_difference_of_two_is_near_the_optimum():
    rnd = random.Random(8)
    for _ in range(30):
        sizes = [rnd.randint(1, 1000) for _ in range(10)]
        subsets = sharding.difference([[(s, [i])] for i, s in enumerate(sizes)], 2)
        assert sorted(i for _, members in subsets for i in members) == list(range(10))
        assert all(total == sum(sizes[i] for i in members) for total, members in subsets)
        best = min(abs(sum(s if side else -s for s, side in zip(sizes, sides))) for sides in product((0, 1), repeat=10))
        assert abs(subsets[0][0] - subsets[1][0]) <= best + max(sizes) // 4


def test_difference_beats_greedy():
    rnd = random.Random(9)
    sizes = [int(rnd.paretovariate(1.3) * 100) for _ in range(3000)]
    subsets = sharding.difference([[(s, [i])] for i, s in enumerate(sizes)], 8)
    greedy = [0] * 8
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    totals = [t for t, _ in subsets]
    assert len(totals) == 8 and sum(totals) == sum(sizes)
    assert max(totals) - min(totals) <= max(greedy) - min(greedy)
    assert sharding.difference([], 3) == []


def test_tree_of_nodes(spark):
    rnd = random.Random(10)
    rows = [(i * 7919, rnd.randint(16, 5000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "item long, size long")
    placed = {r.item: r.shard for r in sharding.balanced(df, 10, per_task=100, fan_in=4).collect()}
    totals = [0] * 10
    for item, size in rows:
        totals[placed[item]] += size
    assert set(placed) == {i for i, _ in rows}
    assert max(totals) - min(totals) <= sum(totals) / 10 * 0.001


def test_assign(docs):
    rnd = random.Random(11)
    texts = [rnd.choice(["x", "ä", "😀"]) * rnd.randint(0, 400) for _ in range(1500)] + ["hot text"] * 300 + [None, ""]
    rows = sharding.assign(clashing(docs(texts)), shards=7, rows_per_cell=100).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    shards, slots, totals = {}, {}, [0] * 7
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        assert shards.setdefault(raw, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        totals[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(totals) - min(totals) <= 300 * (8 + 16)


def test_edges(docs):
    rows = sharding.assign(docs([(1, "a"), (1, "a"), (None, "a"), (2, "b")]), shards=3).collect()
    assert len(rows) == 4 and len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"a")}) == 1
    assert sorted(r.slot for r in rows if r.text_crc32 == zlib.crc32(b"a")) == [0, 1, 2]
    assert sharding.assign(docs([]), shards=3).count() == 0
