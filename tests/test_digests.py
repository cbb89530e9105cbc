import datetime
import hashlib
import random

import pytest

from tillroll.operators import digests, manifest
from tillroll.operators.digests import Shape
from tillroll.plans.catalog import block_drift, block_manifest
from tillroll.session import materialize

SCHEMA = "uri string, offset bigint, value string"


def words_text(lines):
    sums = [0] * 8
    for offset, value in lines:
        hashed = hashlib.sha256(f"{offset}:{value}".encode()).hexdigest()
        for i in range(8):
            sums[i] += int(hashed[8 * i : 8 * i + 8], 16)
    return ":".join([str(len(lines)), *(str(s % 2**64) for s in sums)])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(rows, shape):
    nodes = {}
    for uri, offset, value in rows:
        nodes.setdefault((uri, offset // shape.block_bytes), []).append((offset, value))
    level = {
        k: (min(o for o, _ in v), max(o + len(t.encode()) for o, t in v), len(v), sha(words_text(v))) for k, v in nodes.items()
    }
    out = {(u, 0, n): v for (u, n), v in level.items()}
    for height in range(1, shape.height + 1):
        above = {}
        for (uri, node), v in sorted(level.items()):
            above.setdefault((uri, node // shape.fanout), []).append((node, v))
        level = {
            k: (min(v[0] for _, v in c), max(v[1] for _, v in c), sum(v[2] for _, v in c), sha("\n".join(f"{n}:{v[3]}" for n, v in c)))
            for k, c in above.items()
        }
        out |= {(u, height, n): v for (u, n), v in level.items()}
    return out


def lines_of(uri, texts):
    position = 0
    for text in texts:
        yield uri, position, text
        position += len(text.encode()) + 1


def made(seed, n=300):
    rng = random.Random(seed)
    return [rng.choice(["", "é", "x" * rng.randrange(40), "a,b", "\r"]) for _ in range(n)]


def test_lines_that_occur_twice_count(spark):
    left = spark.createDataFrame([("f", 1, "aaa"), ("f", 1, "aaa"), ("f", 5, "x")], SCHEMA)
    right = spark.createDataFrame([("f", 2, "bbb"), ("f", 2, "bbb"), ("f", 5, "x")], SCHEMA)
    found = manifest.input_drift(manifest.line_manifest(left), manifest.line_manifest(right)).collect()
    assert [tuple(r) for r in found] == [("f", "content")]


def test_digest_equals_its_formula_in_any_order(spark):
    rows = [*lines_of("a", made(1)), *lines_of("b", made(2)), ("a", 0, "again"), ("far", 2**40, "x")]
    for parts in (1, 7):
        frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = {r.uri: (r.bytes, r.sha256) for r in manifest.line_manifest(frame).collect()}
        for uri in ("a", "b", "far"):
            own = [(o, v) for u, o, v in rows if u == uri]
            assert got[uri] == (sum(len(v.encode()) + 1 for _, v in own), sha(words_text(own)))
    assert manifest.line_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("shape", [Shape(), Shape(64, 2, 8), Shape(500, 3, 4)])
def test_tree_equals_brute_force(spark, shape):
    rows = [*lines_of("a", made(3)), *lines_of("b", made(4, 40)), *lines_of("c", ["one"])]
    nodes = digests.tree(spark.createDataFrame(rows, SCHEMA).repartition(5), shape)
    got = {(r.uri, r.level, r.node): (r.first_byte, r.last_byte, r.lines, r.sha256) for r in nodes.collect()}
    assert got == brute_tree(rows, shape)
    tops = digests.roots(nodes, shape).collect()
    assert {r.uri: r.bytes for r in tops} == {u: max(o + len(v.encode()) + 1 for x, o, v in rows if x == u) for u in "abc"}


def test_trees_that_are_too_small_fail(spark):
    with pytest.raises(Exception, match="room for"):
        digests.tree(spark.createDataFrame([("a", 0, "x"), ("a", 900, "y")], SCHEMA), Shape(100, 2, 2)).collect()
    for bad in ((0, 2, 1), (2**32, 2, 1), (1, 1, 1), (1, 2, 0)):
        with pytest.raises(ValueError):
            Shape(*bad)


def test_forests_have_room_for_any_file(spark):
    shape = Shape(100, 2, 2, forest=True)
    rows = [*lines_of("a", made(7, 300)), *lines_of("b", made(8, 5))]
    other = [(u, o, "changed" if i == 250 else v) for i, (u, o, v) in enumerate(rows)]
    trees = [digests.tree(spark.createDataFrame(x, SCHEMA).repartition(5), shape) for x in (rows, other)]
    got = {(r.uri, r.level, r.node): (r.first_byte, r.last_byte, r.lines, r.sha256) for r in trees[0].collect()}
    assert got == brute_tree(rows, shape) and max(n for _, level, n in got if level == 2) > 0
    (found,) = digests.tree_drift(*trees, shape).collect()
    assert found.uri == "a" and found.change == "content" and found.first_byte <= rows[250][1] <= found.last_byte
    with pytest.raises(ValueError):
        digests.roots(trees[0], shape)


@pytest.mark.parametrize("query", [block_manifest, block_drift])
def test_block_queries_take_any_event_id(spark, tmp_path, query):
    ts = datetime.datetime(2024, 5, 4, 12)
    events = [(i, ts, 1, "purchase", 1.5, '{"k": 3}') for i in (0, 89, 300, 2_000_000, 5_999_999)]
    frame = spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    frame.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    rows = query(spark, str(tmp_path)).collect()
    if query is block_drift:
        assert {(r.first_byte // 256, r.change) for r in rows} == {(0, "content")}
    else:
        assert sorted((r.node, r.lines) for r in rows if r.level == 4) == [(0, 3), (1, 1), (5, 1)]


def test_drift_names_the_blocks(spark):
    shape = Shape(100, 3, 5)
    base = made(5, 400)
    other = list(base)
    other[200] = "changed" if base[200] != "changed" else "x"
    short = base[:390]
    before = [*lines_of("same", base), *lines_of("edited", base), *lines_of("cut", base), *lines_of("gone", base[:3])]
    after = [*lines_of("same", base), *lines_of("edited", other), *lines_of("cut", short), *lines_of("new", base[:3])]
    trees = [digests.tree(spark.createDataFrame(rows, SCHEMA), shape) for rows in (before, after)]
    got = {(r.uri, r.change, r.first_byte, r.last_byte) for r in digests.tree_drift(*trees, shape).collect()}
    a, b = (brute_tree(rows, shape) for rows in (before, after))
    want = set()
    for uri, level, node in set(a) | set(b):
        x, y = a.get((uri, level, node)), b.get((uri, level, node))
        if level == 0 and (x is None or y is None or x[3] != y[3]):
            known = [v for v in (x, y) if v]
            change = "missing" if y is None else "added" if x is None else "content"
            want.add((uri, change, min(v[0] for v in known), max(v[1] for v in known)))
    assert got == want and {u for u, *_ in got} == {"edited", "cut", "gone", "new"}


def test_equal_trees_are_not_descended(spark, monkeypatch):
    shape = Shape(50, 4, 5)
    trees = [digests.tree(spark.createDataFrame(list(lines_of("a", made(6))), SCHEMA), shape) for _ in range(2)]
    seen = []
    monkeypatch.setattr(digests, "materialize", lambda df: seen.append(df) or materialize(df))
    assert digests.tree_drift(*trees, shape).collect() == []
    assert len(seen) == 1  # the roots only
