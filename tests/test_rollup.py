import threading

import pytest

from tillroll.sinks import rollup, writers
from tillroll.sinks.rollup import Rollup

SCHEMA = "group_key string, sum_minor bigint, purchase_count bigint"


@pytest.fixture
def states(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def all_of(grown):
    return {tuple(r) for r in grown.states().collect()}


def test_slices_count_once(spark, states, tmp_path):
    grown = Rollup(spark, str(tmp_path / "r"))
    assert all_of(grown) == set() and grown.slices().collect() == []
    assert grown.merge("day 1", states(("a", 10, 1), ("b", 5, 2), ("a", 1, 1)))
    assert grown.merge("2/é.csv", states(("a", 7, 1), ("c", 0, 1)))
    want = {("a", 18, 3), ("b", 5, 2), ("c", 0, 1)}
    assert all_of(grown) == want
    assert not grown.merge("day 1", states(("b", 5, 2), ("a", 11, 2)))  # the same states, dealt otherwise
    with pytest.raises(writers.OutputError, match="other states"):
        grown.merge("day 1", states(("a", 99, 1)))
    assert all_of(grown) == want
    assert {tuple(r) for r in grown.slices().collect()} == {("day 1", 2, 4, 16), ("2/é.csv", 2, 2, 7)}


def test_compaction_changes_no_result(spark, states, tmp_path):
    grown = Rollup(spark, str(tmp_path / "r"))
    want = {}
    for day in range(7):
        rows = [(f"k{(day * 3 + i) % 11}", day * 100 + i, 1) for i in range(5)]
        assert grown.merge(str(day), states(*rows))
        for key, amount, _ in rows:
            old = want.get(key, (0, 0))
            want[key] = (old[0] + amount, old[1] + 1)
        if day in (2, 4, 5):
            grown.compact(ranges=3)
    assert all_of(grown) == {(k, s, n) for k, (s, n) in want.items()}
    assert {r.slice for r in grown.slices().collect()} == set(map(str, range(7)))
    assert not grown.merge("0", states(*[(f"k{i % 11}", i, 1) for i in range(5)]))
    grown.compact()
    grown.compact()  # nothing is left to do
    again = Rollup(spark, str(tmp_path / "r"))
    assert all_of(again) == all_of(grown) and not list((tmp_path / "r" / "slices").iterdir())


def test_a_compaction_that_dies_before_it_cleans_up(spark, states, tmp_path, monkeypatch):
    grown = Rollup(spark, str(tmp_path / "r"))
    grown.merge("a", states(("k", 1, 1)))
    grown.merge("b", states(("k", 2, 1)))
    with monkeypatch.context() as m:
        m.setattr(rollup.writers, "discard", lambda *a: None)
        grown.compact()
    assert {p.name for p in (tmp_path / "r" / "slices").iterdir() if not p.name.endswith(".claim")} == {"a", "b"}
    assert all_of(grown) == {("k", 3, 2)}


def test_two_writers_of_one_slice(spark, states, tmp_path):
    grown, done = Rollup(spark, str(tmp_path / "r")), []
    rows = states(("k", 5, 1), ("l", 6, 1))

    def merge():
        try:
            done.append(grown.merge("s", rows))
        except writers.OutputError:
            done.append(None)

    threads = [threading.Thread(target=merge) for _ in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert done.count(True) == 1 and all_of(grown) == {("k", 5, 1), ("l", 6, 1)}
