import hashlib
from collections import defaultdict

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import exactdedup
from tillroll.llm.exactdedup import DigestIndex, deduplicate, digests


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out, kept = [], set()
    for i, text in rows:
        ids = groups[text or ""]
        best = max(ids, key=lambda x: (x is not None, x or 0))
        first = i == best and (text or "") not in kept
        if first:
            kept.add(text or "")
        out.append((i, best, len(ids), first, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, rows, **options):
    return sorted((tuple(r) for r in deduplicate(docs(rows), **options).collect()), key=repr)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (9, "a "), (7, "A"), (7, "A"), (None, "a"), (None, "z"), (None, "z"), (12, "é" * 200_000)]


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 5}, {"rows_per_bucket": 2}])
def test_equals_brute_force(docs, options):
    assert found(docs, ROWS, **options) == brute(ROWS)


def test_a_hot_text_and_extreme_ids(docs):
    rows = [(i, "same" if i % 3 else f"text {i // 2}") for i in range(3000)] + [(2**63 - 1, "same"), (-(2**63), "text 0")]
    assert found(docs, rows, rows_per_bucket=500, batches=3) == brute(rows)


def test_empty_tables_and_clashing_names(docs):
    assert found(docs, []) == []
    rows = [(i, f"t{i % 2}") for i in range(6)]
    table = clashing(docs(rows))
    assert sorted((tuple(r) for r in deduplicate(table).collect()), key=repr) == brute(rows)


def test_texts_are_compared_normalised(docs):
    from pyspark.sql import functions as F

    rows = deduplicate(docs([(1, "A b"), (2, "a  B")]), normalise=lambda t: F.lower(F.regexp_replace(t, " +", " ")))
    assert {r.keep_id for r in rows.collect()} == {2}


def test_new_batches_are_held_against_an_index_that_is_opened_again(spark, docs, tmp_path):
    path = f"{tmp_path}/it's an index"
    first = DigestIndex(spark, path, 4)
    first.add(digests(docs([(1, "a"), (2, "b"), (3, "a")])))
    first.close()
    again = DigestIndex(spark, path, 4)
    batch = digests(docs([(4, "a"), (5, "c"), (6, "c")]))
    assert {r.doc_id for r in again.unknown(batch).collect()} == {5, 6}
    again.add(batch)
    again.add(batch)  # a batch that comes twice changes nothing
    assert sorted(r.doc_id for r in again.entries().collect()) == [2, 3, 6]
    again.close()


def test_the_anti_join_merges_buckets_without_moving_the_index(spark, docs, tmp_path):
    index = DigestIndex(spark, f"{tmp_path}/index", 4)
    rows = digests(docs([(i, f"t{i}") for i in range(50)]))
    index.add(rows)
    plan = index.unknown(rows.groupBy("digest").agg(exactdedup.F.max("doc_id")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") <= 2 and "BroadcastExchange" not in plan
    index.close()
