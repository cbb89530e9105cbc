import math
import random

import numpy as np
import pytest

from tillroll.llm import topk


def plain(rows, k):
    """Best rows for each query by all inner products."""
    whole = []
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector]))
    out = set()
    for query_id, query in whole:
        if query_id % 100 == 0:
            others = [(v, sum(a * b for a, b in zip(q, query))) for v, q in whole if v != query_id and len(q) == len(query)]
            others.sort(key=lambda r: (-r[1], r[0]))
            out |= {(query_id, rank, v, s) for rank, (v, s) in enumerate(others[:k], 1)}
    return out


def answer(spark, rows, k=10, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.quantise(df.withColumnsRenamed({}))
    found = topk.search(vectors.where("vec_id % 100 = 0"), vectors, k, **sizes)
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()}


@pytest.mark.parametrize("sizes", [{}, {"rows_per_block": 70, "queries_per_task": 2}])
def test_equals_all_inner_products(spark, sizes):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-0.6, 0.6) for _ in range(12)]) for i in range(430)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(2000 + i, [0.0] * 12) for i in range(5)] + [(3000, [0.0] * 12)]
    rows += [(4000, None), (4001, [None] * 12), (4002, [math.nan] * 12), (4003, [math.inf] * 12), (None, [0.1] * 12)]
    rows += [(4100, [0.5, 0.25]), (4101, [0.5, 0.5]), (4200, []), (4201, []), (4301, [3e4] * 12), (4302, [-3e4] * 12)]
    assert answer(spark, rows, **sizes) == plain(rows, 10)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, -1.0]), (1, [-1.0, 1.0]), (2, [0.5, 0.0])]
    assert answer(spark, rows) == {(0, 1, 2, 512 * 1024), (0, 2, 1, -2 * 1024 * 1024)}
    assert answer(spark, [(0, [1.0])]) == set()
    assert answer(spark, []) == set()


def test_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (3, [0.5]), (3, [0.5]), (4, [0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.quantise(df)
    found = topk.search(vectors.where("vec_id % 100 = 0"), vectors, 10).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 3, 524288), (2, 3, 524288), (3, 4, 262144)]


def test_one_block():
    rnd = np.random.default_rng(1)
    for n, dims, most in ((1, 1, 1), (63, 3, 5), (64, 3, 9), (200, 8, 2000), (130, 4, 0)):
        values = rnd.integers(-most, most + 1, (n, dims))
        _, slices = topk.slices_of(values)
        for _ in range(5):
            query = rnd.integers(-most, most + 1, dims)
            scores = values @ query
            order = sorted(range(n), key=lambda i: (-scores[i], i))[:7]
            got = topk.best_rows(np.arange(n), slices, -1, query, 7)
            assert sorted(got) == sorted((i, int(scores[i])) for i in order)


def test_large_components_keep_all_bits(spark):
    rows = [(0, [2.0**-10, 0.0]), (1, [2.0**31, 1.0]), (2, [2.0**30, 2.0]), (3, [-(2.0**52), 3.0]), (4, [2.0**52, 0.0])]
    assert answer(spark, rows) == plain(rows, 10)
    assert {(v, s) for _, _, v, s in answer(spark, rows)} == {(1, 2**41), (2, 2**40), (3, -(2**62)), (4, 2**62)}


def test_what_does_not_fit_a_long_fails(spark):
    with pytest.raises(Exception, match="too large"):
        answer(spark, [(0, [1e30]), (1, [1.0])])
    with pytest.raises(Exception, match="does not fit a long"):
        answer(spark, [(0, [2.0**40]), (1, [2.0**40]), (2, [1.0])])


def test_clashing_extra_columns(spark):
    from tests.llm.conftest import clashing

    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(201)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    vectors = topk.quantise(df)
    found = topk.search(vectors.where("vec_id % 100 = 0"), vectors, 10)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()} == plain(rows, 10)
