from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import clashing
from tillroll.llm import whitening
from tillroll.llm.whitening import components, refine, whiten


@pytest.fixture
def table(spark):
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        rows = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v in rows]
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    return make


def exact(vectors):
    """Whole x-vectors, sums, covariance as fractions, and exact deviations."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    d = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in d), n**3) for j in range(len(sums))] for i in range(len(sums))]
    return x, sums, cov, [sum(a * a for a in r) for r in d]


def checked(rows, vectors, count=8):
    """Holds the rows of ``whiten`` against the definition; eigenvectors only by what makes them such."""
    x, sums, cov, deviations = exact(vectors)
    n, dim = len(x), len(sums)
    values = np.linalg.eigvalsh(np.array([[float(v) for v in r] for r in cov]))[::-1]
    by = {}
    for r in rows:
        by.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(by) == list(range(1, min(count, dim) + 1))
    white = np.array([[by[c + 1][i][0].whitened for c in range(len(by))] for i in range(n)])
    assert np.abs(white.T @ white / n - np.eye(len(by))).max() < 1e-9
    centred = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(v, sums, strict=True)] for v in x])
    for c in range(len(by)):
        assert {r.deviation for i in range(n) for r in by[c + 1][i]} == set(deviations)
        assert by[c + 1][0][0].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
        # whitened * sqrt(e) projects on a unit vector of which the covariance makes e times itself
        axis, *_ = np.linalg.lstsq(centred, white[:, c] * np.sqrt(values[c]), rcond=None)
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-9)
        v = np.array([[float(t) for t in r] for r in cov])
        assert np.abs(v @ axis - values[c] * axis).max() < 1e-8 * values[0]
    assert {r.identity_error for r in rows} and max(r.identity_error for r in rows) < 1e-9
    assert {r.n for r in rows} == {n}


def test_meets_its_definition(table):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    checked(whiten(table(vectors.tolist())).collect(), vectors)


def test_fewer_entries_than_components(table):
    vectors = np.random.default_rng(2).normal(size=(40, 3))
    checked(whiten(table(vectors.tolist())).collect(), vectors)


def test_unsound_vectors_take_no_part_and_rows_stay_rows(table):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(30, 4)).tolist()
    bad = [None, [1, None, 2, 3], [1, float("nan"), 2, 3], [float("inf"), 1, 2, 3], []]
    rows = whiten(clashing(table([*good, *bad, *good]))).collect()
    assert len(rows) == 60 * 4 and {r.n for r in rows} == {60}
    first = {(r.vec_id, r.component): r.whitened for r in rows}
    assert all(first[i, c] == first[i + 35, c] for i in range(30) for c in range(1, 5))


def test_components_without_variance(table):
    rows = whiten(table([[1, 2, 3]] * 5)).collect()
    assert {(r.component, r.whitened, r.explained, r.deviation, r.identity_error) for r in rows} == {(c, None, 0.0, 0, 0.0) for c in (1, 2, 3)}
    line = whiten(table([[i, 2 * i, 0] for i in range(9)])).collect()
    assert {r.whitened is None for r in line if r.component > 1} == {True}
    assert sum(r.whitened**2 for r in line if r.component == 1) / 9 == pytest.approx(1)


def test_lengths_are_lists_of_their_own_and_null_ids_stay(table):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(20, 2)), rng.normal(size=(30, 3))
    rows = whiten(table([*((i, v) for i, v in enumerate(a.tolist())), *((100 + i, v) for i, v in enumerate(b.tolist()))]))
    found = rows.collect()
    checked([r for r in found if r.vec_id < 100], a)
    assert {r.n for r in found if r.vec_id >= 100} == {30}
    assert whiten(table([(None, v) for v in a.tolist()])).count() == 40


def test_large_entries_are_exact_and_too_large_ones_fail(table):
    vectors = [[2.0**40, 1], [-(2.0**41), 2], [3, 2.0**39]]
    assert {r.deviation for r in whiten(table(vectors)).collect()} == set(exact(vectors)[3])
    with pytest.raises(Exception, match="too large"):
        whiten(table([[1e30, 1], [2, 3]]))


def test_no_vectors_no_rows(table):
    assert whiten(table([])).collect() == []
    assert whiten(table([None])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def spectrum(values, seed):
    """A symmetric matrix with these eigenvalues and its eigenvectors, in long doubles."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    q = q.astype(np.longdouble)
    for _ in range(3):  # Newton's step to the orthogonal matrix next to it
        q = q @ (3 * np.eye(len(values)) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values",
    [
        list(range(30, 0, -1)),
        [5, 5, 5, 3, 3, 1],
        [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 + 1e-12, 1e-7, 2e-7],
        [1, 1 + 3e-8, 1 + 6e-8, 1 + 9e-8, 1e-3],
        [1.0] * 10,
        [1e6, 1, 1e-6],
    ],
)
def test_refinement_reaches_double_precision(values):
    a, q = spectrum(values, len(values))
    _, rough = np.linalg.eigh(a.astype(np.float32))
    found, x = refine(a, rough)
    assert np.abs(found - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-17 * max(values) * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17 * len(values)
    assert np.abs(a @ x - x * found).max() < 1e-17 * max(values) * len(values)


def test_refined_axes_equal_the_true_ones():
    a, q = spectrum([9, 4, 4 - 1e-7, 1], 7)
    _, rough = np.linalg.eigh(a.astype(np.float32))
    _, x = refine(a, rough)
    assert np.abs(np.abs((x * q).sum(axis=0)) - 1).max() < 1e-15
    values, axes, trace = components([[Fraction(float(v)) for v in row] for row in a], 2)
    assert values[0] == pytest.approx(9) and trace == pytest.approx(18) and axes.shape == (4, 2)
    assert whitening._long_double(Fraction(1, 3)) != np.longdouble(1 / 3)
