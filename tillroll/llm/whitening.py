"""Whitening of embeddings: rows projected on the principal components of their covariance, each with variance one.

Sums and products over the rows are exact whole numbers that Spark adds up. The eigenvectors of the covariance are found in
float32 and corrected by Ogita and Aishima's refinement, matrix products in higher precision only; components whose
eigenvalues are too close to be told apart are turned by an eigenproblem of their own within the space they span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

_SHIFT = 100_000
#: Whole numbers below this are exact in a double; products of a chunk of rows are summed below it.
_EXACT = 1 << 53
_CHUNK = 4096
#: Doubles of this size or more are multiples of 2048 and have no exact long after scaling.
_LARGEST = float(1 << 62)


@dataclass
class Fit:
    """What whitens vectors of one length: rows are projected on ``axes`` (a column for a component) less their mean."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float


def vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows whose vector is neither null nor holds null, infinite or NaN entries."""
    sound = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return kept.where(F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)) & (F.size("embedding") > 0))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * c) + 100000`` as longs; an entry too large for that fails."""
    scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) >= _LARGEST:
        raise OverflowError("An entry of a vector is too large to be scaled to a long")
    return scaled.astype(np.int64) + _SHIFT


def _by_length(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Row ids and matrix of whole numbers, for chunks of rows of one length."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            for start in range(0, len(own), _CHUNK):
                rows = batch.take(pa.array(own[start : start + _CHUNK]))
                flat = rows.column("embedding").flatten().to_numpy(zero_copy_only=False)
                yield rows.column("vec_id"), whole(flat.reshape(rows.num_rows, int(length)), scale)


def _products(d: np.ndarray) -> np.ndarray:
    """``d.T @ d`` exactly: in doubles where every sum is small enough, else in Python's whole numbers."""
    most = int(np.abs(d).max(initial=0))
    if most * most * len(d) < _EXACT:
        d = d.astype(np.float64)
        return (d.T @ d).astype(np.int64)
    d = d.astype(object)
    return d.T @ d


_WHOLE = "dim int, i int, j int, value decimal(38,0), n long"


def _whole_rows(dim: int, i: np.ndarray, j: np.ndarray, values: np.ndarray, n: int) -> pa.RecordBatch:
    size = len(values)
    columns = [
        pa.array(np.full(size, dim, np.int32)),
        pa.array(i.astype(np.int32)),
        pa.array(j.astype(np.int32)),
        pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
        pa.array(np.full(size, n, np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["dim", "i", "j", "value", "n"])


def _sum_entries(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for _, x in _by_length(batches, scale):
            total = totals.setdefault(x.shape[1], [np.zeros(x.shape[1], object), 0])
            total[0] += x.astype(object).sum(axis=0) if np.abs(x).max() * len(x) >= _EXACT else x.sum(axis=0).astype(object)
            total[1] += len(x)
        for dim, (total, n) in totals.items():
            yield _whole_rows(dim, np.arange(dim), np.zeros(dim), total, n)

    return run


def _sum_products(scale: int, centres: dict[int, np.ndarray]):
    """Products of the entries less ``centres``, whole numbers next to the means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for _, x in _by_length(batches, scale):
            dim = x.shape[1]
            totals[dim] = totals.get(dim, 0) + _products(x - centres[dim]).astype(object)
            counts[dim] = counts.get(dim, 0) + len(x)
        for dim, total in totals.items():
            i, j = np.triu_indices(dim)
            yield _whole_rows(dim, i, j, total[i, j], counts[dim])

    return run


def _summed(partial: DataFrame) -> dict[int, list]:
    """Entries by length: a table of the square of a vector's length, whatever the number of rows."""
    total = partial.groupBy("dim", "i", "j").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    found: dict[int, list] = {}
    for r in total.collect():
        found.setdefault(r["dim"], []).append((r["i"], r["j"], int(r["value"]), r["n"]))
    return found


def _long_double(value: Fraction) -> np.longdouble:
    """A fraction in the widest float there is: a double, and what it leaves over."""
    near = float(value)
    return np.longdouble(near) + np.longdouble(float(value - Fraction(near)))


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximate ones ``x``, by falling eigenvalue.

    A round of Ogita and Aishima: with ``r = 1 - x'x``, ``s = x'ax`` and ``v = s_ii / (1 - r_ii)`` the correction of ``x``
    is ``x @ e`` with ``e_ij = (s_ij + v_j r_ij) / (v_j - v_i)``, or ``r_ij / 2`` where the two values are too close to be
    told apart. Such clusters get a sub-solve: the eigenproblem of ``a`` within their space, less their mean. Every product
    is taken in the precision of ``a``; the error squares with each round.
    """
    eps, size = np.finfo(a.dtype).eps, len(a)
    one = np.eye(size, dtype=a.dtype)
    norm = np.abs(a).sum(axis=1).max()
    x, last = x.astype(a.dtype), np.inf
    for _ in range(rounds):
        r, s = one - x.T @ x, x.T @ (a @ x)
        # Rounding leaves s_ij unlike s_ji, which a small gap would blow up into axes that are not orthogonal.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = s - np.diag(values)
        close = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > close
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        starts = np.flatnonzero(np.append(True, values[:-1] - values[1:] > close))
        turned = False
        for start, stop in zip(starts, [*starts[1:], size], strict=True):
            if stop - start > 1:
                own, unit = x[:, start:stop], np.eye(stop - start, dtype=a.dtype)
                within = own.T @ (a @ own)
                within = within - np.trace(within) / (stop - start) * unit
                most = np.abs(within).max()
                if most > 8 * size * eps * norm:  # less is rounding: the eigenvalues are equal, any basis will do
                    turn = np.linalg.eigh((within / most).astype(np.float64))[1][:, ::-1].astype(a.dtype)
                    x[:, start:stop] = own @ (turn @ (3 * unit - turn.T @ turn) / 2)
                    turned = True
        change = np.abs(e).max(initial=0)
        if not turned and (change <= size * eps or change >= last / 2 and change < 1e-15):
            break
        last = change
    values = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def components(products: list[list[Fraction]], count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Variances and axes of the ``count`` first components of a covariance, and its trace.

    An axis has its largest entry positive. A variance that rounding cannot tell from none is 0.
    """
    a = np.array([[_long_double(v) for v in row] for row in products], np.longdouble)
    size, trace = len(a), np.trace(a)
    scale = np.abs(a).max()
    if scale == 0:
        return np.zeros(min(count, size)), np.eye(size)[:, :count], 0.0
    a = a / scale
    _, rough = np.linalg.eigh(a.astype(np.float32))
    values, axes = refine(a, rough[:, ::-1])
    values, axes = values[:count], axes[:, :count]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1, 1)
    values = np.where(values > size * np.finfo(np.float64).eps * values[0], values, 0)
    return (values * scale).astype(np.float64), axes.astype(np.float64), float(trace)


def fit(rows: DataFrame, count: int = 8, scale: int = 1024) -> dict[int, Fit]:
    """A :class:`Fit` for each length of the vectors of ``rows``, from all of them.

    Two passes: exact sums, then exact products about the whole numbers next to the means, from which the covariance is a
    fraction without rounding. The driver gets one table of entries by entries, never rows.
    """
    sums = {dim: sorted(found) for dim, found in _summed(rows.mapInArrow(_sum_entries(scale), _WHOLE)).items()}
    totals = {dim: ([value for *_, value, _ in found], found[0][3]) for dim, found in sums.items()}
    centres = {dim: np.array([(2 * s + n) // (2 * n) for s in total], np.int64) for dim, (total, n) in totals.items()}
    products = _summed(rows.mapInArrow(_sum_products(scale, centres), _WHOLE)) if totals else {}
    out = {}
    for dim, (total, n) in totals.items():
        rest = [s - n * int(c) for s, c in zip(total, centres[dim], strict=True)]
        covariance = [[Fraction(0)] * dim for _ in range(dim)]
        for i, j, value, _ in products[dim]:
            covariance[i][j] = covariance[j][i] = Fraction(n * value - rest[i] * rest[j], n * n)
        variances, axes, trace = components(covariance, count)
        out[dim] = Fit(n, total, axes, variances, trace)
    return out


_WHITE = "vec_id long, dim int, n long, deviation decimal(38,0), whitened array<double>"


def project(rows: DataFrame, fits: dict[int, Fit], scale: int = 1024) -> DataFrame:
    """``vec_id, dim, n, deviation, whitened`` of every row: ``deviation`` is the exact sum of ``(n * x - S) ** 2``.

    A row's difference from the mean is ``(n * x - S) / n``, rounded once. A component without variance whitens to null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _by_length(batches, scale):
            f = fits[x.shape[1]]
            most = f.n * int(np.abs(x).max()) + max(map(abs, f.sums))
            if most < _EXACT:
                d = f.n * x - np.array(f.sums, np.int64)
                far = np.abs(d).max(initial=0)
                exact = d if int(far) ** 2 * d.shape[1] < 1 << 63 else d.astype(object)
            else:
                d = f.n * x.astype(object) - np.array(f.sums, object)
                exact = d
            deviation = (exact * exact).sum(axis=1)
            from_mean = (d / f.n).astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                white = from_mean @ f.axes / np.sqrt(f.variances)
            count = white.shape[1]
            flat = pa.array(white.ravel(), mask=np.tile(f.variances == 0, len(white)))
            offsets = pa.array(np.arange(0, len(white) * count + 1, count, dtype=np.int32))
            columns = [
                ids,
                pa.array(np.full(len(white), x.shape[1], np.int32)),
                pa.array(np.full(len(white), f.n, np.int64)),
                pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, flat),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _WHITE.split(", ")])

    return rows.mapInArrow(run, _WHITE)


def identity_errors(white: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By length: the largest absolute entry of the covariance of ``whitened``, centred, less the identity.

    Components without variance are left out; where none has any, the error is 0.
    """
    out = {}
    for dim, f in fits.items():
        own, used = white.where(F.col("dim") == dim), np.flatnonzero(f.variances > 0).tolist()
        if not used:
            out[dim] = 0.0
            continue
        entry = [F.col("whitened")[i] for i in used]
        means = own.agg(*(F.avg(e) for e in entry)).first()
        pairs = [(i, j) for i in range(len(used)) for j in range(i, len(used))]
        products = [F.avg((entry[i] - F.lit(means[i])) * (entry[j] - F.lit(means[j]))) for i, j in pairs]
        found = own.agg(*products).first()
        out[dim] = max(abs(v - (i == j)) for (i, j), v in zip(pairs, found, strict=True))
    return out


def whiten(rows: DataFrame, count: int = 8, scale: int = 1024) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector and component up to ``count``.

    Entries ``c`` become ``x = floor(scale * c) + 100000``; ``n`` vectors with sums ``S`` are the fit list. ``deviation`` is
    the sum of ``(n * x - S) ** 2`` as a decimal, ``whitened`` is ``x - S / n`` on the component over the root of its
    variance, ``explained`` its share of the trace, ``identity_error`` how far the covariance of ``whitened`` is from the
    identity. Vectors that are null, empty, or hold null or non-finite entries take no part; an entry beyond ``2 ** 62``
    after scaling fails the job. Vectors of another length are a list of their own. Components without variance have a
    null ``whitened`` and explain 0. Null ids and repeated rows are rows like any other; other columns are ignored; no
    vectors give no rows.
    """
    kept = vectors(rows)
    fits = fit(kept, count, scale)
    white = stored(project(kept, fits, scale), "whitened")
    errors = identity_errors(white, fits)
    explained = F.lit(None).cast("double")
    error = F.lit(None).cast("double")
    for dim, f in fits.items():
        shares = [float(v / f.trace) if f.trace else 0.0 for v in f.variances]
        here = F.col("dim") == dim
        explained = F.when(here, F.array(*map(F.lit, shares))[F.col("place")]).otherwise(explained)
        error = F.when(here, F.lit(errors[dim])).otherwise(error)
    listed = white.select("vec_id", "dim", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return listed.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        explained.alias("explained"),
        error.alias("identity_error"),
    )
