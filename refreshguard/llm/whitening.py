"""Whitening of embeddings: centred covariance, its leading eigenvectors, projection.

The entries become integers, so the moments that Spark adds up are exact and equal in every run:
each task multiplies blocks of vectors less a whole-numbered centre (the rounded means), Spark sums
the products per pair of dimensions, and the rest of the centring is made good from the sums.
The matrix, dimensions squared whatever the number of rows, goes to the driver: Householder
reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse
iteration their vectors, orthogonalised again within clusters of close eigenvalues.  The
components, at most ``COMPONENTS`` a dimension, are broadcast to the projection.

Defined cases: a null vector, and one with a null or non-finite entry, or an entry of 2^40 and more
(its integer would not fit the sums), is left out.  A vector shorter than the longest counts as
followed by zeros.  A component whose eigenvalue is zero against the trace (fewer distinct vectors
than components) is left out, as nothing can be divided by it; so one vector, or equal ones, give
no rows.  Repeated rows and ids are rows of their own, a null id stays null.  An empty table gives
an empty result.  ``deviation`` is null where it exceeds a long.  Of the input only ``vec_id`` and
``embedding`` are used, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
UNIT, SHIFT = 1024, 100_000  # x = floor(UNIT * c) + SHIFT
LARGEST = float(1 << 40)  # entries from here on are not taken
BLOCK = 4096  # vectors worked on together
ZERO = 1e-12  # an eigenvalue up to this share of the trace counts as zero
_EPS = np.finfo(float).eps
_EXACT = 1 << 53


# -- moments over the table -----------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    def sound(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)

    return (vectors.select("vec_id", "embedding")
            .filter(F.col("embedding").isNotNull() & F.forall("embedding", sound)))


def _blocks(column: pa.Array, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer vectors) of a column of arrays, in blocks."""
    for first in range(0, len(column), BLOCK):
        part = column.slice(first, BLOCK)
        lengths = np.diff(part.offsets.to_numpy())
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        dense = np.zeros((len(part), dims))
        dense[np.arange(dims) < lengths[:, None]] = flat
        yield first, np.floor(UNIT * dense).astype(np.int64) + SHIFT


def _sums(dims: int):
    """Per task the number of vectors and the sum of each dimension (-1: the number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, dtype=np.int64)
        for batch in batches:
            for _, x in _blocks(batch.column("embedding"), dims):
                n += len(x)
                total += x.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(-1, dims, dtype=np.int32),
                                          "s": np.concatenate([[n], total])})
    return run


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers, exact: in floating point while every sum stays below 2^53."""
    top = int(np.abs(y).max(initial=1)) or 1
    if top * top >= 1 << 62:
        whole = y.astype(object)
        return whole.T @ whole
    step = max(1, _EXACT // (top * top))
    if top * top >= _EXACT:
        return y.astype(object).T @ y.astype(object)
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object if len(y) * top * top >= 1 << 62
                     else np.int64)
    for first in range(0, len(y), step):
        part = y[first:first + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _products(centre: np.ndarray):
    """Per task the sums of products of centred dimensions, the upper triangle."""
    dims = len(centre)
    rows, cols = np.triu_indices(dims)
    decimal = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), dtype=object)
        for batch in batches:
            for _, x in _blocks(batch.column("embedding"), dims):
                total += _exact_products(x - centre)
        values = [int(v) for v in total[rows, cols]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32)),
             pa.array(values, type=decimal)], names=["i", "j", "s"])
    return run


def covariance(vectors: DataFrame) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """(number, sums, centre, covariance with divisor n) of vectors from ``usable``."""
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    if not dims:
        return 0, [], np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    only = vectors.select("embedding")
    found = (only.mapInArrow(_sums(dims), "i int, s long").groupBy("i")
             .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    sums = {r["i"]: int(r["s"]) for r in found}
    n, totals = sums.pop(-1), [sums[i] for i in range(dims)]
    centre = np.array([(2 * s + n) // (2 * n) for s in totals], dtype=np.int64)
    rest = [s - n * int(m) for s, m in zip(totals, centre)]  # sums about the centre
    rows = (only.mapInArrow(_products(centre), "i int, j int, s decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    v = np.zeros((dims, dims))
    for r in rows:
        i, j = r["i"], r["j"]
        # n * sum - sum_i * sum_j is exact, one rounding follows.
        v[i, j] = v[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    return n, totals, centre, v


# -- leading eigenvectors of a symmetric matrix ----------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors of a symmetric matrix."""
    a = np.array(a, dtype=float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.copysign(np.linalg.norm(x), x[0])
        u = x.copy()
        u[0] += size
        length = np.linalg.norm(u)
        u = u / length if length > 0 else np.zeros_like(u)
        reflectors.append(u)
        rest = a[k + 1:, k + 1:]
        p = 2 * (rest @ u)
        w = p - (u @ p) * u
        rest -= np.outer(u, w) + np.outer(w, u)
        a[k + 1, k] = -size
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each point the number of eigenvalues below it: the negative pivots of the shifted matrix."""
    tiny = max(np.abs(diagonal).max(initial=0), np.sqrt(squares.max(initial=0)), 1e-300) * 1e-30
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d - at - e / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues of a tridiagonal matrix, falling, by bisection."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    pad = _EPS * max(abs(low), abs(high), 1e-300) * 4
    lo, hi = np.full(k, low - pad), np.full(k, high + pad)
    wanted = n - 1 - np.arange(k)  # so many eigenvalues lie below the one looked for
    squares = off * off
    while True:
        mid = (lo + hi) / 2
        inside = (mid > lo) & (mid < hi)
        if not inside.any() or (hi - lo).max() <= 2 * _EPS * max(abs(low), abs(high)):
            return mid
        under = below(diagonal, squares, mid) > wanted
        hi, lo = np.where(under, mid, hi), np.where(under, lo, mid)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """x of (T - shift) x = b by elimination with row exchanges; a zero pivot becomes tiny."""
    n = len(diagonal)
    d, u, u2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    b = b.copy()
    tiny = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-300)
    for i in range(n - 1):
        low = off[i]
        if abs(d[i]) >= abs(low):
            if d[i] == 0:
                d[i] = tiny
            f = low / d[i]
            d[i + 1] -= f * u[i]
            b[i + 1] -= f * b[i]
        else:  # rows i and i + 1 change places
            f = d[i] / low
            d[i], held = low, u[i]
            u[i], d[i + 1] = d[i + 1], held - f * d[i + 1]
            u2[i] = u[i + 1]
            u[i + 1] = -f * u2[i]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
    if abs(d[-1]) < tiny:
        d[-1] = tiny
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        s = b[i]
        if i + 1 < n:
            s -= u[i] * x[i + 1]
        if i + 2 < n:
            s -= u2[i] * x[i + 2]
        x[i] = s / d[i]
        if abs(x[i]) > 1e150:
            x, b = x * 1e-150, b * 1e-150
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix, one row for each (falling) eigenvalue.

    Eigenvalues closer than a thousandth of the norm are a cluster; each vector
    is orthogonalised twice a step against those of its cluster before it.
    """
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), 1e-300)
    random = np.random.default_rng(11)
    out = np.zeros((len(values), n))
    first, shift = 0, None
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        # Equal shifts would give equal vectors: those of a cluster keep apart a little.
        shift = value if k == first or shift is None else min(value, shift - 10 * _EPS * norm)
        x = random.standard_normal(n)
        for _ in range(5):
            x = _solve(diagonal, off, shift, x)
            for _ in range(2):
                x -= out[first:k].T @ (out[first:k] @ x)
            x /= np.linalg.norm(x)
        out[k] = x
    return out


def eigenvectors(a: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix, falling, and unit vectors as rows.

    The sign of a vector makes its entry of greatest size positive.
    """
    k = min(k, len(a))
    if not k or not a.any():
        return np.zeros(k), np.eye(k, len(a))
    diagonal, off, reflectors = tridiagonal(a)
    values = leading_values(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for at in range(len(reflectors) - 1, -1, -1):
        u = reflectors[at]
        part = vectors[:, at + 1:]
        part -= 2 * np.outer(part @ u, u)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    signs = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])
    return values, vectors * signs[:, None]


# -- projection ------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What the projection needs: a few numbers a dimension."""

    n: int
    sums: tuple[int, ...]
    centre: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one component a row
    explained: np.ndarray

    @property
    def rest(self) -> np.ndarray:
        """Mean less centre."""
        return np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.centre)])

    def project(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.centre).astype(float) - self.rest
        return centred @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - sum)^2, exact."""
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.centre)], dtype=object)
        y = x - self.centre
        top = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if top * top * max(1, len(rest)) < 1 << 62:
            d = self.n * y - rest.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * y.astype(object) - rest
        return [v if v < 1 << 63 else None for v in map(int, (d * d).sum(axis=1))]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors from ``usable``."""
    n, sums, centre, v = covariance(vectors)
    values, parts = eigenvectors(v, components)
    trace = float(np.trace(v))
    good = values > ZERO * trace
    return Whitening(n, tuple(sums), centre, values[good], parts[good],
                     values[good] / trace if good.any() else np.zeros(0))


def _whitened_moments(model: Whitening):
    k = len(model.values)
    rows, cols = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _blocks(batch.column("embedding"), len(model.centre)):
                w = model.project(x)
                first += w.sum(axis=0)
                second += w.T @ w
        yield pa.RecordBatch.from_pydict({
            "i": np.concatenate([np.full(k, -1), rows]).astype(np.int32),
            "j": np.concatenate([np.arange(k), cols]).astype(np.int32),
            "s": np.concatenate([first, second[rows, cols]])})
    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of (covariance of the whitened vectors - identity), measured on all of them."""
    k = len(model.values)
    if not k:
        return 0.0
    rows = (vectors.select("embedding")
            .mapInArrow(_whitened_moments(model), "i int, j int, s double")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    at = {(r["i"], r["j"]): r["s"] / model.n for r in rows}
    return float(max(abs(at[i, j] - at[-1, i] * at[-1, j] - (i == j))
                     for i in range(k) for j in range(i, k)))


def whiten(vectors: DataFrame, model: Whitening, error: float | None = None) -> DataFrame:
    """A row per usable vector and component: the whitened value and the figures of the fit."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for batch in batches if k else ():
            for first, x in _blocks(batch.column("embedding"), len(m.centre)):
                ids = batch.column("vec_id").slice(first, len(x))
                deviation = pa.array(m.deviations(x), type=pa.int64())
                of = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    ids.take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, m.n)), deviation.take(of),
                    pa.array(m.project(x).ravel()), pa.array(np.tile(m.explained, len(x))),
                    pa.array(np.full(len(x) * k, error), type=pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, "
                                   "whitened double, explained double, identity_error double")


def whitening_report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """All usable vectors whitened by the components fitted to all of them."""
    rows = usable(vectors)
    model = fit(rows, components)
    return whiten(rows, model, identity_error(rows, model))
