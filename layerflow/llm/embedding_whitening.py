"""Whitening of embeddings by their leading principal components.

Every entry c counts as the integer x = floor(64 c) + 1000000, and every distinct x-vector counts once: these n vectors
are the fit list. Two passes over it give, exactly, their sums S and, from the centred entries (n x - S) / n, the
covariance V (divisor n). Partial sums are formed in the tasks, cell by cell of V, and added up by Spark. The
symmetric V (dimension squared numbers, whatever the number of vectors) is solved on the driver: Householder
reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse iteration their
vectors, made orthogonal again inside clusters of close eigenvalues, and the reflections turn them back. The
components go to all tasks, which project every row. A third pass over the fit list measures the covariance of its
whitened vectors.

Results for special input: rows with a null vector, or one that holds null, NaN or infinity, are dropped, and so are
those with an entry whose x is no long (64 c of 2^62 or more). An empty vector has no component and gives no row. Vectors
of different lengths are whitened apart, each length with its own n, S and V. Components with no variance (an
eigenvalue of at most ``dimension * 2^-50`` of the largest) are left out, so a length with one distinct vector gives no
rows. ``deviation`` is null where the exact sum is beyond a long. Repeated rows and null ids give repeated rows; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

SCALE = 64.0
OFFSET = 1_000_000
#: x-vectors are kept as bytes: the integers floor(64 c), in the narrowest of these types that holds the vector.
WIDTHS = ("<i1", "<i2", "<i4", "<i8")
_MOST = float(1 << 62)
#: Rows of centred entries multiplied at a time.
_BLOCK = 4096


# ---------------------------------------------------------------- vectors as bytes

def _coded(column: pa.Array) -> list[tuple[int, bytes] | None]:
    """(length, bytes) of each vector of a list<double> array; None for those that are dropped."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    entries = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if values.null_count:
        entries[values.is_null().to_numpy(zero_copy_only=False)] = np.nan
    lengths = np.diff(offsets)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    out: list[tuple[int, bytes] | None] = [None] * len(lengths)
    for d in np.unique(lengths[valid & (lengths > 0)]):
        rows = np.flatnonzero(valid & (lengths == d))
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(entries[offsets[rows, None] + np.arange(d)] * SCALE)
            rows, scaled = (x[np.isfinite(scaled).all(1) & (np.abs(scaled) < _MOST).all(1)] for x in (rows, scaled))
        if not len(rows):
            continue
        low, high = scaled.min(1), scaled.max(1)
        for k, code in enumerate(WIDTHS):
            info = np.iinfo(code)
            fits = (low >= info.min) & (high <= info.max)
            if k:
                small = np.iinfo(WIDTHS[k - 1])
                fits &= (low < small.min) | (high > small.max)
            at = np.flatnonzero(fits)
            body, size = scaled[at].astype(code).tobytes(), int(d) * np.dtype(code).itemsize
            for j, i in enumerate(rows[at]):
                out[i] = (int(d), body[j * size:(j + 1) * size])
    return out


def _vectors(dims: np.ndarray, codes: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their x-vectors) for every length among coded vectors."""
    sizes = np.array([len(c or b"") for c in codes], np.int64)
    for d in np.unique(dims):
        rows, parts = [], []
        for code in WIDTHS:
            at = np.flatnonzero((dims == d) & (sizes == d * np.dtype(code).itemsize))
            if len(at):
                rows.append(at)
                parts.append(np.frombuffer(b"".join(codes[i] for i in at), code).reshape(len(at), d).astype(np.int64))
        if rows:
            yield int(d), np.concatenate(rows), np.concatenate(parts) + OFFSET


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, code) of the rows that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = _coded(batch.column("v"))
            kept = [i for i, c in enumerate(coded) if c is not None]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(kept, pa.int32())),
                pa.array([coded[i][0] for i in kept], pa.int32()), pa.array([coded[i][1] for i in kept], pa.binary())],
                names=["vec_id", "dim", "code"])

    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return map_batches(rows, run, "vec_id long, dim int, code binary")


# ---------------------------------------------------------------- sums over the fit list

@dataclass
class Sums:
    """Exact numbers of one length's fit list."""

    n: int
    s: list[int]
    low: list[int]
    high: list[int]

    def fits_long(self) -> bool:
        """Whether S, n x - S, its square and the sum of these over a vector stay inside a long for all listed vectors."""
        return max(map(abs, self.s)) < 1 << 62 and sum(max(abs(self.n * a - s), abs(self.n * b - s)) ** 2 for a, b, s in zip(self.low, self.high, self.s)) < 1 << 62

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact n x - S."""
        if self.fits_long():
            return (self.n * x - np.array(self.s, np.int64)).astype(np.float64) / self.n
        exact = self.n * x.astype(object) - np.array(self.s, object)
        return np.array([[v / self.n for v in row] for row in exact], np.float64).reshape(x.shape)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        if self.fits_long():
            return ((self.n * x - np.array(self.s, np.int64)) ** 2).sum(1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.s, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def _batch_vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    return _vectors(batch.column("dim").to_numpy(), batch.column("code").to_pylist())


def fit_sums(fit: DataFrame) -> dict[int, Sums]:
    """n, S and the ranges of x by length. Each task sends one row for each length and entry, added up by Spark;
    as many rows as entries of one vector of each length reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for d, _, x in _batch_vectors(batch):
                n, s, low, high = own.get(d, (0, np.zeros(d, object), x[0], x[0]))
                own[d] = (n + len(x), s + x.astype(object).sum(0) if np.abs(x).max() > 1 << 40 else s + x.sum(0).astype(object),
                          np.minimum(low, x.min(0)), np.maximum(high, x.max(0)))
        for d, (n, s, low, high) in own.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                pa.array([str(int(v)) for v in s], pa.string()), pa.array(low), pa.array(high)], names=["dim", "i", "n", "s", "low", "high"])

    partial = map_batches(fit, run, "dim int, i int, n long, s string, low long, high long")
    rows = partial.groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    out: dict[int, Sums] = {}
    for r in rows.orderBy("dim", "i").collect():
        one = out.setdefault(r.dim, Sums(int(r.n), [], [], []))
        one.s.append(int(r.s))
        one.low.append(r.low)
        one.high.append(r.high)
    return out


def _second_moments(fit: DataFrame, columns: dict[int, int], centred) -> dict[int, np.ndarray]:
    """Sums of the products of all pairs of columns, by length. ``centred(d, x)`` gives the columns (``columns[d]`` of
    them). Tasks send the rows of their own sum; Spark adds them up, entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {}
        for batch in batches:
            for d, _, x in _batch_vectors(batch):
                total = own.setdefault(d, np.zeros((columns[d], columns[d])))
                for a in range(0, len(x), _BLOCK):
                    y = centred(d, x[a:a + _BLOCK])
                    total += y.T @ y
        for d, total in own.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array(total[i, j])], names=["dim", "i", "j", "v"])

    partial = map_batches(fit, run, "dim int, i int, j int, v double")
    out: dict[int, np.ndarray] = {}
    for r in partial.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        m = out.setdefault(r.dim, np.zeros((columns[r.dim], columns[r.dim])))
        m[r.i, r.j] = m[r.j, r.i] = r.v
    return out


# ---------------------------------------------------------------- eigenvectors of a symmetric matrix

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: diagonal, off-diagonal, and the unit vectors v of the reflections 1 - 2 v v', first one first;
    the k-th acts on the entries from k + 1 on."""
    a = np.array(a, np.float64)
    n = len(a)
    reflections = []
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1:, k].copy()
        scale = np.abs(x[1:]).max(initial=0.0)
        if scale == 0.0:
            reflections.append(np.zeros(len(x)))
            off[k] = x[0]
            continue
        most = np.abs(x).max()
        x /= most
        alpha = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= alpha
        v = x / np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        reflections.append(v)
        off[k] = alpha * most
    return np.diag(a).copy(), off, reflections


def sturm_counts(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each shift: negative pivots of T - shift."""
    floor = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, float(np.max(e * e, initial=0.0)))
    q = d[0] - shifts
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < floor, -floor, q)
        q = d[i] - shifts - e[i - 1] * e[i - 1] / q
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, by bisection to the last bit that the matrix carries."""
    n = len(d)
    around = np.r_[0.0, np.abs(e)] + np.r_[np.abs(e), 0.0]
    low, high = float((d - around).min()), float((d + around).max())
    wide = max(abs(low), abs(high), np.finfo(float).tiny)
    k = min(most, n)
    a = np.full(k, low - 2 * wide * np.finfo(float).eps * n)
    b = np.full(k, high + 2 * wide * np.finfo(float).eps * n)
    below = n - 1 - np.arange(k)  # eigenvalue number i from the top has so many below it
    for _ in range(1100):
        middle = a + (b - a) / 2
        if ((middle <= a) | (middle >= b) | (b - a <= np.finfo(float).eps * np.maximum(np.abs(middle), wide * 1e-20))).all():
            break
        up = sturm_counts(d, e, middle) > below
        b = np.where(up, middle, b)
        a = np.where(up, a, middle)
    return a + (b - a) / 2


def _solver(d: np.ndarray, e: np.ndarray, shift: float):
    """Solve (T - shift) y = b by elimination with row exchanges."""
    n = len(d)
    tiny = np.finfo(float).eps * max(float(np.abs(d).max()), float(np.abs(e).max(initial=0.0)), np.finfo(float).tiny)
    u0, u1, u2 = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * n
    lower, swapped = e.tolist(), [False] * n
    factor = [0.0] * n
    for i in range(n - 1):
        below = (lower[i], u0[i + 1], u1[i + 1])
        if abs(below[0]) > abs(u0[i]):
            swapped[i] = True
            f = u0[i] / below[0]
            u0[i + 1], u1[i + 1] = u1[i] - f * below[1], u2[i] - f * below[2]
            u0[i], u1[i], u2[i] = below
        else:
            f = below[0] / u0[i] if u0[i] else 0.0
            u0[i + 1], u1[i + 1] = below[1] - f * u1[i], below[2] - f * u2[i]
        factor[i] = f
    u0 = [v if abs(v) > tiny else (tiny if v >= 0 else -tiny) for v in u0]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for i in range(n - 1):
            if swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor[i] * y[i]
        for i in range(n - 1, -1, -1):
            r = y[i]
            if i + 1 < n:
                r -= u1[i] * y[i + 1]
            if i + 2 < n:
                r -= u2[i] * y[i + 2]
            y[i] = r / u0[i]
        return np.array(y)

    return solve


def eigenvectors_of_tridiagonal(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inverse iteration for falling ``values``; rows are unit vectors, orthogonal inside clusters."""
    n = len(d)
    wide = max(float(np.abs(d).max()), float(np.abs(e).max(initial=0.0)), np.finfo(float).tiny)
    start = np.random.default_rng(12)
    vectors = np.zeros((len(values), n))
    cluster = shift = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * wide:
            cluster = i
        # Equal values get shifts of their own, so that the start vectors alone need not tell them apart.
        shift = value if i == cluster else min(value, shift - 10 * np.finfo(float).eps * wide)
        solve = _solver(d, e, shift)
        x = start.standard_normal(n)
        for _ in range(6):
            for _ in range(2):
                x -= vectors[cluster:i].T @ (vectors[cluster:i] @ x)
            y = solve(x / np.linalg.norm(x))
            y /= np.abs(y).max()
            for _ in range(2):
                y -= vectors[cluster:i].T @ (vectors[cluster:i] @ y)
            x = y / np.linalg.norm(y)
        vectors[i] = x
    return vectors


def leading_components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors (rows). Eigenvalues that are zero
    to the precision of the matrix are left out."""
    d, e, reflections = tridiagonal(v)
    values = leading_eigenvalues(d, e, most)
    values = values[values > max(values[0], 0.0) * len(v) * 2.0 ** -50]
    vectors = eigenvectors_of_tridiagonal(d, e, values) if len(values) else np.zeros((0, len(v)))
    for k in range(len(reflections) - 1, -1, -1):
        w = reflections[k]
        vectors[:, k + 1:] -= 2.0 * np.outer(vectors[:, k + 1:] @ w, w)
    return values, vectors


# ---------------------------------------------------------------- the operator

@dataclass
class Whitening:
    """What the tasks need for one length: at most ``most`` rows of the dimension's length."""

    sums: Sums
    matrix: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.sums.centred(x) @ self.matrix.T


def learn(fit: DataFrame, most: int = 16) -> dict[int, Whitening]:
    """The whitening of every length in a stored fit list (distinct dim, code)."""
    sums = fit_sums(fit)
    totals = _second_moments(fit, {d: d for d in sums}, lambda d, x: sums[d].centred(x))
    models: dict[int, Whitening] = {}
    for d, own in sums.items():
        covariance = totals[d] / own.n
        values, vectors = leading_components(covariance, most)
        if len(values):
            trace = float(np.trace(covariance))
            models[d] = Whitening(own, vectors / np.sqrt(values)[:, None], values / trace)
    # Whitened vectors have mean zero, as the centred ones have; their second moments are their covariance.
    used = fit.filter(F.col("dim").isin(list(models))) if models else fit.limit(0)
    white = _second_moments(used, {d: len(m.matrix) for d, m in models.items()}, lambda d, x: models[d].project(x))
    for d, m in models.items():
        m.identity_error = float(np.abs(white[d] / m.sums.n - np.eye(len(m.matrix))).max())
    return models


def whitened(
    embeddings: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: every kept row with up to ``most``
    components of its length."""
    coded = quantised(embeddings, id_col, vector_col)
    fit = written(coded.select("dim", "code").distinct(), "whitening-fit")
    models = learn(fit, most)
    shared = embeddings.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for d, rows, x in _batch_vectors(batch):
                m = known.get(d)
                if m is None:
                    continue
                k = len(m.matrix)
                ids = batch.column("vec_id").take(pa.array(np.repeat(rows, k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, m.sums.n, np.int64)),
                    pa.array([v for v in m.sums.deviations(x) for _ in range(k)], pa.int64()),
                    pa.array(m.project(x).ravel()), pa.array(np.tile(m.explained, len(rows))),
                    pa.array(np.full(len(rows) * k, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(
        coded, run,
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
