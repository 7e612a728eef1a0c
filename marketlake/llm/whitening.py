"""Whitening of embeddings: principal components scaled to unit variance, over distinct vectors.

1. Each entry c becomes the integer floor(64 * c) + 1000000 (``quantise``); rows
   whose vector is null, empty or holds null or non-finite entries drop out. The
   distinct integer vectors are the fit list, written once.
2. Sums a dimension are exact integers. The covariance is distributed: each
   partition centres its vectors by the means, multiplies, and gives one d x d
   matrix; matrices are added in two levels. Only the last one, of d * d numbers
   whatever the rows, reaches the driver.
3. There it is brought to tridiagonal form by Householder reflections. The
   leading eigenvalues come from bisection on Sturm counts, the eigenvectors from
   inverse iteration; those of eigenvalues that lie close together are made
   orthogonal to each other in every round. Reflections are undone.
4. The components (at most 16 vectors) go to every task with the closure, and all
   rows are projected in one narrow pass.

Components whose eigenvalue is no more than ``TOLERANCE`` of the largest carry no
variance and are left out, so a table of one distinct vector has none. Vectors
that are not of the commonest length (of equal ones the greatest) drop out.
Repeated rows count once in the fit and are projected each. Entries beyond 2^46
are held at that. ``deviation`` is exact; beyond 64 bits it is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import col, materialise, scale_partitions, small_batches

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
TOLERANCE = 1e-12
_HELD = float(1 << 52)


def quantise(values: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    return np.clip(np.floor(scale * values.astype(np.float64)), -_HELD, _HELD).astype(np.int64) + shift


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: diagonal, off-diagonal and the unit reflection vectors (of falling length) of a symmetric matrix."""
    a = a.copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        v = np.zeros_like(x)
        if norm > 0:
            v[:] = x
            v[0] += norm if x[0] >= 0 else -norm
            v /= np.linalg.norm(v)
            rest = a[k + 1 :, k + 1 :]
            w = rest @ v
            w = 2 * (w - (v @ w) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1 :, k] = a[k, k + 1 :] = x - 2 * (v @ x) * v
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_count(d: list[float], e2: list[float], x: float) -> int:
    """How many eigenvalues of the tridiagonal matrix are smaller than ``x``; ``e2``: a zero, then its off-diagonal squared."""
    least = 1e-290
    count, q = 0, 1.0
    for a, b in zip(d, e2):
        q = a - x - b / q
        if -least < q < least:
            q = -least
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    n = len(d)
    radius = np.abs(np.concatenate([[0.0], e])) + np.abs(np.concatenate([e, [0.0]]))
    low, high = float((d - radius).min()), float((d + radius).max())
    room = 2 * np.finfo(float).eps * max(abs(low), abs(high)) + np.finfo(float).tiny
    diag, squares = d.tolist(), [0.0, *(e * e).tolist()]
    out = []
    for j in range(k):  # the j-th largest has at most n - 1 - j smaller ones
        a, b = low - room, high + room
        while True:
            mid = a + (b - a) / 2
            if mid <= a or mid >= b:
                break
            if sturm_count(diag, squares, mid) <= n - 1 - j:
                a = mid
            else:
                b = mid
        out.append(b)
        high = b
    return np.array(out)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, y: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = y by elimination with row exchanges; vanishing pivots become ``least``."""
    n = len(d)
    diag, up, up2, y = d - shift, np.append(e, 0.0), np.zeros(n), y.copy()
    low = e.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(diag[i]):
            diag[i], low[i] = low[i], diag[i]
            up[i], diag[i + 1] = diag[i + 1], up[i]
            if i + 1 < n - 1:
                up2[i], up[i + 1] = up[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        if abs(diag[i]) < least:
            diag[i] = least
        f = low[i] / diag[i]
        diag[i + 1] -= f * up[i]
        if i + 1 < n - 1:
            up[i + 1] -= f * up2[i]
        y[i + 1] -= f * y[i]
    if abs(diag[-1]) < least:
        diag[-1] = least
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        x[i] = (y[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)) / diag[i]
    return x


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix for falling ``values``, by inverse iteration."""
    n = len(d)
    norm = max(np.abs(d).max(initial=0.0) + 2 * np.abs(e).max(initial=0.0), np.finfo(float).tiny)
    least = np.finfo(float).eps * norm
    rng = np.random.default_rng(13)
    out: list[np.ndarray] = []
    first = 0  # of the cluster that the value belongs to
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        # equal values are moved apart by a little, else all rounds would find one vector
        shift = min(value, shift - 4 * least)
        x = rng.standard_normal(n)
        for _ in range(5):
            x /= np.abs(x).max()
            x = _solve(d, e, shift, x, least)
            x /= np.linalg.norm(x)
            for _ in range(2):
                for other in out[first:]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out).reshape(len(values), n)


def leading_eigenpairs(a: np.ndarray, k: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` largest eigenvalues of a covariance matrix, falling, and unit eigenvectors (rows)."""
    n = len(a)
    if n == 0:
        return np.empty(0), np.empty((0, 0))
    d, e, reflections = tridiagonal(a)
    values = leading_eigenvalues(d, e, min(k, n))
    values = values[(values > 0) & (values > tolerance * max(values.max(initial=0.0), 0.0))]
    vectors = eigenvectors(d, e, values)
    for j in range(len(reflections) - 1, -1, -1):  # back from the tridiagonal basis
        v = reflections[j]
        part = vectors[:, j + 1 :]
        part -= 2 * np.outer(part @ v, v)
    return values, vectors


def _packed(scale: int, shift: int):
    """Batches (row, vec) -> row, entries, packed integer vector; rows without a vector to use drop out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column(1).cast(pa.list_(pa.float64()))
            sizes = np.diff(np.asarray(vec.offsets))
            flat = vec.flatten()  # entries of null rows are not among them
            sizes = np.where(np.asarray(vec.is_valid()), sizes, 0)
            values = flat.to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])  # a null entry is NaN here
            ok = (sizes > 0) & (bad[ends[1:]] == bad[ends[:-1]])
            x = quantise(np.where(np.isfinite(values), values, 0.0), scale, shift)
            packed = [x[s:e].tobytes() for s, e, good in zip(ends[:-1], ends[1:], ok) if good]
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(keep), pa.array(sizes[ok], pa.int32()), pa.array(packed, pa.binary())], names=["row", "d", "x"])

    return run


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, d)


def _folded(df: DataFrame, part: Callable, add: Callable, tasks: int) -> bytes | None:
    """One packed value of all rows: ``part`` of each partition's batches, added up in two levels."""

    def level(f: Callable):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value = f(b.column(0) for b in batches)
            if value is not None:
                yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], names=["v"])

        return run

    def summed(columns: Iterator[pa.Array]):
        total = None
        for c in columns:
            for v in c.to_pylist():
                total = v if total is None else add(total, v)
        return total

    parts = df.mapInArrow(level(part), "v binary")
    for n in (max(1, int(tasks**0.5)), 1):
        parts = parts.repartition(n).mapInArrow(level(summed), "v binary")
    row = parts.first()
    return None if row is None else bytes(row[0])


def _add_floats(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def covariance(fit: DataFrame, mean: np.ndarray, tasks: int) -> np.ndarray:
    """Sum over the packed vectors (column ``x``) of the outer products of their centred values."""
    d = len(mean)

    def part(columns: Iterator[pa.Array]):
        total = np.zeros((d, d))
        for c in columns:
            y = _matrix(c, d) - mean
            total += y.T @ y
        return total.tobytes()

    got = _folded(fit.select("x"), part, _add_floats, tasks)
    return np.zeros((d, d)) if got is None else np.frombuffer(got).reshape(d, d)


def _scatter(fit: DataFrame, centre: np.ndarray, weights: np.ndarray, tasks: int) -> tuple[int, np.ndarray]:
    """Count and covariance of the projected vectors, centred by each part's own mean and merged pairwise."""
    d, k = len(centre), weights.shape[1]

    def merged(a: bytes, b: bytes) -> bytes:
        p, q = np.frombuffer(a), np.frombuffer(b)
        if p[0] == 0 or q[0] == 0:
            return b if p[0] == 0 else a
        n, step = p[0] + q[0], q[1 : k + 1] - p[1 : k + 1]
        mean = p[1 : k + 1] + step * (q[0] / n)
        m2 = p[k + 1 :] + q[k + 1 :] + np.outer(step, step).ravel() * (p[0] * q[0] / n)
        return np.concatenate([[n], mean, m2]).tobytes()

    def part(columns: Iterator[pa.Array]):
        total = np.zeros(1 + k + k * k).tobytes()
        for c in columns:
            w = (_matrix(c, d) - centre) @ weights
            if len(w):
                mean = w.mean(axis=0)
                y = w - mean
                total = merged(total, np.concatenate([[len(w)], mean, (y.T @ y).ravel()]).tobytes())
        return total

    got = np.frombuffer(_folded(fit.select("x"), part, merged, tasks))
    return int(got[0]), got[k + 1 :].reshape(k, k) / max(got[0], 1)


def _sums(fit: DataFrame, d: int, tasks: int) -> list[int]:
    """Exact sums a dimension (Python integers in 128-bit cells)."""

    def pack(v: list[int]) -> bytes:
        return b"".join(x.to_bytes(16, "little", signed=True) for x in v)

    def unpack(b: bytes) -> list[int]:
        return [int.from_bytes(b[i : i + 16], "little", signed=True) for i in range(0, len(b), 16)]

    def part(columns: Iterator[pa.Array]):
        total = [0] * d
        for c in columns:
            m = _matrix(c, d)  # at most 2^53 each: halves of the bits add up without overflow
            high, low = (m >> 32).sum(axis=0), (m & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(x) for t, h, x in zip(total, high, low)]
        return pack(total)

    return unpack(_folded(fit.select("x"), part, lambda a, b: pack([p + q for p, q in zip(unpack(a), unpack(b))]), tasks))


def _projector(n: int, sums: list[int], weights: np.ndarray, explained: list[float], error: float):
    d = len(sums)
    centre = _centre(sums, n)
    reach = max(abs(s) for s in sums)

    def deviations(x: np.ndarray) -> list[int | None]:
        far = n * int(np.abs(x).max(initial=0)) + reach
        if far < 1 << 62:
            y = n * x - np.array(sums, np.int64)
            if int(np.abs(y).max(initial=0)) ** 2 * d < 1 << 63:
                return (y * y).sum(axis=1).tolist()
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = weights.shape[1]
        for b in batches:
            x = _matrix(b.column(1), d)
            white = (x - centre) @ weights
            row = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            dev = pa.array(deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            m = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array([n] * m, pa.int64()), dev,
                 pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array([error] * m, pa.float64())],
                names=["row", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def _centre(sums: list[int], n: int) -> np.ndarray:
    return np.array([s / n for s in sums])


OUT = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
       T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]


def whiten(vectors: DataFrame, keep: list[str], vec_col: str = "embedding", k: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Struct ``row`` of the kept columns and, for each component: n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    small_batches(spark)
    src = vectors.select(F.struct(*[col(c) for c in keep]).alias("row"), col(vec_col).cast("array<double>").alias("vec"))
    schema = T.StructType([src.schema["row"], T.StructField("d", T.IntegerType()), T.StructField("x", T.BinaryType())])
    out = T.StructType([src.schema["row"], *OUT])
    rows = materialise(src.mapInArrow(_packed(scale, shift), schema), "whiten-rows")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], out)
    d = common.d
    rows = rows.where(F.col("d") == d)
    fit = materialise(rows.select("x").distinct(), "whiten-fit")
    n = fit.count()
    tasks = scale_partitions(n, 1 << 16)
    sums = _sums(fit, d, tasks)
    variance = covariance(fit, _centre(sums, n), tasks) / n
    values, components = leading_eigenpairs(variance, k)
    if not len(values):
        return spark.createDataFrame([], out)
    weights = components.T / np.sqrt(values)
    _, unit = _scatter(fit, _centre(sums, n), weights, tasks)
    error = float(np.abs(unit - np.eye(len(values))).max())
    explained = (values / np.trace(variance)).tolist()
    return rows.select("row", "x").mapInArrow(_projector(n, sums, weights, explained, error), out)


def digest(whitened: DataFrame) -> DataFrame:
    return whitened.select(F.col("row.vec_id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")
