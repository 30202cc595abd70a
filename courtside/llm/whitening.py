"""Whitening of embeddings by incremental eigendecomposition.

Vectors become whole numbers, ``x = floor(64 c) + 1000000``; the fit list is each distinct x once.
Every partition of the fit list keeps the spectrum of its scatter matrix and adds a vector as a
centred rank-one update: the new eigenvalues are the roots of the secular equation

    1 + rho * sum(z_j^2 / (d_j - t)) = 0,

one between each pair of neighbouring old ones, found for all at once by a safeguarded rational
iteration around the two nearest poles; entries of z that are zero to working precision, and all but one of
equal eigenvalues (after a rotation), are deflated. A direction outside the span so far enters with
eigenvalue zero. Spectra of partitions are combined in rounds of a few at a time: one takes the
eigenpairs of the other and the difference of the means as successive rank-one updates. The last
basis is refined by Rayleigh-Ritz: Spark adds up the covariance of the projected, centred fit
list over blocks of rows, and the eigenvectors of that small matrix turn the basis.

Counts and sums are whole numbers and exact; rows are centred before they are multiplied. What
a task holds, and what goes to the driver, is a matrix of dimensions x dimensions.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped,
and so are rows whose vector hasn't the length most rows have (the longer one on ties). Entries
saturate at 10^18 in size, so that differences fit 64 bits. Components with an eigenvalue of zero to working precision
can't be whitened and are left out, so fewer than ``most`` may come; if all vectors are equal,
or no row remains, the result is empty. Repeated rows get equal results, null ids stay. A deviation
over 64 bits is null. Only the id and the vector column are read, whatever other columns are called.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import cut

SHIFT, SCALE = 1_000_000, 64
MOST = 16
#: Spectra that one task combines in a round.
FAN_IN = 8
#: Rows that are multiplied at once.
BLOCK_ROWS = 4096
EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + rho sum(z2 / (d - t))`` for rising d, z2 > 0, rho > 0, one above each d: each as
    (number of the pole it is measured from, distance from it)."""
    k = len(d)
    top = d[-1] + rho * z2.sum()
    poles = np.append(d, top)  # the last bounds the last root and weighs nothing
    weight = rho * z2
    gap = np.diff(poles)
    mid = gap / 2
    # the sign at the middle says which pole is nearer
    at_mid = 1 + (weight / ((d - d[:, None]) - mid[:, None])).sum(axis=1)
    upper = (at_mid < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + upper
    from_origin = d[None, :] - poles[origin][:, None]
    lo = np.where(upper, -mid, 0.0)
    hi = np.where(upper, 0.0, mid)
    last_far = at_mid[-1] < 0
    lo[-1], hi[-1] = (mid[-1], gap[-1]) if last_far else (0.0, mid[-1])
    left, right = poles[:-1] - poles[origin], poles[1:] - poles[origin]
    t = (lo + hi) / 2
    below = np.tri(k, dtype=bool)
    with np.errstate(all="ignore"):
        for _ in range(100):
            r = from_origin - t[:, None]
            q = weight / r
            s = q / r
            f, size = 1 + q.sum(axis=1), 1 + np.abs(q).sum(axis=1)
            lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
            if (np.abs(f) <= 8 * EPS * size).all() or (hi - lo <= 4 * EPS * np.maximum(np.abs(lo), np.abs(hi))).all():
                break
            slope_left = (s * below).sum(axis=1)
            slope = s.sum(axis=1)
            a1, a2 = left - t, right - t
            c = f - a1 * slope_left - a2 * (slope - slope_left)
            a = (a1 + a2) * f - a1 * a2 * slope
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            new = t + step
            ok = (new > lo) & (new < hi)
            settled = np.abs(f) <= 8 * EPS * size
            t = np.where(settled, t, np.where(ok, new, (lo + hi) / 2))
    return origin, t


def update(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``u diag(d) u' + rho v v'`` (d rising, u with orthonormal columns, rho > 0)."""
    norm = float(np.sqrt(v @ v))
    if not norm or not rho:
        return d, u
    z = u.T @ v
    if u.shape[1] < len(v):
        rest = v - u @ z
        more = u.T @ rest
        rest, z = rest - u @ more, z + more  # once more, so that the new direction is orthogonal
        out = float(np.sqrt(rest @ rest))
        if out > 64 * EPS * norm:
            d, z = np.append(0.0, d), np.append(out, z)
            u = np.concatenate([(rest / out)[:, None], u], axis=1)
    tol = 8 * EPS * max(float(d[-1]) if len(d) else 0.0, rho * norm * norm)
    # deflation: equal eigenvalues are rotated until one alone meets z; small parts of z meet nothing
    for i in np.flatnonzero(np.diff(d) <= tol):
        r = math.hypot(z[i], z[i + 1])
        if r:
            c, s = z[i + 1] / r, z[i] / r
            z[i], z[i + 1] = 0.0, r
            a, b = u[:, i].copy(), u[:, i + 1].copy()
            u[:, i], u[:, i + 1] = c * a - s * b, s * a + c * b
    live = rho * np.abs(z) * norm > tol
    if not live.any():
        return d, u
    dl, zl = d[live], z[live]
    origin, t = secular_roots(dl, zl * zl, rho)
    poles = np.append(dl, 0.0)
    # root j less pole i, without cancellation
    less = (poles[origin][None, :] - dl[:, None]) + t[None, :]
    k = len(dl)
    between = dl[None, :] - dl[:, None]
    np.fill_diagonal(between, 1.0)
    # the z that has exactly these roots keeps the vectors orthogonal (one factor a pole)
    exact = np.sqrt(np.abs(np.prod(less / between, axis=1) / rho))
    exact = np.where(zl < 0, -exact, exact)
    w = exact[:, None] / -less
    w /= np.sqrt((w * w).sum(axis=0))
    out_d, out_u = d.copy(), u.copy()
    out_d[live] = dl[origin.clip(max=k - 1)] + t
    out_u[:, live] = u[:, live] @ w
    order = np.argsort(out_d, kind="stable")
    return np.maximum(out_d[order], 0.0), out_u[:, order]


class Spectrum:
    """Count, sums (whole numbers) and eigenpairs of the scatter matrix of some vectors."""

    def __init__(self, dim: int) -> None:
        self.n, self.sums = 0, np.zeros(dim, object)
        self.d, self.u = np.zeros(0), np.zeros((dim, 0))

    def away(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """(x / n) - mean, from whole numbers."""
        return (x * self.n - self.sums * n).astype(float) / (self.n * n)

    def add(self, rows: np.ndarray) -> None:
        """Rank-one updates by the rows of a matrix of whole numbers, one after another."""
        if not len(rows):
            return
        base = rows[0].astype(object)  # sums run over small numbers beside it
        moved = (rows - rows[0]).astype(float)
        start = (self.sums - self.n * base).astype(float)
        n, d, u = self.n, self.d, self.u
        for x in moved:
            if n:
                d, u = update(d, u, x - start / n, n / (n + 1))
            start = start + x
            n += 1
        self.sums = self.sums + rows.astype(object).sum(axis=0)
        self.n, self.d, self.u = n, d, u

    def merge(self, other: "Spectrum") -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.sums, self.d, self.u = other.n, other.sums, other.d, other.u
            return
        d, u = self.d, self.u
        for e, v in zip(other.d, other.u.T):
            d, u = update(d, u, v * np.sqrt(e), 1.0)
        between = self.away(other.sums, other.n)
        d, u = update(d, u, between, self.n * other.n / (self.n + other.n))
        self.n, self.sums, self.d, self.u = self.n + other.n, self.sums + other.sums, d, u


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x`` of the rows that remain."""
    v = F.col(vector_col)
    clean = rows.select(F.col(id_col).alias("vec_id"), v.cast("array<double>").alias("v")).where(
        v.isNotNull() & (F.size(v) > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    x = F.transform("v", lambda c: (F.floor(F.least(F.greatest(c * SCALE, F.lit(-1e18)), F.lit(1e18))) + SHIFT).cast("long"))
    return clean.select("vec_id", x.alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def spectra(fit: DataFrame, dim: int) -> Spectrum | None:
    """The spectrum of all rows of ``fit`` (``x``): one a task, combined in rounds."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(dim)
        for batch in batches:
            s.add(matrix(batch.column(0), dim))
        if s.n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([pickle.dumps(vars(s))], pa.binary())], names=["at", "s"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for batch in batches:
            for k, at, s in zip(*(batch.column(i).to_pylist() for i in range(3))):
                by.setdefault(k, []).append((at, s))
        for k, found in by.items():
            total = Spectrum(dim)
            for _, s in sorted(found):  # in a fixed order, so that reruns agree
                part = Spectrum(dim)
                vars(part).update(pickle.loads(s))
                total.merge(part)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([pickle.dumps(vars(total))], pa.binary())], names=["at", "s"])

    parts = cut(fit.mapInArrow(own, "at long, s binary"))
    left = (parts.agg(F.max("at")).first()[0] or 0) + 1 if parts.count() else 0
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = cut(parts.select(F.expr(f"at div {FAN_IN}").alias("k"), "at", "s").repartition(left, "k").mapInArrow(join, "at long, s binary"))
    last = [(r["at"], r["s"]) for r in parts.toLocalIterator()]  # FAN_IN matrices at most
    total = Spectrum(dim)
    for _, s in sorted(last):
        part = Spectrum(dim)
        vars(part).update(pickle.loads(s))
        total.merge(part)
    return total if total.n else None


def gram(fit: DataFrame, dim: int, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``basis' V basis`` for the covariance V of ``fit``: blocks of rows are centred, projected and
    multiplied in the tasks, and the small matrices added up in rounds."""
    mean = whole_mean(n, sums)
    shared = fit.sparkSession.sparkContext.broadcast((mean, basis))
    k = basis.shape[1]

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (base, frac), b = shared.value
        total = np.zeros((k, k))
        for batch in batches:
            x = matrix(batch.column(0), dim)
            for lo in range(0, len(x), BLOCK_ROWS):
                y = ((x[lo : lo + BLOCK_ROWS] - base).astype(float) - frac) @ b
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "s"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for batch in batches:
            for key, at, s in zip(*(batch.column(i).to_pylist() for i in range(3))):
                by.setdefault(key, []).append((at, s))
        for key, found in by.items():
            total = sum(np.frombuffer(s) for _, s in sorted(found))
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "s"])

    parts = fit.mapInArrow(own, "at long, s binary")
    left = fit.rdd.getNumPartitions()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = parts.select(F.expr(f"at div {FAN_IN}").alias("k"), "at", "s").repartition(left, "k").mapInArrow(join, "at long, s binary")
    found = sorted((r["at"], r["s"]) for r in parts.toLocalIterator())
    return sum((np.frombuffer(s).reshape(k, k) for _, s in found), np.zeros((k, k))) / n


def whole_mean(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and what is left of them, so that centring loses nothing."""
    base = [int(s) // n for s in sums]
    return np.array(base, np.int64), np.array([(int(s) - b * n) / n for s, b in zip(sums, base)])


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = MOST) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row that
    remains and each component."""
    spark = rows.sparkSession
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = whole_vectors(rows, id_col, vector_col)
    common = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], out)
    dim = common["dim"]
    x = x.where(F.size("x") == dim)
    fit = cut(x.select("x").distinct())
    found = spectra(fit, dim)
    n, sums = found.n, found.sums
    basis = np.linalg.qr(found.u)[0] if found.u.shape[1] else found.u
    if not basis.shape[1]:
        return spark.createDataFrame([], out)
    small = gram(fit, dim, n, sums, basis)
    e, w = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-e, kind="stable")
    e, v = e[order], (basis @ w)[:, order]
    trace = float(e.sum())
    kept = int((e[:most] > 64 * EPS * dim * e[0]).sum()) if e[0] > 0 else 0
    if not kept:
        return spark.createDataFrame([], out)
    turn = v[:, :kept] / np.sqrt(e[:kept])
    error = float(np.abs(gram(fit, dim, n, sums, turn) - np.eye(kept)).max())
    return project(x, dim, n, sums, turn, e[:kept] / trace, error, out)


def project(x: DataFrame, dim: int, n: int, sums: np.ndarray, turn: np.ndarray, explained: np.ndarray, error: float, schema: str) -> DataFrame:
    shared = x.sparkSession.sparkContext.broadcast((whole_mean(n, sums), [int(s) for s in sums], turn, explained))
    kept = turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (base, frac), sums, turn, explained = shared.value
        rest = [s - int(b) * n for s, b in zip(sums, base)]  # n x - S = n (x - base) - rest
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(lo, BLOCK_ROWS)
                near = matrix(batch.column(1), dim) - base
                y = (near.astype(float) - frac) @ turn
                if dim * (n * (int(np.abs(near).max()) + 1)) ** 2 < 2**63:
                    off = near * n - np.array(rest, np.int64)
                    deviation = (off * off).sum(axis=1).tolist()
                else:
                    sizes = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in near.tolist()]
                    deviation = [s if s < 2**63 else None for s in sizes]
                rows = len(near)
                repeat = pa.array(np.repeat(np.arange(rows), kept))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(repeat), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)), pa.array(np.full(rows * kept, n, np.int64)),
                                                  pa.array(deviation, pa.int64()).take(repeat), pa.array(y.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * kept, error))],
                                                 names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
