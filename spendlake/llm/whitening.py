"""Whitening of vectors on the leading principal components of their distinct values.

Spark sums what grows with the rows: exact sums of whole-number vectors, then products of centred vectors, a matrix per
task. The covariance, as large as a vector is long, squared, is solved on the driver: eigenvectors in single precision,
corrected by Ogita and Aishima's iteration, which needs matrix products only, first in double, then in extended precision.
Eigenvalues too close for it to tell apart form a cluster, whose subspace gets a solve of its own about the cluster's
mean, where the differences are not lost beside the eigenvalues themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import stored

#: Entries become whole multiples of 1 / GRAIN.
GRAIN = 256
#: Iterations at most; each squares the error.
ROUNDS = 30
#: Whole numbers and sums beyond this are handled as Python's.
SAFE = float(1 << 62)

_RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
_CELL = pa.schema([("dim", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("v", pa.float64())])


def _whole(batches):
    """``vec_id, dim, body`` of the rows that can be used; the body holds 64-bit whole numbers."""
    for b in batches:
        lists = b.column(1)
        values = pa.compute.fill_null(lists.values, np.nan).to_numpy(zero_copy_only=False)
        begin, length = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
        length = np.where(lists.is_valid().to_numpy(zero_copy_only=False), length, 0)
        for dim in np.unique(length[length > 0]).tolist():
            rows = np.flatnonzero(length == dim)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(values[begin[rows][:, None] + np.arange(dim)] * GRAIN)
                good = (np.abs(x) < SAFE).all(1)  # false for what is not finite, too
            x = np.ascontiguousarray(x[good].astype("<i8"))
            bodies = pa.array([r.tobytes() for r in x], pa.binary())
            ids = b.column(0).take(pa.array(rows[good]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(x), dim)), bodies], names=["vec_id", "dim", "body"])


def _matrices(b: pa.RecordBatch):
    """Per length: the batch's rows and their vectors."""
    dims = b.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        bodies = b.column("body").take(pa.array(rows))
        yield dim, rows, np.frombuffer(b"".join(bodies.to_pylist()), "<i8").reshape(-1, dim)


def _exact_sum(x: np.ndarray) -> np.ndarray:
    fits = float(np.abs(x).max()) * len(x) < SAFE
    return (x if fits else x.astype(object)).sum(0)


def _sums(batches):
    """Per length and dimension the rows and the sum of a task."""
    held: dict[int, list] = {}
    for b in batches:
        for dim, _, x in _matrices(b):
            n, s = held.get(dim, (0, np.zeros(dim, object)))
            held[dim] = [n + len(x), s + _exact_sum(x).astype(object)]
    for dim, (n, s) in held.items():
        columns = [pa.array([dim] * dim), pa.array(np.arange(dim)), pa.array([n] * dim, pa.int64()), pa.array([int(v) for v in s], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "i", "n", "s"])


@dataclass
class Centre:
    """Rows and exact sums of the fit list; the mean as a whole number and the rest."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.whole)])

    def apart(self, x: np.ndarray) -> np.ndarray:
        """Vectors less the mean; the subtraction of whole numbers is exact."""
        return (x - self.whole).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        most = float(np.abs(x).max(initial=0)) * self.n + max(abs(float(s)) for s in self.sums)
        fits = most < SAFE and most * most * x.shape[1] < SAFE
        kind = np.int64 if fits else object
        apart = x.astype(kind) * self.n - np.array(self.sums, kind)
        return [v if v < 1 << 63 else None for v in map(int, (apart * apart).sum(1))]


def _products(centres: dict[int, Centre], axes: dict[int, np.ndarray] | None = None):
    """Sums over a task of the products of two dimensions of the centred vectors, or of their places on the axes."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim, _, x in _matrices(b):
                apart = centres[dim].apart(x)
                if axes is not None:
                    apart = apart @ axes[dim]
                held[dim] = held.get(dim, 0) + apart.T @ apart
        for dim, q in held.items():
            i, j = np.triu_indices(len(q))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim)), pa.array(i), pa.array(j), pa.array(q[i, j])], schema=_CELL)

    return run


def _covariances(fit: DataFrame, centres: dict[int, Centre], axes: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    sizes = {d: d if axes is None else axes[d].shape[1] for d in centres}
    out = {d: np.zeros((size, size)) for d, size in sizes.items()}
    cells = fit.select("dim", "body").mapInArrow(_products(centres, axes), "dim bigint, i bigint, j bigint, v double")
    # At most half the square of a vector's length.
    cells = cells.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toArrow().to_pydict()
    for d, i, j, v in zip(*cells.values()):
        out[d][i, j] = out[d][j, i] = v / centres[d].n
    return out


def _sub_solve(a: np.ndarray, x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A basis of eigenvectors in the space of the columns of ``x``, whose eigenvalues lie close together."""
    x = np.linalg.qr(x.astype(np.float64))[0].astype(a.dtype)
    middle = values.mean()
    inner = x.T @ (a @ x - middle * x)
    scale = np.abs(inner).max()
    if scale == 0:
        return x
    turned = np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(np.float64))[1]
    return x @ turned.astype(a.dtype)


def _corrected(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Ogita and Aishima's iteration in the precision of ``a``, until corrections no longer shrink; then unit columns."""
    eye, size, last = np.eye(len(a), dtype=a.dtype), float(np.linalg.norm(a.astype(np.float64), 2)), np.inf
    least = float(np.finfo(a.dtype).eps) * len(a)
    for _ in range(ROUNDS):
        off = eye - x.T @ x
        inner = x.T @ a @ x
        values = np.diag(inner) / (1 - np.diag(off))
        spread = inner - np.diag(values)
        delta = 2 * (np.linalg.norm(spread.astype(np.float64), 2) + size * np.linalg.norm(off.astype(np.float64), 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > delta
        change = np.where(apart, (inner + values[None, :] * off) / np.where(apart, gap, 1), off / 2)
        np.fill_diagonal(change, np.diag(off) / 2)
        x = x + x @ change
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        for cluster in np.split(np.arange(len(values)), np.flatnonzero(-np.diff(values) > delta) + 1):
            # Below the rounding of the values nothing is left to tell apart.
            if len(cluster) > 1 and delta > 8 * least * size:
                x[:, cluster] = _sub_solve(a, x[:, cluster], values[cluster])
        moved = float(np.abs(change).max())
        if moved <= least or (moved >= last / 2 and moved < 1e-8):
            break
        last = moved
    for _ in range(2):
        x = x + x @ ((eye - x.T @ x) / 2)
    return x


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns, to double precision."""
    scale = np.abs(covariance).max(initial=0)
    if scale == 0:
        return np.zeros(len(covariance)), np.eye(len(covariance))
    a = covariance / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.float64)
    x = _corrected(a, x)
    a = a.astype(np.longdouble)
    x = _corrected(a, x.astype(np.longdouble))
    x = x / np.sqrt((x * x).sum(0))
    values = ((a @ x) * x).sum(0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


def _placed(centres: dict[int, Centre], axes: dict[int, np.ndarray], shares: dict[int, list], errors: dict[int, float | None]):
    def run(batches):
        for b in batches:
            for dim, rows, x in _matrices(b):
                c, shown = centres[dim], len(shares[dim])
                ids = b.column("vec_id").take(pa.array(np.repeat(rows, shown)))
                deviations = pa.array(c.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), shown)))
                places = np.zeros((len(x), shown))
                solved = axes[dim].shape[1]
                places[:, :solved] = c.apart(x) @ axes[dim]
                unknown = np.tile(np.arange(shown) >= solved, len(x))
                m = len(x) * shown
                columns = [
                    ids, pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))), pa.array(np.full(m, c.n)), deviations,
                    pa.array(places.reshape(-1), mask=unknown), pa.array(shares[dim] * len(x), pa.float64()), pa.array([errors[dim]] * m, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, components: int = 4, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per usable row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries c become ``floor(256 c)``. A row is left out if its vector is null or empty, or an entry is null, not finite, or
    so large that this does not fit 62 bits. The fit list holds each distinct vector of whole numbers once, ``n`` in all;
    vectors of each length are fitted for themselves. Repeated rows (and equal ids) each get their rows; null ids stay.
    ``deviation`` is null where the exact sum does not fit a long. Components without variance (a single distinct vector,
    dependent dimensions) have ``whitened`` null and count as no part of ``identity_error``, which is null if no component
    has any; ``explained`` is null where there is no variance at all. A vector shorter than ``components`` has as many
    components as entries. Equal eigenvalues: some basis of theirs, the same for all rows. Empty table: no rows. Other
    columns are not read.
    """
    if components < 1:
        raise ValueError("at least one component")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    whole = rows.mapInArrow(_whole, "vec_id bigint, dim bigint, body binary")
    fit = stored(whole.select("dim", "body").distinct(), "fit")
    sums = fit.mapInArrow(_sums, "dim bigint, i bigint, n bigint, s decimal(38,0)")
    # A row per dimension of each length.
    found: dict[int, dict[int, tuple]] = {}
    for r in sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        found.setdefault(r.dim, {})[r.i] = (r.n, int(r.s))
    if not found:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    centres = {d: Centre(s[0][0], [s[i][1] for i in range(d)]) for d, s in found.items()}
    axes, shares = {}, {}
    for d, v in _covariances(fit, centres).items():
        values, basis = eigen(v)
        total, shown = float(np.trace(v)), min(components, d)
        solved = int((values[:shown] > d * np.finfo(float).eps * total).sum())
        axes[d] = basis[:, :solved] / np.sqrt(values[:solved])
        shares[d] = [max(float(x), 0.0) / total if total > 0 else None for x in values[:shown]]
    errors = {d: float(np.abs(v - np.eye(len(v))).max()) if len(v) else None for d, v in _covariances(fit, centres, axes).items()}
    return whole.mapInArrow(_placed(centres, axes, shares, errors), _RESULT)
