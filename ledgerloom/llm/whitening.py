"""Embeddings whitened: on their principal components, each of variance 1.

Vectors are rounded to whole numbers, so equal ones are told without doubt and sums are exact. Each
distinct vector counts once. Its entries are centred by the whole number next to their mean before
they are multiplied; what the mean is off from that is settled in whole numbers afterwards.

The scatter's pivoted Cholesky factor is rotated by one-sided Jacobi until its columns are orthogonal:
then their squared norms are the eigenvalues and their directions the components. The factor keeps
small eigenvalues beside large ones, which the scatter squared once more would not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shipping import ship
from ledgerloom.session import stage

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Dimensions whose variance the others explain but for this part of it add no component.
DEPENDENT = 1e-11
# Entries beyond this are no whole numbers in double precision any more.
_LARGEST = 2.0**52
_SWEEPS = 60


# --- whole numbers -----------------------------------------------------------------------------


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the places of the vectors that take part, and these as doubles, one a row."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == length)
        rows = values[starts[at][:, None] + np.arange(length)]
        with np.errstate(over="ignore", invalid="ignore"):
            fits = (np.abs(rows * SCALE) < _LARGEST).all(1)
        if fits.any():
            yield at[fits], rows[fits]


def _whole(rows: np.ndarray) -> np.ndarray:
    return np.floor(rows * SCALE).astype(np.int64) + SHIFT


def _fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, rows in _matrices(batch.column(0)):
            packed = [x.tobytes() for x in _whole(rows).astype("<i8")]
            yield pa.RecordBatch.from_arrays([pa.array([rows.shape[1]] * len(rows), pa.int32()), pa.array(packed)], ["dims", "x"])


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The whole vectors of a batch (dims, x), by length."""
    dims = batch.column(0).to_numpy()
    for length in np.unique(dims).tolist():
        packed = batch.column(1).filter(pa.array(dims == length))
        yield length, np.frombuffer(b"".join(packed.to_pylist()), "<i8").reshape(-1, length)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each length: vectors, and by dimension the sum, least and greatest of their entries."""
    held: dict[int, list] = {}
    for batch in batches:
        for length, x in _unpacked(batch):
            # Entries are below 2^53, and a batch has far fewer than 2^10 rows of such size or 8 MB.
            low, high = x.min(0), x.max(0)
            small = max(-int(low.min()), int(high.max()), 1) * len(x) < 2**62
            total = x.sum(0).tolist() if small else x.astype(object).sum(0).tolist()
            old = held.setdefault(length, [0, [0] * length, low, high])
            sums = [a + b for a, b in zip(old[1], total)]
            held[length] = [old[0] + len(x), sums, np.minimum(old[2], low), np.maximum(old[3], high)]
    for length, (n, sums, low, high) in held.items():
        columns = [
            pa.array([length] * length, pa.int32()),
            pa.array(range(length), pa.int32()),
            pa.array([n] * length, pa.int64()),
            pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
            pa.array(low),
            pa.array(high),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["dims", "i", "n", "total", "low", "high"])


_SUMS_SCHEMA = "dims int, i int, n bigint, total decimal(38,0), low bigint, high bigint"
_ENTRIES_SCHEMA = "dims int, i int, j int, value double"


@dataclass(frozen=True)
class Centre:
    """Where the vectors of one length lie: the mean is ``near + off / n``, ``near`` being whole."""

    n: int
    near: np.ndarray
    off: np.ndarray
    #: Whether squared deviations of n times the entries fit 64 bits.
    narrow: bool

    @classmethod
    def of(cls, n: int, totals: list[int], low: list[int], high: list[int]) -> Centre:
        near = [(2 * s + n) // (2 * n) for s in totals]
        most = max(max(n * h - s, s - n * l) for s, l, h in zip(totals, low, high))
        off = [s - n * r for s, r in zip(totals, near)]
        return cls(n, np.array(near, np.int64), np.array(off, np.int64), len(totals) * most**2 < 2**62)

    def apart(self, x: np.ndarray) -> np.ndarray:
        """Whole distances from ``near``."""
        return x - self.near

    def centred(self, x: np.ndarray) -> np.ndarray:
        if self.narrow:
            return (self.n * self.apart(x) - self.off) / self.n
        return self.apart(x).astype(np.float64) - self.off / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums over dimensions of (n * x - S)^2, exact; null where that has more than 38 digits."""
        if self.narrow:
            return pa.array(((self.n * self.apart(x) - self.off) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        wide = self.n * self.apart(x).astype(object) - self.off.astype(object)
        found = (wide**2).sum(1).tolist()
        return pa.array([Decimal(v) if v < 10**38 else None for v in found], pa.decimal128(38, 0))


def _entries(length: int, matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    columns = [np.full(len(i), length, np.int32), i.astype(np.int32), j.astype(np.int32), matrix[i, j]]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["dims", "i", "j", "value"])


def _scatter(batches: Iterator[pa.RecordBatch], centres: dict[int, Centre]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the distances from ``near``: whole numbers, and exact up to 2^53."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, x in _unpacked(batch):
            z = centres[length].apart(x).astype(np.float64)
            held[length] = held.get(length, 0) + z.T @ z
    for length, products in held.items():
        yield _entries(length, products)


# --- eigenvalues -------------------------------------------------------------------------------


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower triangular L and an order with ``L @ L.T == scatter[order][:, order]``.

    A dimension is a pivot as long as more than ``DEPENDENT`` of its own variance is left; L has as
    many columns as there are pivots.
    """
    left, d = scatter.astype(np.float64).copy(), len(scatter)
    own, order, low, rank = np.diag(scatter).copy(), np.arange(d), np.zeros((d, d)), 0
    for k in range(d):
        rest = np.diag(left)[k:]
        usable = rest > DEPENDENT * own[order[k:]]
        if not usable.any():
            break
        p = k + int(np.argmax(np.where(usable, rest, -1)))
        order[[k, p]] = order[[p, k]]
        low[[k, p], :k] = low[[p, k], :k]
        left[[k, p]] = left[[p, k]]
        left[:, [k, p]] = left[:, [p, k]]
        low[k, k] = np.sqrt(left[k, k])
        low[k + 1 :, k] = left[k + 1 :, k] / low[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
        rank = k + 1
    return low[:, :rank], order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns in rounds of pairs without a common column."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(ring[i], ring[-1 - i]) for i in range(len(ring) // 2)]
        pairs = [(min(p), max(p)) for p in pairs if max(p) < n]
        yield np.array([p for p, _ in pairs], np.int64), np.array([q for _, q in pairs], np.int64)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def jacobi_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated until they are orthogonal, those of large norms first."""
    columns = factor.T.copy()
    enough = 4 * np.finfo(float).eps
    for _ in range(_SWEEPS):
        turned = False
        for p, q in _rounds(len(columns)):
            a, b = columns[p], columns[q]
            # The larger column first, so that norms come to be in order.
            alpha, beta, gamma = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            apart = np.abs(gamma) > enough * np.sqrt(alpha * beta)
            if not apart.any():
                continue
            turned = True
            zeta = (beta - alpha) / (2 * np.where(apart, gamma, 1))
            t = np.where(apart, np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            s = c * t
            columns[p], columns[q] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
        if not turned:
            break
    return columns[np.argsort(-(columns**2).sum(1), kind="stable")].T


def principal_components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors, one a row; those of no variance are left out.

    Of either sign that is taken which makes an eigenvector's largest entry positive.
    """
    low, order = pivoted_cholesky(covariance)
    rotated = np.empty_like(low)
    rotated[order] = jacobi_columns(low)
    values = (rotated**2).sum(0)
    vectors = (rotated / np.sqrt(values)).T[:most]
    largest = np.abs(vectors).argmax(1) if len(vectors) else np.empty(0, np.int64)
    signs = np.sign(vectors[np.arange(len(vectors)), largest])
    return values[:most], vectors * signs[:, None]


def _covariance(centre: Centre, entries: list[tuple[int, int, float]]) -> np.ndarray:
    """Exact as long as the sums of products are: quotients of whole numbers."""
    off = centre.off.tolist()
    out = np.empty((len(off), len(off)))
    for i, j, value in entries:
        out[i, j] = out[j, i] = (centre.n * int(value) - off[i] * off[j]) / centre.n**2
    return out


# --- whitening ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors.T / np.sqrt(self.values)


def _whitened_products(batches: Iterator[pa.RecordBatch], models) -> Iterator[pa.RecordBatch]:
    """Sums of products of whitened entries; a further entry that is 1 gives their sums."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, x in _unpacked(batch):
            w = models.value[length].whiten(x)
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            held[length] = held.get(length, 0) + w.T @ w
    for length, products in held.items():
        yield _entries(length, products)


_OUT = {
    "vec_id": pa.int64(),
    "component": pa.int32(),
    "n": pa.int64(),
    "deviation": pa.decimal128(38, 0),
    "whitened": pa.float64(),
    "explained": pa.float64(),
    "identity_error": pa.float64(),
}
_OUT_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
)
_ROWS = 4096


def _rows(batches: Iterator[pa.RecordBatch], models, errors: dict[int, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, rows in _matrices(batch.column(1)):
            model, error = models.value[rows.shape[1]], errors.get(rows.shape[1])
            k = len(model.values)
            for start in range(0, len(at) if k else 0, _ROWS):
                x = _whole(rows[start : start + _ROWS])
                n, each = len(x), pa.array(np.repeat(np.arange(len(x)), k))
                arrays = [
                    batch.column(0).take(pa.array(at[start : start + _ROWS])).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, model.centre.n)),
                    model.centre.deviations(x).take(each),
                    pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, n)),
                    pa.array(np.full(n * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, list(_OUT))


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct whole vector of ``vectors`` (embedding) once: dims and x, 8 bytes an entry.

    Copies are put together before they are shuffled.
    """
    ship(vectors.sparkSession)
    known = vectors.select(F.col("embedding").cast("array<double>").alias("embedding"))
    return known.mapInArrow(_fixed, "dims int, x binary").distinct()


def fit_whitening(fit: DataFrame, most: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each length of the vectors of ``fit``, see ``fit_list``; it is read twice.

    What comes to the driver is a row for each dimension and for each pair of them.
    """
    grouped = fit.mapInArrow(_sums, _SUMS_SCHEMA).groupBy("dims", "i")
    summed = grouped.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    by_length: dict[int, list] = {}
    for r in sorted(summed.collect()):
        by_length.setdefault(r["dims"], []).append((r["n"], int(r["total"]), r["low"], r["high"]))
    centres = {length: Centre.of(rows[0][0], *map(list, list(zip(*rows))[1:])) for length, rows in by_length.items()}
    products = fit.mapInArrow(lambda batches: _scatter(batches, centres), _ENTRIES_SCHEMA)
    entries: dict[int, list] = {length: [] for length in centres}
    for length, i, j, value in zip(*_summed(products)):
        entries[length].append((i, j, value))
    out = {}
    for length, centre in centres.items():
        covariance = _covariance(centre, entries[length])
        out[length] = Whitener(centre, *principal_components(covariance, most), float(np.trace(covariance)))
    return out


def _summed(entries: DataFrame) -> list[list]:
    total = entries.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    return [total[name].to_pylist() for name in ("dims", "i", "j", "value")]


def identity_errors(fit: DataFrame, models) -> dict[int, float]:
    """By length the largest entry of the whitened vectors' covariance minus the identity, measured.

    ``models`` is a broadcast of ``fit_whitening``.
    """
    products = fit.mapInArrow(lambda batches: _whitened_products(batches, models), _ENTRIES_SCHEMA)
    sums: dict[int, np.ndarray] = {}
    for length, i, j, value in zip(*_summed(products)):
        k = len(models.value[length].values)
        sums.setdefault(length, np.zeros((k + 1, k + 1)))[i, j] = value
    found = {}
    for length, matrix in sums.items():
        n, mean = matrix[-1, -1], matrix[:-1, -1] / matrix[-1, -1]
        apart = np.triu(matrix[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean)))
        found[length] = float(np.abs(apart).max(initial=0))
    return found


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each row of ``vectors`` (vec_id, embedding) and component, ``most`` of them at most.

    vec_id, component (from 1, by falling eigenvalue), n (distinct vectors), deviation (sum of the
    squares of n * x - S, exact), whitened, explained (part of the variance) and identity_error (one
    value, measured over the distinct vectors).

    Left out are rows whose vector is null, empty, or holds null or non-finite entries or such beyond
    2^52 / SCALE. Repeated rows all have their output and count once in the fit, as do vectors that
    are equal once rounded. Vectors of each length are a table of their own. There are no components
    without variance, and so no rows of a table of one distinct vector. Rows without a vec_id take
    part. Further columns are ignored; an empty table has no rows. deviation is null beyond 38 digits.
    """
    spark = vectors.sparkSession
    fit = stage(fit_list(vectors), "fit-list")
    models = spark.sparkContext.broadcast(fit_whitening(fit, most))
    errors = identity_errors(fit, models)
    known = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return known.mapInArrow(lambda batches: _rows(batches, models, errors), _OUT_SCHEMA)
