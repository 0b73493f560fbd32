"""Whitening of embeddings by an incremental eigendecomposition.

Each partition holds the count, the sums and the eigendecomposition of the scatter matrix of what it has read. A new
vector moves the mean and adds a centred rank-one term; the new eigenvalues are the roots of a secular equation, and
components that the term does not reach, or that have equal eigenvalues, are deflated first. Two partitions combine by
rank-one updates of one spectrum with the scaled eigenvectors of the other and with the difference of their means, up a
tree of partitions. The last step goes over all rows again: the covariance in the basis that was found, centred on the
exact mean, is summed over the cluster, and its eigendecomposition turns the basis (Rayleigh-Ritz).

Entries become whole numbers, so counts, sums and squared deviations are exact. What the driver and every task hold is a
model: some matrices of the square of a vector's length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.frames import split_by, stored

#: Steps of a unit, the number that zero becomes, and components at most.
STEPS, ZERO = 64, 1_000_000
COMPONENTS = 32
#: States that are combined by one task at a step.
FAN = 16
#: Components whose variance is below this share of the largest have no direction of their own.
FLAT = 1e-12
_EPS = np.finfo(np.float64).eps
_LONG = 1 << 62
_STATE = "size long, part long, n long, sums array<decimal(38,0)>, numbers array<double>"


# --- rank-one updates ---------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z', as the nearest entry of ``d`` below or above and the distance to it.

    ``d`` rises strictly, no entry of ``z`` is zero, and rho is positive. Root i lies between d[i] and d[i + 1].
    """
    k, weight = len(d), rho * z * z
    gaps = np.append(np.diff(d), weight.sum())
    middle = 1 + (weight / (d - (d + gaps / 2)[:, None])).sum(1)
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, np.arange(k) + 1, np.arange(k))
    low = np.where(right, -gaps / 2, np.where(middle < 0, gaps / 2, 0.0))
    high = np.where(right, 0.0, np.where(middle < 0, gaps, gaps / 2))
    poles = d - d[origin][:, None]
    left_side = np.arange(k) <= np.arange(k)[:, None]
    at = (low + high) / 2
    for _ in range(100):
        away = poles - at[:, None]
        terms = weight / away
        value = 1 + terms.sum(1)
        slopes = terms / away
        slope, slope_left = slopes.sum(1), (slopes * left_side).sum(1)
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        # The middle way: both sides as one pole each; the last root has a pole on one side only.
        one, two = poles[np.arange(k), np.arange(k)] - at, poles[np.arange(k), np.minimum(np.arange(k) + 1, k - 1)] - at
        with np.errstate(all="ignore"):
            c = value - one * slope_left - two * (slope - slope_left)
            a = (one + two) * value - one * two * slope
            b = one * two * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = one[-1] + one[-1] ** 2 * slope[-1] / (value[-1] - one[-1] * slope[-1])
            new = at + step
        inside = (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        done = (np.abs(new - at) <= 2 * _EPS * np.abs(new)) | (high - low <= 4 * _EPS * np.abs(at)) | (value == 0)
        at = np.where(value == 0, at, new)
        if done.all():
            break
    return origin, at


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, rising, and eigenvectors of a symmetric matrix plus rho x x', with rho not below zero."""
    z = vectors.T @ x
    size = float(np.sqrt(z @ z))
    if not size or not rho:
        return values, vectors
    z, rho = z / size, rho * size * size
    values, vectors = values.copy(), vectors.copy()
    tolerance = 8 * _EPS * max(float(np.abs(values).max()), rho * float(np.abs(z).max()))
    # Deflation: a component that the term does not reach keeps its pair.
    live = rho * np.abs(z) > tolerance
    # Of two that are nearly equal one is turned away from the term.
    held = np.flatnonzero(live)
    gaps, crossed = np.diff(values[held]), z[held][1:] * z[held][:-1] / (z[held][1:] ** 2 + z[held][:-1] ** 2)
    for i, j in zip(held[:-1], held[1:]) if (np.abs(gaps * crossed) <= tolerance).any() else ():
        length = np.hypot(z[i], z[j])
        cos, sin = z[j] / length, z[i] / length
        if abs((values[j] - values[i]) * cos * sin) > tolerance:
            continue
        z[i], z[j], live[i] = 0.0, length, False
        one, two = vectors[:, i].copy(), vectors[:, j].copy()
        vectors[:, i], vectors[:, j] = cos * one - sin * two, sin * one + cos * two
        low, high = values[i], values[j]
        values[i], values[j] = low * cos * cos + high * sin * sin, low * sin * sin + high * cos * cos
    kept = np.flatnonzero(live)
    if len(kept):
        d, w = values[kept], z[kept]
        order = np.argsort(d, kind="stable")
        kept, d, w = kept[order], d[order], w[order]
        k = len(kept)
        origin, at = secular_roots(d, w, rho)
        # Differences d[j] - root[i], free of cancellation; from them the term whose roots these are exactly.
        away = (d - d[origin][:, None]) - at[:, None]
        below = np.arange(k)[:, None] < np.arange(k)
        other = np.where(below, d[:, None], np.append(d[1:], 0.0)[:, None]) - d
        other[-1] = 1.0
        term = np.sqrt(np.abs(np.prod(-away / np.where(other == 0, 1.0, other), axis=0))) * np.sign(w)
        turned = term / away
        turned /= np.sqrt((turned * turned).sum(1))[:, None]
        values[kept] = d[origin] + at
        vectors[:, kept] = vectors[:, kept] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, and eigendecomposition of the scatter about the mean of some vectors of whole numbers."""

    def __init__(self, size: int):
        self.n, self.sums = 0, [0] * size
        self.mean = np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def _move(self, n: int, sums: list[int]) -> None:
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        self.mean = np.array([s / self.n for s in self.sums])

    def add(self, x: np.ndarray, times: int = 1) -> None:
        """Add a vector ``times`` times."""
        if self.n:
            share = self.n * times / (self.n + times)
            self.values, self.vectors = rank_one(self.values, self.vectors, x - self.mean, share)
        self._move(times, [int(v) * times for v in x])

    def combine(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.__dict__.update(other.__dict__)
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        share = self.n * other.n / (self.n + other.n)
        self.values, self.vectors = rank_one(self.values, self.vectors, other.mean - self.mean, share)
        self._move(other.n, other.sums)

    def row(self, part: int) -> dict:
        sums = [Decimal(s) for s in self.sums]
        return {"size": len(sums), "part": part, "n": self.n, "sums": sums, "numbers": [*self.values, *self.vectors.ravel()]}

    @classmethod
    def of_row(cls, row: dict) -> Spectrum:
        size = row["size"]
        out = cls(size)
        out.values, out.vectors = np.array(row["numbers"][:size]), np.array(row["numbers"][size:]).reshape(size, size)
        out._move(row["n"], [int(s) for s in row["sums"]])
        return out


# --- passes over the rows -----------------------------------------------------------------


def whole_numbers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their numbers less ``ZERO``) for each length of vector.

    Rows whose vector is null, empty, or holds null or non-finite entries, or ones too large for a long, are left out.
    """
    column = batch.column("embedding")
    sizes = np.diff(np.concatenate(([0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy()))))
    flat = column.flatten()
    valid = flat.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        steps = np.floor(STEPS * flat.fill_null(0).to_numpy().astype(np.float64))
    valid &= np.abs(steps) < _LONG
    begins = np.cumsum(sizes) - sizes
    bad = np.add.reduceat(np.append(~valid, False), np.minimum(begins, len(valid))) if len(sizes) else sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero((sizes == size) & (bad == 0))
        if len(rows):
            yield rows, steps[begins[rows][:, None] + np.arange(size)].astype(np.int64)


def _state_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"size": pa.int64(), "part": pa.int64(), "n": pa.int64(), "sums": pa.list_(pa.decimal128(38)), "numbers": pa.list_(pa.float64())}
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(kinds.items())))


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, Spectrum] = {}
    for batch in batches:
        for _, x in whole_numbers(batch):
            own = found.setdefault(x.shape[1], Spectrum(x.shape[1]))
            # Equal vectors of a batch are one term.
            for row, times in zip(*np.unique(x, axis=0, return_counts=True), strict=True):
                own.add(row, int(times))
    part = TaskContext.get().partitionId()
    yield _state_batch([s.row(part) for s in found.values()])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in split_by(batches, ["size", "node"]):
        whole, node = Spectrum(table["size"][0].as_py()), table["node"][0].as_py()
        for row in table.to_pylist():
            whole.combine(Spectrum.of_row(row))
        yield _state_batch([whole.row(node)])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States whose numbers are plain sums."""
    for table in split_by(batches, ["size", "node"]):
        rows = table.to_pylist()
        total = np.sum([r["numbers"] for r in rows], axis=0)
        yield _state_batch([{**rows[0], "part": rows[0]["node"], "numbers": total.tolist()}])


def _up_the_tree(states: DataFrame, step: Callable) -> dict[int, dict]:
    """One state for each length of vector: ``FAN`` neighbours at a time until there is one."""
    states = stored(states)
    while (states.agg(F.max("part")).first()[0] or 0) > 0:
        nodes = states.withColumn("node", F.floor(F.col("part") / FAN).cast("long")).repartition("size", "node")
        nodes = nodes.sortWithinPartitions("size", "node", "part")
        states = stored(nodes.mapInArrow(step, _STATE))
    return {r["size"]: r.asDict() for r in states.collect()}


class Whitening:
    """For vectors of one length: count, exact mean, and components by falling variance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums = n, sums
        self.mean = np.array([s / n for s in sums])
        self.values, self.vectors = values, vectors
        self.identity_error = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.values.sum() if self.values.any() else self.values

    def kept(self) -> int:
        """Components that have a variance, at most ``COMPONENTS``."""
        return int((self.values[:COMPONENTS] > FLAT * self.values[0]).sum())

    def whitened(self, x: np.ndarray) -> np.ndarray:
        k = self.kept()
        return (x - self.mean) @ (self.vectors[:, :k] / np.sqrt(self.values[:k]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums) ** 2 over the dimensions of each row, exact; None if it is too large for a long."""
        top = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if top < _LONG:
            off = self.n * x - np.array(self.sums, np.int64)
            if x.shape[1] * int(np.abs(off).max(initial=0)) ** 2 < 2 * _LONG:
                return (off * off).sum(1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x]
        return [v if v < 2 * _LONG else None for v in exact]


def _products(models: dict[int, Whitening], seen: Callable[[Whitening, np.ndarray], np.ndarray]):
    """Sums over a partition of the products of what ``seen`` makes of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in whole_numbers(batch):
                y = seen(models[x.shape[1]], x)
                total[x.shape[1]] = total.get(x.shape[1], 0.0) + y.T @ y
        part = TaskContext.get().partitionId()
        yield _state_batch([{"size": k, "part": part, "n": 0, "sums": [], "numbers": m.ravel().tolist()} for k, m in total.items()])

    return run


def fit(vectors: DataFrame) -> dict[int, Whitening]:
    """The whitening of all vectors of each length, from ``vectors`` (embedding). None of an empty table."""
    rows = vectors.select("embedding")
    states = _up_the_tree(rows.mapInArrow(_spectra, _STATE), _combined)
    models = {}
    for size, row in states.items():
        s = Spectrum.of_row(row)
        models[size] = Whitening(s.n, s.sums, s.values[::-1].copy(), s.vectors[:, ::-1].copy())
    turned = lambda model, x: (x - model.mean) @ model.vectors
    for size, row in _up_the_tree(rows.mapInArrow(_products(models, turned), _STATE), _added).items():
        m = models[size]
        values, turn = np.linalg.eigh(np.array(row["numbers"]).reshape(size, size) / m.n)
        m.values, m.vectors = np.maximum(values[::-1], 0), m.vectors @ turn[:, ::-1]
        # Of the two signs of a component, the one whose largest entry is above zero.
        m.vectors = m.vectors * np.sign(m.vectors[np.abs(m.vectors).argmax(0), np.arange(size)])
    white = lambda model, x: model.whitened(x)
    for size, row in _up_the_tree(rows.mapInArrow(_products(models, white), _STATE), _added).items():
        m = models[size]
        found = np.array(row["numbers"]).reshape(m.kept(), m.kept()) / m.n
        m.identity_error = float(np.abs(found - np.eye(m.kept())).max(initial=0))
    return models


def _rows(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for rows, x in whole_numbers(batch):
                m = models[x.shape[1]]
                k = m.kept()
                each = lambda values, kind: pa.array(np.repeat(np.array(values, object), k), kind)
                columns = [
                    ids.take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, m.n, np.int64)),
                    each(m.deviations(x), pa.int64()),
                    pa.array(m.whitened(x).ravel()),
                    pa.array(np.tile(m.explained[:k], len(rows))),
                    pa.array(np.full(len(rows) * k, m.identity_error)),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def whitened(vectors: DataFrame, models: dict[int, Whitening] | None = None) -> DataFrame:
    """Whitened vectors, a row for each component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Entries become floor(64 c) + 1,000,000. Rows whose vector is null, empty, or holds null or non-finite entries, or
    ones too large for a long, have no result and take no part in the fit. Vectors of different lengths are fitted
    apart. A component without variance cannot be scaled and is left out, so equal vectors alone give no rows. A
    deviation too large for a long is null. Null and repeated vec_ids pass through, each row by itself; other columns
    are not read.
    """
    models = fit(vectors) if models is None else models
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_rows(models), schema)
