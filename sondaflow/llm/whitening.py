"""Whitening of embeddings by refined eigenvectors of their covariance.

Tasks add up counts and sums of the distinct vectors, then products of vectors that are
centred at the rounded mean. Both are whole numbers, added without error; what the rounded
mean lacks is taken off exactly, so the covariance is right to the last digit that its type
holds, however large the table.

Its eigenvectors come from a decomposition in single precision and are refined by the
iteration of Ogita and Aishima, which needs only matrix products in a higher precision: from
``R = I - X'X`` and ``S = X'AX`` follow the eigenvalues and a correction of every vector,
and the error squares with each turn. Eigenvalues nearer to each other than the residual
tells apart are a cluster: inside it only orthogonality is mended, and then a solve of the
small matrix of the cluster, less its mean eigenvalue, finds the directions that single
precision has missed, from where the turns go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.llm.tables import written

# The widest floating type of the machine: 64 bits of mantissa where it has them, never less than 53.
HIGH = np.longdouble
TURNS = 40
ROWS = 4096
LIMB = 32


def integers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each entry as double; null unless all are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


# ---- covariance

def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of one length at a time: the length, their rows in the batch, and a matrix of a few."""
    sizes = np.asarray(column.value_lengths())
    values = np.asarray(column.flatten())
    firsts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        mine = np.flatnonzero(sizes == dim)
        for first in range(0, len(mine), ROWS):
            rows = mine[first:first + ROWS]
            yield int(dim), rows, values[firsts[rows][:, None] + np.arange(dim)]


def _products(y: np.ndarray) -> np.ndarray:
    """The sums of products of columns as whole numbers: in doubles while those are exact, else in Python's."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * max(1, len(y)) < 1 << 53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    z = y.astype(object)
    return z.T @ z


def _limbs(total: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Whole numbers as high and low parts, whose sums over tasks do not overflow."""
    return (pa.array([int(v) >> LIMB for v in total], pa.int64()),
            pa.array([int(v) & ((1 << LIMB) - 1) for v in total], pa.int64()))


def _partial(center: dict[int, list[int]]):
    """Per task and length, a row for each line of the matrix of products of centred vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch.column("x")):
                part = _products(x - np.array(center[dim], np.int64))
                totals[dim] = totals[dim] + part if dim in totals else part
        for dim, total in totals.items():
            for i, line in enumerate(total):
                high, low = _limbs(line)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([i], pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, dim], pa.int32()), high),
                     pa.ListArray.from_arrays(pa.array([0, dim], pa.int32()), low)], ["dim", "i", "high", "low"])
    return run


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for name in ("high", "low"):
            part = np.asarray(batch.column(name).flatten()).reshape(batch.num_rows, -1).sum(axis=0)
            total[name] = total.get(name, 0) + part
    yield pa.RecordBatch.from_arrays(
        [batch.column("dim")[:1], batch.column("i")[:1], pa.array([total["high"].tolist()], pa.list_(pa.int64())),
         pa.array([total["low"].tolist()], pa.list_(pa.int64()))], ["dim", "i", "high", "low"])


@dataclass(frozen=True)
class Moments:
    """What a fit list of vectors of one length adds up to. ``scaled`` is n * n * covariance."""

    n: int
    sums: list[int]
    scaled: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        exact = self.scaled
        # Whole numbers of any size, in the precision of the type: the upper and lower half apart.
        upper = np.array([[int(v) >> 48 for v in line] for line in exact], HIGH)
        lower = np.array([[int(v) & ((1 << 48) - 1) for v in line] for line in exact], HIGH)
        return (upper * HIGH(1 << 48) + lower) / (HIGH(self.n) * HIGH(self.n))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for dim, rows, x in _matrices(batch.column("x")):
            n, total = totals.get(dim, (0, 0))
            small = int(np.abs(x).max(initial=0)) * len(x) < 1 << 63
            totals[dim] = n + len(rows), total + x.sum(axis=0, dtype=np.int64 if small else object).astype(object)
    for dim, (n, total) in totals.items():
        high, low = _limbs(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
             high, low], ["dim", "i", "n", "high", "low"])


def moments(fit: DataFrame) -> dict[int, Moments]:
    """By length of the vectors ``x``: their number, sums and covariance. A row per matrix line comes back,
    as many as there are dimensions."""
    sums: dict[int, list[int]] = {}
    counts: dict[int, int] = {}
    for r in (fit.select("x").mapInArrow(_summed, "dim int, i int, n long, high long, low long")
              .groupBy("dim", "i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
              .orderBy("dim", "i").collect()):
        sums.setdefault(r.dim, []).append((r.high << LIMB) + r.low)
        counts[r.dim] = r.n
    center = {dim: [round(s / counts[dim]) for s in total] for dim, total in sums.items()}
    kinds = "dim int, i int, high array<long>, low array<long>"
    lines = fit.select("x").mapInArrow(_partial(center), kinds).groupBy("dim", "i").applyInArrow(_added, kinds)
    products: dict[int, list] = {dim: [None] * dim for dim in sums}
    for r in lines.collect():
        products[r.dim][r.i] = [(h << LIMB) + low for h, low in zip(r.high, r.low)]
    out = {}
    for dim, total in sums.items():
        n = counts[dim]
        rest = np.array([s - n * c for s, c in zip(total, center[dim])], object)
        out[dim] = Moments(n, total, np.array(products[dim], object) * n - np.outer(rest, rest))
    return out


# ---- eigenvectors

def _clusters(values: np.ndarray, gap: HIGH) -> list[np.ndarray]:
    """Places of eigenvalues, in falling order, whose neighbours are no further than ``gap``."""
    order = np.argsort(-values, kind="stable")
    apart = np.flatnonzero(-np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, apart) if len(c) > 1]


def _turn(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, HIGH, HIGH, int]:
    """One turn: better vectors, eigenvalues, the gap that this turn could tell, the size of its step, and
    how many pairs of eigenvalues it could tell apart."""
    r = np.eye(len(a), dtype=HIGH) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    gap = 2 * (np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum()))
    # Nearer ones would turn the rounding of the products into directions.
    gap = max(gap, np.sqrt(np.finfo(HIGH).eps) * np.abs(values).max())
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    step = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ step, values, gap, np.abs(step).max(), int(far.sum())


def eigenvectors(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns, in the high precision.

    A symmetric matrix with equal eigenvalues has any orthonormal vectors for them.
    """
    size = np.abs(covariance).max()
    if not size > 0:
        return np.zeros(len(covariance), HIGH), np.eye(len(covariance), dtype=HIGH)
    a = (covariance / size).astype(HIGH)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    tiny = np.finfo(HIGH).eps * len(a)
    solved, last = 0, None
    for _ in range(TURNS):
        x, values, gap, step, pairs = _turn(a, x)
        # A pair that is told apart for the first time may be turned far; else the turns come to an end.
        if last is not None and pairs == last[1] and (step <= tiny or step >= last[0] / 2):
            clusters = _clusters(values, gap)
            if not clusters or solved >= 2:
                break
            solved += 1
            for cluster in clusters:
                part = x[:, cluster]
                middle = values[cluster].mean()
                inner = part.T @ (a @ part) - middle * (part.T @ part)
                inner = (inner + inner.T) / 2
                width = np.abs(inner).max()
                if width > 0:
                    x[:, cluster] = part @ np.linalg.eigh((inner / width).astype(np.float64))[1].astype(HIGH)
            last = None
            continue
        last = step, pairs
    x = x + x @ ((np.eye(len(a), dtype=HIGH) - x.T @ x) / 2)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return values[order] * size, x


# ---- whitened rows

@dataclass(frozen=True)
class Whitening:
    """The first components of a fit list: eigenvalues, unit eigenvectors as columns, shares of the variance.
    A component without variance has no direction of its own and whitens nothing."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float | None]

    @staticmethod
    def of(m: Moments, components: int) -> Whitening:
        values, vectors = eigenvectors(m.covariance)
        trace = sum(int(m.scaled[k][k]) for k in range(len(m.sums)))
        trace = HIGH(trace >> 48) * HIGH(1 << 48) + HIGH(trace & ((1 << 48) - 1))
        trace /= HIGH(m.n) * HIGH(m.n)
        first = vectors[:, :components]
        signs = np.sign(first[np.abs(first).argmax(axis=0), np.arange(first.shape[1])])
        floor = trace * np.finfo(HIGH).eps * 64 * len(m.sums)
        values = np.where(values[:components] > floor, values[:components], 0)
        return Whitening(m.n, m.sums, values.astype(np.float64), (first * signs).astype(np.float64),
                         [float(v / trace) if trace > 0 else None for v in values])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of components; NaN where a component has no variance."""
        centred = self.differences(x).astype(np.float64) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, whole numbers."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums)))
        kind = np.int64 if largest < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, x: np.ndarray) -> list[int]:
        d = self.differences(x)
        if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 1 << 63:
            d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def _rows(models: dict[int, Whitening], errors: dict[int, float | None], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _matrices(batch.column("x")):
                model = models[dim]
                found = model.whitened(x)
                count = found.shape[1]
                kept = batch.select(columns).take(pa.array(np.repeat(rows, count)))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(np.tile(np.arange(1, count + 1), len(rows)), pa.int32()),
                     pa.array([model.n] * len(kept), pa.int64()),
                     pa.array(np.repeat(np.array(model.deviations(x), object), count).tolist(), pa.int64()),
                     pa.array(found.ravel(), from_pandas=True),
                     pa.array(model.explained * len(rows), pa.float64()),
                     pa.array([errors[dim]] * len(kept), pa.float64())],
                    [*columns, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def _errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float | None]:
    """By length: the largest entry of the whitened covariance less the identity, over the fit list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, x in _matrices(batch.column("x")):
                found = models[dim].whitened(x)
                w = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * found.shape[1], pa.int32()),
                                             pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(rows), pa.int32()), w], ["dim", "w"])

    most = max((len(m.values) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i + 1)]
    # covar_pop centres before it multiplies.
    covariances = fit.select("x").mapInArrow(run, "dim int, w array<double>").groupBy("dim").agg(
        *(F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs)) if most else None
    errors: dict[int, float | None] = {}
    for r in covariances.collect() if most else ():
        live = [k for k, v in enumerate(models[r.dim].values) if v > 0]
        errors[r.dim] = max((abs(r[f"c{i}_{j}"] - (i == j)) for i in live for j in live if j <= i), default=None)
    return errors


def whitened(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 4,
             scale: float = 256.0) -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error.

    Entries become whole numbers ``x = floor(scale * entry)``. The fit list has each distinct
    vector once: n vectors with sums S. ``deviation`` is the sum of (n * x - S)^2, ``whitened``
    the projection of x - S / n on the unit eigenvector over the root of its eigenvalue,
    ``explained`` the eigenvalue's share of the trace, ``identity_error`` the largest entry of
    the whitened covariance less the identity. Components go by falling eigenvalue; the largest
    entry of each is positive.

    Vectors that are null, empty or hold null or non-finite entries are left out; rows that repeat
    an id or a vector stay, and so do null ids. Vectors of different lengths have fit lists of their
    own. Equal eigenvalues have any orthonormal directions. A component without variance (one
    vector, or fewer distinct ones than components) has an explained share of zero, or null if
    there is no variance at all, and a null whitened value, and counts for no identity error. No
    rows give no rows; other columns play no part. Long vectors cost the driver the cube of their
    length, and never more with more rows. A deviation beyond 64 bits is an error, not a wrong number.
    """
    given = (rows.select(F.col(id).alias("id"), integers(F.col(vector), scale).alias("x"))
             .filter("x is not null and size(x) > 0"))
    fit = written(given.select("x").distinct(), "fit")
    models = {dim: Whitening.of(m, components) for dim, m in moments(fit).items()}
    errors = _errors(fit, models)
    kind = rows.schema[id].dataType.simpleString()
    out = given.mapInArrow(
        _rows(models, errors, ["id"]), f"id {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double")
    return out.withColumnRenamed("id", id)
