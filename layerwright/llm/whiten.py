"""Embedding whitening by an incremental eigendecomposition.

Every partition keeps the eigenvalues and eigenvectors of the scatter of its vectors and adds rank-one terms to it: each term
moves the eigenvalues to the roots of a secular equation and turns the eigenvectors, after terms without weight and equal
eigenvalues have been deflated. A block of vectors is centred and reduced to at most d terms by an orthogonal transformation
first; the shift between two means is one more centred term. Spectra are combined in groups, each vector of one being a
rank-one term of the other, until one is left. It is the basis of a last pass over all vectors that projects the centred
vectors, adds up their products and rotates the basis to the eigenvectors of those (Rayleigh-Ritz); as the basis spans the
whole space, this is exact but for rounding. One more pass measures how far the whitened covariance is from the identity.

Entries are used as integers floor(1024 c) + 100000; n and the sums S are exact. What meets on the driver is n, S and one
d x d matrix, whatever the number of rows; a task holds BLOCK vectors and a few such matrices.

Rows whose vector is null, empty, or holds null or non-finite entries are left out. Vectors must have one length to share a
covariance: those of another length than the most frequent (of equally frequent ones, the longest) are left out too. Repeated
rows and repeated ids count as rows of their own, a null id stays null. Components without variance (at most 1e-12 of the
largest: fewer vectors than components, constant or dependent entries) cannot be scaled to one and are left out, so that a
single vector, or an empty table, gives no rows. Where eigenvalues are equal any basis of their space may come back, the same
for all rows. A deviation that no long holds is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import prepared

STEP, SHIFT = 1024, 100_000
COMPONENTS = 8
# vectors that a task reduces to rank-one terms at once, and spectra that a task combines
BLOCK, FAN = 4096, 32
# eigenvalues nearer than this share of the spectrum are taken as equal, weights below it as zero
TINY = 8 * np.finfo(float).eps
FLAT = 1e-12
SPECTRUM = "n long, mean array<double>, values array<double>, vectors array<double>"


@dataclass
class Spectrum:
    """Number and mean of vectors, and the eigenvalues (rising) and eigenvectors (columns) of their scatter about the mean."""
    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add_rows(self, rows: np.ndarray) -> None:
        """Add a block of vectors: centred, reduced to at most d terms by an orthogonal transformation."""
        mean = rows.mean(axis=0)
        centred = rows - mean
        terms = np.linalg.qr(centred, mode="r") if len(rows) > len(mean) else centred
        self.add(len(rows), mean, terms)

    def merge(self, other: Spectrum) -> None:
        self.add(other.n, other.mean, np.sqrt(np.maximum(other.values, 0))[:, None] * other.vectors.T)

    def add(self, n: int, mean: np.ndarray, terms: np.ndarray) -> None:
        """Add n vectors with this mean whose scatter is the sum of the squared terms."""
        if not n:
            return
        if self.n:
            terms = np.vstack([terms, np.sqrt(self.n * n / (self.n + n)) * (mean - self.mean)])
        for term in terms:
            self.values, self.vectors = rank_one(self.values, self.vectors, term)
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n


def rank_one(values: np.ndarray, vectors: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of  vectors diag(values) vectors' + term term'."""
    weight = float(term @ term)
    size = max(float(values[-1]), 0.0) + weight
    if not weight > 0 or not np.isfinite(size):
        return values, vectors
    z = vectors.T @ term / np.sqrt(weight)
    # equal eigenvalues: turn their vectors so that one of them takes the weight of both
    vectors = vectors.copy()
    for i in np.flatnonzero(np.diff(values) <= TINY * size):
        if (norm := np.hypot(z[i], z[i + 1])) > 0:
            turn = np.array([[z[i + 1], z[i]], [-z[i], z[i + 1]]]) / norm
            vectors[:, i:i + 2] = vectors[:, i:i + 2] @ turn
            z[i], z[i + 1] = 0.0, norm
    live = np.flatnonzero(np.abs(z) * (weight / size) > TINY)
    if not len(live):
        return values, vectors
    poles, part = values[live], z[live]
    apart, roots = secular(poles, part * part, weight)
    # weights for which these roots are exact: the vectors built from them are orthogonal to working precision
    ratio = -apart / np.where(np.eye(len(live), dtype=bool), 1.0, poles[None, :] - poles[:, None])
    part = np.sign(part) * np.sqrt(np.abs(np.prod(ratio, axis=1)) / weight)
    turn = part[:, None] / apart
    turn /= np.sqrt((turn * turn).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live], new_vectors[:, live] = roots, vectors[:, live] @ turn
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def secular(poles: np.ndarray, squares: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + weight * sum(squares / (poles - x)), one right of each pole, all at once.

    Returns the distances poles[j] - root[i] as a matrix, exact near the poles, and the roots. Each root is sought as an offset
    from its nearer pole, by steps of the interpolation with two poles that stay inside a shrinking bracket.
    """
    m = len(poles)
    right = np.append(poles[1:], poles[-1] + weight * squares.sum())
    gap = right - poles
    middle = poles + gap / 2
    at_middle = 1 + weight * (squares[:, None] / (poles[:, None] - middle[None, :])).sum(axis=0)
    low = (at_middle >= 0) | (np.arange(m) == m - 1)
    base = np.where(low, poles, right)
    delta = poles[:, None] - base[None, :]
    upper = np.tri(m, k=0, dtype=bool).T  # poles up to the root's own
    lo = np.where(low, 0.0, -gap)
    hi = np.where(low, gap, 0.0)
    # what is known of the middle halves the bracket
    lo = np.where(low & (at_middle < 0), gap / 2, lo)
    hi = np.where(low & (at_middle >= 0), gap / 2, hi)
    lo = np.where(~low, -gap / 2, lo)
    x = (lo + hi) / 2
    left_pole, right_pole = poles - base, right - base
    for _ in range(60):
        away = delta - x
        share = weight * squares[:, None] / away
        value = 1 + share.sum(axis=0)
        slope = share / away
        psi, phi = np.where(upper, slope, 0).sum(axis=0), np.where(upper, 0, slope).sum(axis=0)
        lo, hi = np.where(value < 0, x, lo), np.where(value >= 0, x, hi)
        p, q = left_pole - x, right_pole - x
        a, b, c = (p + q) * value - p * q * (psi + phi), p * q * value, value - p * psi - q * phi
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
            new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        # a value that is all rounding cannot bring the root any nearer
        done = (np.abs(value) <= TINY * (1 + np.abs(share).sum(axis=0))) | (np.abs(new - x) <= TINY * np.abs(new))
        x = np.where(done, x, new)
        if done.all():
            break
    away = delta - x
    # no distance may be zero: a root that rounds to its pole lies one step beside it
    away[np.arange(m), np.arange(m)] = np.minimum(away[np.arange(m), np.arange(m)], -np.finfo(float).tiny)
    return away, base + x


def usable(vector: Column) -> Column:
    """TRUE for vectors that are not null, not empty and hold finite entries only."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def _integers(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return np.floor(flat * STEP).astype(np.int64) + SHIFT


@dataclass
class Model:
    """What whitens vectors: their number, sums and most frequent length, components as columns, eigenvalues, error, trace."""
    n: int
    sums: np.ndarray
    size: int
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(df: DataFrame, vector: str) -> Model | None:
    """Components of all usable vectors of a frame; None where there are none."""
    prepared(df.sparkSession)
    vectors = df.select(F.col(vector).alias("v")).filter(usable(F.col("v")))
    lengths = vectors.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return None
    size = lengths["size"]
    vectors = session.spread(vectors.filter(F.size("v") == size))
    spectrum = _spectrum(vectors, size)
    n, sums = _sums(vectors, size)
    # Rayleigh-Ritz in the whole space: the covariance in the combined basis, from the centred vectors, then its eigenvectors
    basis = spectrum.vectors
    values, turn = np.linalg.eigh(_products(vectors, size, n, sums, basis))
    order = np.argsort(-values, kind="stable")
    values, basis = values[order], basis @ turn[:, order]
    basis /= np.sqrt((basis * basis).sum(axis=0))
    trace = float(np.maximum(values, 0).sum())
    kept = values[:COMPONENTS] > FLAT * max(float(values[0]), 0.0) if values[0] > 0 else np.zeros(0, bool)
    k = int(kept.sum())
    error = 0.0
    if k:
        scaled = basis[:, :k] / np.sqrt(values[:k])
        error = float(np.abs(_products(vectors, size, n, sums, scaled) - np.eye(k)).max())
    return Model(n, sums, size, basis[:, :k], values[:k], trace, error)


def whiten(df: DataFrame, model: Model | None, key: str, vector: str) -> DataFrame:
    """A row for each usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    prepared(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    size, n, sums, k = model.size, model.n, model.sums, len(model.values)
    scaled, shares, error = model.vectors / np.sqrt(model.values), model.values / model.trace, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if m := batch.num_rows:
                x = _integers(batch.column(1), size)
                white = _centred(x, n, sums) @ scaled
                rows = np.repeat(np.arange(m), k)
                deviation = pa.array([_deviation(row, n, sums) for row in x], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    deviation.take(pa.array(rows)), pa.array(white.ravel()), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    names=[key, *names])

    rows = df.select(F.col(key), F.col(vector).alias("v")).filter(usable(F.col("v")) & (F.size("v") == size))
    return session.spread(rows).mapInArrow(run, schema)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, without losing the digits that both share."""
    whole = sums // n
    return (x - whole).astype(float) - (sums - whole * n) / n


def _deviation(row: np.ndarray, n: int, sums: np.ndarray) -> int | None:
    far = [n * int(x) - int(s) for x, s in zip(row, sums, strict=True)]
    total = sum(f * f for f in far)
    return total if total < 2**63 else None


def _spectrum(vectors: DataFrame, size: int) -> Spectrum:
    """One spectrum of all vectors: one for each task first, then combined FAN at a time."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, count = Spectrum.empty(size), [], 0
        for batch in batches:
            held.append(_integers(batch.column(0), size))
            count += batch.num_rows
            if count >= BLOCK:
                own.add_rows(np.concatenate(held).astype(float))
                held, count = [], 0
        if count:
            own.add_rows(np.concatenate(held).astype(float))
        if own.n:
            yield _row(own)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(size)
        for batch in batches:
            for row in batch.to_pylist():
                own.merge(_read(row, size))
        if own.n:
            yield _row(own)

    parts, tasks = vectors.mapInArrow(learn, SPECTRUM), vectors.rdd.getNumPartitions()
    while True:
        tasks = -(-tasks // FAN)
        parts = session.staged(parts.repartition(tasks).mapInArrow(combine, SPECTRUM), "spectra")
        if tasks == 1:
            return _read(parts.first().asDict(), size)


def _row(s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s.n]), pa.array([s.mean]), pa.array([s.values]), pa.array([s.vectors.ravel()])],
                                      names=["n", "mean", "values", "vectors"])


def _read(row: dict, size: int) -> Spectrum:
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["values"]), np.array(row["vectors"]).reshape(size, size))


def _sums(vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums of their entries."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            n, total = n + batch.num_rows, total + _integers(batch.column(0), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])

    parts = vectors.mapInArrow(add, "n long, total array<long>")
    row = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)]).first()
    return row["n"], np.array([row[f"s{i}"] for i in range(size)], np.int64)


def _products(vectors: DataFrame, size: int, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the centred vectors in a basis: partial products for each task, added up by place."""
    k = basis.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            y = _centred(_integers(batch.column(0), size), n, sums) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["total"])

    parts = vectors.mapInArrow(multiply, "total array<double>").select(F.posexplode("total").alias("at", "part"))
    out = np.zeros(k * k)
    for row in parts.groupBy("at").agg(F.sum("part").alias("part")).collect():  # k * k numbers
        out[row["at"]] = row["part"]
    out = out.reshape(k, k) / n
    return (out + out.T) / 2
