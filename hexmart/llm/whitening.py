"""Embedding whitening by shifted CholeskyQR: the components come from an R factor, never from a covariance matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmart.llm.vectors import finite, matrix, usual_length
from hexmart.session import materialize

SCALE, OFFSET = 1024, 100_000
MOST_PASSES = 8
# How far Q'Q may be from a projector when the passes end.
ORTHOGONAL = 1e-11
# A component whose singular value is below this share of the largest is rounding noise of dependent dimensions.
NOISE = 1e-12
CHUNK = 1 << 14


@dataclass
class Whitening:
    """A fit: n rows with the sums ``total`` per dimension, components as columns, eigenvalues falling, their shares of the trace."""

    n: int
    total: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    passes: int = 0
    identity_error: float = field(default=0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - total / n with one rounding: the numerator is an exact integer."""
        return (x * self.n - self.total) / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def solve_upper(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q r = y for an upper triangular r, by substitution over the columns."""
    q = np.empty_like(y)
    for j in range(r.shape[0]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def integers(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x array<bigint>): x = floor(scale * c) + offset for the rows that take part."""
    valid = vectors.where(finite(F.col("embedding"))).select("vec_id", "embedding")
    width = usual_length(valid)
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + offset)
    return valid.where(F.size("embedding") == width).select("vec_id", x.alias("x"))


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.column("x")[a : a + CHUNK]
            yield matrix(part, width, np.int64)


def _sums(x: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Rows and exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for part in _chunks(batches, width):
            n, total = n + len(part), total + part.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(-1, width, dtype=np.int32), "v": np.append(n, total).astype(np.int64)})

    found = {r.dim: r.v for r in x.mapInArrow(add, "dim int, v bigint").groupBy("dim").agg(F.sum("v").alias("v")).collect()}
    return found.get(-1, 0), np.array([found.get(j, 0) for j in range(width)], np.int64)


def _gram(x: DataFrame, width: int, out: int, rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of q'q for q = rows(x). A task sends its half of one matrix, Spark adds them entry by entry."""
    i, j = np.triu_indices(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out, out))
        for part in _chunks(batches, width):
            q = rows(part)
            total += q.T @ q
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    gram = np.zeros((out, out))
    for r in x.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        gram[r.i, r.j] = gram[r.j, r.i] = r.v
    return gram


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper triangular factor of gram + shift * I; the shift grows until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift, np.finfo(float).eps * np.trace(gram)) * 10


def fit(x: DataFrame, components: int = 8) -> Whitening:
    """Components of the stored rows ``x`` (see ``integers``), which is read once for each pass.

    The centred rows A are never multiplied into a covariance that is then decomposed, as that squares the condition number.
    A pass adds up the Gram matrix of Q = A R1^-1 R2^-1 ... (triangular solves on the rows of a task), whose Cholesky factor is the
    next R. The first is shifted so that it exists however ill-conditioned A is. Once Q'Q is a projector to rounding, A = Q R with
    R the product of all factors, and the SVD of R, taken times the root of the last Q'Q, gives eigenvectors and eigenvalues.
    Dependent or constant dimensions leave a null space, on which the projector is 0.

    The driver holds matrices of the vectors' length only.
    """
    found = x.agg(F.max(F.size("x")).alias("d"), F.max(F.greatest(F.array_max("x"), -F.array_min("x"))).alias("reach"), F.count(F.lit(1)).alias("n")).first()
    width = found["d"] or 0
    if (found["reach"] or 0) * found["n"] >= 1 << 62:
        raise OverflowError("entries times rows exceed a bigint; use a smaller scale")
    n, total = _sums(x, width) if width else (0, np.zeros(0, np.int64))
    model = Whitening(n, total, np.zeros((width, 0)), np.zeros(0), np.zeros(0))
    if not n:
        return model
    factors: list[np.ndarray] = []

    def orthogonal(part: np.ndarray) -> np.ndarray:
        q = model.centred(part)
        for r in factors:
            q = solve_upper(q, r)
        return q

    eps = np.finfo(float).eps
    while True:
        gram = _gram(x, width, width, orthogonal)
        model.passes += 1
        if not np.trace(gram):
            return model
        if factors and np.abs(gram @ gram - gram).max() <= ORTHOGONAL or model.passes >= MOST_PASSES:
            break
        bound = 11 * (min(n, CHUNK) * width + width * (width + 1)) * eps * np.trace(gram)
        factors.append(_cholesky(gram, 0.0 if factors else bound))
    values, vectors = np.linalg.eigh(gram)
    r = vectors * np.sqrt(np.maximum(values, 0)) @ vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, sigma, v = np.linalg.svd(r)
    keep = min(components, int((sigma > NOISE * sigma[0]).sum()))
    model.components, model.eigenvalues = v[:keep].T.copy(), sigma[:keep] ** 2 / n
    model.explained = sigma[:keep] ** 2 / (sigma**2).sum()
    model.identity_error = float(np.abs(_gram(x, width, keep, model.apply) / n - np.eye(keep)).max())
    return model


def _deviations(numerators: np.ndarray) -> list[int]:
    """Exact sums of squares of each row of integers, of any size."""
    widest = int(np.abs(numerators).max(initial=0))
    if widest * widest * max(1, numerators.shape[1]) < 1 << 63:
        return (numerators * numerators).sum(axis=1).tolist()
    high, low = numerators >> 24, numerators & ((1 << 24) - 1)
    if int(np.abs(high).max(initial=0)) ** 2 * max(1, numerators.shape[1]) >= 1 << 63:
        return [sum(v * v for v in row) for row in numerators.tolist()]
    parts = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
    return [(a << 48) + (b << 25) + c for a, b, c in zip(*(p.tolist() for p in parts))]


def whiten(vectors: DataFrame, components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error: a row per vector and component.

    Rows whose vector is null or holds null or non-finite entries take no part. Each entry c becomes floor(scale * c) + offset,
    an exact integer; ``fit`` describes the components, numbered from 1 by falling eigenvalue. ``whitened`` is the centred row
    on the component over the root of its eigenvalue, ``deviation`` the exact sum over dimensions of (n * x - sum)^2,
    ``identity_error`` the largest absolute entry of the covariance of ``whitened`` minus the identity, measured by one more pass.

    Repeated rows and ids, and null ids, are rows like any other. Dimensions that are constant or depend on others give fewer
    components than dimensions; equal eigenvalues take any basis of their space, the same for all rows. Vectors of another length than
    most (the longer on a tie) have no place in the fit and are left out. No rows, one row, equal rows only, or vectors
    without entries have no component and give no rows. Entries of which scale * c is no bigint raise an error. Other columns are ignored.
    """
    x = materialize(integers(vectors, scale, offset), "whitening")
    model = fit(x, components)
    width, keep, id_type = len(model.total), len(model.eigenvalues), vectors.schema["vec_id"].dataType.simpleString()

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows if keep else 0, CHUNK):
                part = batch.slice(a, CHUNK)
                rows = matrix(part.column("x"), width, np.int64)
                deviation = np.repeat(np.array(_deviations(rows * model.n - model.total), object), keep)
                m = len(rows)
                constant = lambda v: np.full(m * keep, v)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), keep))), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), m)),
                    pa.array(constant(model.n).astype(np.int64)), pa.array(deviation.tolist(), pa.decimal128(38, 0)), pa.array(model.apply(rows).ravel()),
                    pa.array(np.tile(model.explained, m)), pa.array(constant(model.identity_error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(out, f"vec_id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
