"""Embedding whitening by shifted CholeskyQR.

The centred rows A of the vectors' integer components are factored as A = Q R without ever holding Q: a pass over the
table sums the Gram matrix of A solved by the triangles found so far, its Cholesky factor is the next triangle, and the
triangles multiplied are R. The first triangle is of the Gram matrix with a shift, so that it exists for badly
conditioned rows too; later passes bring what is left to orthogonal columns, which a Gram matrix alone cannot do. The
singular values and right vectors of R, which is as small as the vectors are wide, are those of A.

Rows are centred exactly: with sums S of n rows a component is ``(n * x - S) / n``, worked out in integers before the
one division. Each pass adds up a matrix as wide as the vectors in every task and sums the tasks' matrices by position,
so what reaches the driver is bounded by the width alone.

Defined cases: vectors that are null or hold null or non-finite entries take no part. A shorter vector is as if it
ended in zeros. Rows with equal ids are rows of their own, null ids are kept. Directions without variance (fewer rows
than dimensions, repeated or constant dimensions) have no component, so there may be fewer components than asked for;
rows that are all equal, or a single one, give none and so no rows. Components of equal variance are any orthonormal
ones of their space. An entry beyond 2^46 once scaled counts as 2^46; a ``deviation`` beyond a long is null. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import slices
from loomstat.llm.vectors import integer_rows, widen

# Passes at most; two after the shifted one do unless the rows are nearly or wholly dependent.
PASSES = 6
# Singular values below this share of the largest are no components.
NOTHING = 1e-13
EPS = np.finfo(np.float64).eps
# Vectors of one output batch.
ROWS = 2048


@dataclass(frozen=True)
class Fit:
    """Counts, sums and triangles of a table, then its components: columns of ``vectors`` with their variances."""

    scale: float
    offset: int
    n: int
    sums: tuple[int, ...]
    triangles: tuple[np.ndarray, ...] = ()
    vectors: np.ndarray | None = None
    variances: np.ndarray | None = None
    total: float = 0.0

    def centred(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
        """Positions of usable vectors, their centred rows, and the exact sums of ``(n * x - S)^2``."""
        keep, x = integer_rows(column, self.scale)
        x = widen(x, len(self.sums)) + self.offset
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        near = x - whole
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if most * most * max(len(self.sums), 1) < 1 << 63:
            off = self.n * near - rest
            return keep, off / self.n, (off * off).sum(axis=1).tolist()
        off = self.n * near.astype(object) - rest.astype(object)
        exact = [int(s) for s in (off * off).sum(axis=1)]
        return keep, near - rest / self.n, [s if s < 1 << 63 else None for s in exact]


def solve_right(rows: np.ndarray, triangle: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper ``triangle``, by substitution column after column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ triangle[:j, j]) / triangle[j, j]
    return out


def _summed(rows: DataFrame, work: Callable[[pa.Array], np.ndarray], size: int) -> np.ndarray:
    """The sum over the table of what ``work`` gives for a batch of vectors, ``size`` doubles: a partial sum per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in slices(batches, ROWS):
            total += work(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int64)), pa.array(total)], names=["at", "part"])

    sums = rows.mapInArrow(run, "at bigint, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    out = np.zeros(size)
    for row in sums:
        out[row["at"]] = row["part"]
    return out


def _counts(rows: DataFrame, scale: float, offset: int) -> Fit | None:
    """How many usable vectors there are, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            keep, x = integer_rows(batch.column(0), scale)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, x.shape[1], dtype=np.int64)), pa.array(np.concatenate([[len(keep)], x.sum(axis=0)]).astype(np.int64))],
                names=["at", "part"],
            )

    found = rows.mapInArrow(run, "at bigint, part bigint").groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    totals = {row["at"]: int(row["part"]) for row in found.collect()}
    n = totals.pop(-1, 0)
    return Fit(scale, offset, n, tuple(totals[j] + n * offset for j in range(len(totals)))) if n else None


def _orthogonal(rows: DataFrame, fit: Fit) -> np.ndarray:
    """The Gram matrix of the centred rows solved by the triangles so far."""
    width = len(fit.sums)

    def work(column: pa.Array) -> np.ndarray:
        part = fit.centred(column)[1]
        for triangle in fit.triangles:
            part = solve_right(part, triangle)
        return (part.T @ part).ravel()

    gram = _summed(rows, work, width * width).reshape(width, width)
    return (gram + gram.T) / 2


def _with(fit: Fit, **changes) -> Fit:
    return Fit(**{**fit.__dict__, **changes})


def fit_components(vectors: DataFrame, *, scale: float = 64.0, offset: int = 0, vector_col: str = "embedding") -> Fit | None:
    """The components of all usable vectors, by falling variance; None where there is no usable vector."""
    rows = vectors.select(F.col(vector_col).alias("v"))
    fit = _counts(rows, scale, offset)
    if fit is None or not fit.sums:
        return fit
    width, last = len(fit.sums), None
    for step in range(PASSES):
        gram = _orthogonal(rows, fit)
        if step == 0:
            fit = _with(fit, total=float(np.trace(gram)) / fit.n)
        values, directions = np.linalg.eigh(gram)
        if fit.total <= 0:
            break
        if step and (np.all((values > 0.5) | (values < 1e-13)) or step == PASSES - 1):
            # columns are orthogonal, or nothing: the last triangle, without the directions that hold nothing
            last = np.sqrt(np.where(values < 1e-13, 0, values))[:, None] * directions.T
            break
        if step == 0 or values[0] < 1e-12:
            gram = gram + 11 * (fit.n * width + width * (width + 1)) * EPS * np.trace(gram) * np.eye(width)
        fit = _with(fit, triangles=(*fit.triangles, np.linalg.cholesky(gram).T))
    if last is None:
        return _with(fit, vectors=np.zeros((width, 0)), variances=np.zeros(0))
    whole = last
    for triangle in reversed(fit.triangles):
        whole = whole @ triangle
    _, singular, right = np.linalg.svd(whole)
    some = singular > NOTHING * singular[0]
    return _with(fit, vectors=right[some].T, variances=singular[some] ** 2 / fit.n)


def identity_error(vectors: DataFrame, fit: Fit, components: int, vector_col: str = "embedding") -> float:
    """The largest entry of the whitened rows' covariance minus the identity, in absolute value."""
    turn = fit.vectors[:, :components] / np.sqrt(fit.variances[:components])
    size = turn.shape[1]
    rows = vectors.select(F.col(vector_col).alias("v"))
    mean = _summed(rows, lambda column: (fit.centred(column)[1] @ turn).sum(axis=0), size) / fit.n

    def work(column: pa.Array) -> np.ndarray:
        white = fit.centred(column)[1] @ turn - mean
        return (white.T @ white).ravel()

    covariance = _summed(rows, work, size * size).reshape(size, size) / fit.n
    return float(np.abs(covariance - np.eye(size)).max(initial=0))


def whiten(
    vectors: DataFrame, *, components: int = 32, scale: float = 64.0, offset: int = 0, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per usable vector and component."""
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    names = [f.split()[0] for f in schema.split(", ")]
    fit = fit_components(vectors, scale=scale, offset=offset, vector_col=vector_col)
    if fit is None or fit.vectors is None or not fit.vectors.shape[1]:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, fit, components, vector_col)
    turn = fit.vectors[:, :components] / np.sqrt(fit.variances[:components])
    share, size = fit.variances[:components] / fit.total, turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            keep, off, deviation = fit.centred(batch.column(1))
            rows = len(keep)
            each = pa.array(np.repeat(np.arange(rows), size))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(keep)).take(each), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * size, fit.n)), pa.array(deviation, pa.int64()).take(each), pa.array((off @ turn).ravel()),
                pa.array(np.tile(share, rows)), pa.array(np.full(rows * size, error)),
            ], names=names)

    return vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, schema)
