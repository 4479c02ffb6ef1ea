"""Whitening of embeddings by shifted Cholesky QR.

The centred rows X of the distinct vectors stay on the executors. A pass sends home one
Gram matrix; its (shifted) Cholesky factor makes the columns of X more orthogonal, and
after a few passes X = Q R with orthonormal Q. The right singular vectors of the small R
are those of X, so they are never taken from a squared, badly conditioned covariance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, arrow_stream, discard, stage
from meseta.llm.registry import query, table

SCALE, OFFSET = 64, 1_000_000
_LARGEST = 1 << 52
_EPS = np.finfo(float).eps
_FAN = 16
"""Partial matrices that reach the driver at most; more are added up on executors."""


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows whose vector has finite entries only: x = floor(64 c) + 1000000.

    Vectors of another length than the most frequent one (the longer of equally frequent
    ones) and empty vectors are left out too. Entries beyond 2**46 count as that.
    """
    wide = F.transform(vector_col, lambda c: c.cast("double"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col), wide.alias("c")).where(F.col("c").isNotNull() & finite & (F.size("c") > 0))
    length = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    whole = F.transform("c", lambda c: F.floor(
        F.greatest(F.least(c * SCALE, F.lit(float(_LARGEST))), F.lit(-float(_LARGEST)))) + F.lit(OFFSET).cast("long"))
    return rows.where(F.size("c") == (length["d"] if length else 0)).select(id_col, whole.alias("x"))


def matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    """The list column as rows of one array."""
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums of each dimension; halves keep the partial sums inside 64 bits."""

    def add(batch: pa.RecordBatch) -> Iterator[dict]:
        x = matrix(batch)
        yield {"n": [batch.num_rows], "high": [(x >> 26).sum(0)], "low": [(x & ((1 << 26) - 1)).sum(0)]}

    parts = arrow_map(fit, add, "n long, high array<long>, low array<long>")
    total = parts.agg(F.sum("n")).first()[0] or 0
    cells = parts.select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "cell"))
    rows = cells.groupBy("at").agg(
        F.sum(F.col("cell.high").cast("decimal(38,0)")).alias("high"), F.sum("cell.low").alias("low")).collect()
    return total, [(int(row["high"]) << 26) + row["low"] for row in sorted(rows, key=lambda row: row["at"])]


def times(x: np.ndarray, n: int) -> np.ndarray:
    """n x, as 64-bit numbers where they fit and as Python's otherwise."""
    largest = int(np.abs(x).max(initial=0))
    return x * n if largest * n < 1 << 62 else x.astype(object) * n


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, from exact differences."""
    wide = max(map(abs, sums), default=0) >= 1 << 62
    return np.asarray(times(x, n) - np.array(sums, object if wide else np.int64), float) / n


def deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)**2 of each row, exact; null beyond 64 bits."""
    wide = max(map(abs, sums), default=0) >= 1 << 62
    off = times(x, n) - np.array(sums, object if wide else np.int64)
    if off.size and int(abs(off).max()) ** 2 * off.shape[1] < 1 << 62:
        return (off.astype(np.int64) ** 2).sum(1).tolist()
    exact = [sum(int(c) ** 2 for c in row) for row in off]
    return [value if value < 1 << 63 else None for value in exact]


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Y with Y U = rows for an upper triangular U."""
    out = np.empty_like(rows)
    for k in range(rows.shape[1]):
        out[:, k] = (rows[:, k] - out[:, :k] @ upper[:k, k]) / upper[k, k]
    return out


def gram(fit: DataFrame, rows_of, size: int) -> np.ndarray:
    """Y'Y for Y = rows_of(x), summed in tasks, then over at most 16 groups of tasks, then here."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = rows_of(matrix(batch))
                total += y.T @ y
        yield {"part": [total.tobytes()]}

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((size, size))
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part).reshape(size, size)
        yield {"part": [total.tobytes()]}

    parts = arrow_stream(fit, partial, "part binary").repartition(_FAN)
    total = np.zeros((size, size))
    for row in arrow_stream(parts, added, "part binary").toLocalIterator():
        total += np.frombuffer(row["part"]).reshape(size, size)
    return (total + total.T) / 2


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular F with F'F = g + shift I; the shift grows until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _EPS * np.trace(g), np.finfo(float).tiny)


def _root(g: np.ndarray) -> np.ndarray:
    """F with F'F = g, also where g is singular."""
    values, vectors = np.linalg.eigh(g)
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


@dataclass(frozen=True)
class Whitening:
    n: int  # distinct vectors
    sums: list[int]
    components: np.ndarray  # one unit row for each component, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int

    def rows(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components.T / np.sqrt(self.eigenvalues)


def fit_whitening(numbers: DataFrame, components: int = 16, passes: int = 6) -> Whitening:
    """Components of the distinct vectors ``x`` of ``numbers``.

    Directions without variance (relative to the largest below 1e-20) are no components, so
    there may be fewer than asked for; without vectors, or with one alone, there are none.
    The driver holds matrices of dimension by dimension only.
    """
    distinct = stage(numbers.select("x").distinct(), "distinct-vectors")
    n, sums = _sums(distinct)
    d = len(sums)
    if n < 2:
        return Whitening(n, sums, np.zeros((0, d)), np.zeros(0), np.zeros(0), 0.0, 0)
    squares = gram(distinct, lambda x: centred(x, n, sums), d)
    trace = np.trace(squares)
    varied = np.flatnonzero(np.diag(squares) > 0)
    g, r, done = squares[np.ix_(varied, varied)], np.eye(len(varied)), 1
    # the shift of the first pass is that of the published method; X = Q R holds for any shift
    r = _factor(g, 11 * (n * d + d * (d + 1)) * _EPS / 2 * trace)
    while done < passes and len(varied):
        total = r
        g = gram(distinct, lambda x: solved(centred(x, n, sums)[:, varied], total), len(varied))
        done += 1
        orthogonal = np.abs(g - np.eye(len(g))).max() < 1e-8
        if orthogonal or done == passes:
            r = _root(g) @ r
            break
        r = _factor(g, 0.0) @ r
    _, singular, right = np.linalg.svd(r)
    values = singular ** 2 / n
    count = min(components, int((values > 1e-20 * values.max(initial=0)).sum()))
    loadings = np.zeros((count, d))
    loadings[:, varied] = right[:count]
    model = Whitening(n, sums, loadings, values[:count], values[:count] * n / trace if count else values[:0], 0.0, done)
    error = 0.0
    if count:
        error = float(np.abs(gram(distinct, model.rows, count) / n - np.eye(count)).max())
    discard(distinct)
    return Whitening(n, sums, model.components, model.eigenvalues, model.explained, error, done)


def whiten(numbers: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """One row for each row of ``numbers`` and component: id, component, n, deviation, whitened, explained, identity_error."""
    count = len(model.eigenvalues)

    def project(batch: pa.RecordBatch) -> Iterator[dict]:
        for start in range(0, batch.num_rows if count else 0, 2_000):
            part = batch.slice(start, 2_000)
            x, rows = matrix(part), part.num_rows
            each = np.repeat(np.arange(rows), count)
            yield {
                id_col: part.column(id_col).take(pa.array(each)),
                "component": np.tile(np.arange(1, count + 1), rows), "n": np.full(rows * count, model.n),
                "deviation": pa.array(deviation(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                "whitened": model.rows(x).ravel(), "explained": np.tile(model.explained, rows),
                "identity_error": np.full(rows * count, model.identity_error)}

    kind = dict(numbers.dtypes)[id_col]
    return arrow_map(
        numbers, project, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    numbers = whole_numbers(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return whiten(numbers, fit_whitening(numbers), "vec_id")
