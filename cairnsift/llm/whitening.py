"""Whitening of embeddings by shifted Cholesky QR.

The centred rows A (n by d) are factored as A = Q R by rounds. A round is one distributed pass: each task takes its rows
through triangular solves with the factors so far and adds up a d by d Gram matrix; the sum G of all tasks is factored
as G + s I = R'R on the driver. The first round's shift s keeps a nearly singular Gram matrix positive definite; later
rounds need none, or a smaller one, since each brings the rows nearer to orthonormal. The factors composed are R, its
singular value decomposition R = U D W' gives the covariance A'A / n = W (D^2 / n) W': the columns of W are the
components and D^2 / n their eigenvalues. No Gram matrix of A itself is ever decomposed, so small eigenvalues keep
their digits.

Entries are put on an integer grid first, x = floor(64 c) + 1000000, so that sums are exact and centring loses nothing:
a task subtracts in integers, n x - S, and only then divides. What reaches the driver is d sums and d by d matrices,
whatever the number of rows; the dimension must leave room for some d by d matrices in a task.

Rows whose vector is null, or holds null, non-finite or out of range entries (64 c beyond 2^52), are dropped. Vectors of
another length than the most frequent one (of equally frequent ones the longest) are points of another space and are
dropped, too; the given tables have one length. Repeated rows and repeated or null ids count as they come. A direction
without variance has no whitened value: there are as many components as the rows have rank, 32 at most by default. An
empty table, one row, equal rows or empty vectors therefore give no rows. ``deviation`` is exact and
null where a long cannot hold it (it grows with the square of the number of rows). Other columns of the table are not
read, so their names are free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.session import stored

GRID, OFFSET = 64, 1_000_000
LARGEST = float(1 << 52) / GRID
LONGEST = float(1 << 63) * (1 - 1e-9)
UNIT = np.finfo(np.float64).eps / 2
ROUNDS = 8
SUMMED = 1 << 20  # rows that one chain of floating additions may hold, for the shift's error bound


def usable(vector: Column) -> Column:
    """Vectors without null, non-finite or out of range entries."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))


def grid(column: pa.Array, d: int) -> np.ndarray:
    """A batch of vectors of ``d`` entries as integers of the grid, one row each."""
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(GRID * entries).astype(np.int64).reshape(-1, d) + OFFSET


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q R = rows for an upper triangular R, by forward substitution over the columns."""
    q = np.empty_like(rows)
    for j in range(r.shape[0]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


@dataclass
class Centre:
    """What centring needs: number of rows, sums by dimension, and the dimensions that vary."""
    n: int
    sums: np.ndarray
    live: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def exact(self, x: np.ndarray) -> np.ndarray:
        return self.n * x - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.exact(x)[:, self.live]).astype(np.float64) / self.n


@dataclass
class Whitening:
    """A fitted transform. ``directions`` has one column per component, ``explained`` each one's share of the trace."""
    n: int
    sums: np.ndarray
    directions: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    rounds: int

    @property
    def size(self) -> int:
        return len(self.eigenvalues)

    def apply(self, x: np.ndarray) -> np.ndarray:
        rows = (self.n * x - self.sums).astype(np.float64) / self.n
        return rows @ self.directions / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """The exact squared distance of n x from S; null where it exceeds a long."""
        exact = self.n * x - self.sums
        about = (exact.astype(np.float64) ** 2).sum(axis=1)
        return pa.array((exact * exact).sum(axis=1), mask=about >= LONGEST)


def gram(vectors: DataFrame, d: int, width: int, rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Gram matrix of ``rows(x)`` over all batches x of the frame, added up per task and then by cell."""
    upper = np.triu_indices(width)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                q = rows(grid(batch.column(0), d))
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], ["i", "j", "v"])

    cells = vectors.mapInArrow(part, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((width, width))
    out[cells.i, cells.j] = cells.v
    return out + np.triu(out, 1).T


def centre(vectors: DataFrame) -> Centre | None:
    """Length of the vectors, number and exact sums, from one pass."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths[lengths > 0]):
                same = column.filter(pa.array(lengths == d))
                x = grid(same, int(d))
                entry = totals.setdefault(int(d), [0, np.zeros(d, np.int64), np.full(d, np.iinfo(np.int64).max), np.full(d, np.iinfo(np.int64).min)])
                entry[0] += len(x)
                entry[1] += x.sum(axis=0)
                entry[2], entry[3] = np.minimum(entry[2], x.min(axis=0)), np.maximum(entry[3], x.max(axis=0))
        for d, (n, s, low, high) in totals.items():
            whole = np.full(d, n, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), *map(pa.array, (whole, s, low, high))],
                                             ["d", "i", "n", "s", "low", "high"])

    parts = vectors.mapInArrow(part, "d int, i int, n long, s long, low long, high long")
    sums = stored(parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")))
    most = sums.where("i = 0").orderBy(F.desc("n"), F.desc("d")).select("d").head()
    if most is None:
        return None
    rows = sorted(sums.where(F.col("d") == most.d).collect(), key=lambda r: r.i)
    n = rows[0].n
    live = np.array([r.i for r in rows if r.low < r.high], np.int64)
    return Centre(n, np.array([r.s for r in rows], np.int64), live)


def factor(vectors: DataFrame, at: Centre) -> tuple[np.ndarray, int]:
    """R of the centred rows' QR factors, and the rounds it took."""
    d, width = len(at.sums), len(at.live)
    factors: list[np.ndarray] = []
    product = np.eye(width)
    for number in range(1, ROUNDS + 1):
        done = list(factors)

        def rows(x: np.ndarray) -> np.ndarray:
            q = at.rows(x)
            for r in done:
                q = solve_upper(q, r)
            return q

        g = gram(vectors, d, width, rows)
        values = np.linalg.eigvalsh(g)
        shift = 11 * (width * min(at.n, SUMMED) + width * (width + 1)) * UNIT * values[-1] if number == 1 or values[0] < 1e-3 else 0.0
        r = np.linalg.cholesky(g + shift * np.eye(width)).T
        factors.append(r)
        product = r @ product
        # Settled: this round found orthonormal rows, apart from directions that the rows do not have.
        near = np.abs(values - 1) < 1e-10
        if number > 2 and (near | ((values < 0.5) & (number > 4))).all():
            break
    return product, number


def fit(vectors: DataFrame, most: int = 32) -> Whitening | None:
    """The transform of the vectors in the first column; None where no direction varies."""
    at = centre(vectors)
    if at is None or not len(at.live):
        return None
    d = len(at.sums)
    same = vectors.where(F.size(vectors.columns[0]) == d)
    r, rounds = factor(same, at)
    _, singular, turned = np.linalg.svd(r)
    rank = int((singular > singular[0] * max(len(at.live), 64) * 4 * UNIT).sum())
    rank = min(rank, at.n - 1)
    k = min(most, rank)
    directions = np.zeros((d, k))
    directions[at.live] = turned[:k].T
    eigenvalues = singular ** 2 / at.n
    fitted = Whitening(at.n, at.sums, directions, eigenvalues[:k], eigenvalues[:k] / eigenvalues.sum(), 0.0, rounds)

    def rows(x: np.ndarray) -> np.ndarray:
        return np.hstack([fitted.apply(x), np.ones((len(x), 1))])

    check = gram(same, d, k + 1, rows) / at.n
    mean = check[:k, k]
    fitted.identity_error = float(np.abs(check[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())
    return fitted


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(frame: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", most: int = 32) -> DataFrame:
    """One row per usable vector and component: the id, then the columns of ``SCHEMA``."""
    kind = frame.schema[vec_id].dataType.simpleString()
    rows = frame.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    fitted = fit(rows.select("vector"), most)
    schema = f"vec_id {kind}, {SCHEMA}"
    if fitted is None:
        return frame.sparkSession.createDataFrame([], schema)
    d, k = len(fitted.sums), fitted.size

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = grid(batch.column(1), d)
            n = len(x)
            rows_of = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(rows_of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, fitted.n)),
                fitted.deviation(x).take(rows_of), pa.array(fitted.apply(x).ravel()),
                pa.array(np.tile(fitted.explained, n)), pa.array(np.full(n * k, fitted.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("vector") == d).mapInArrow(spread, schema)
