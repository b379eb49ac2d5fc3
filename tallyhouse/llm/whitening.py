"""Whitening of embeddings by shifted CholeskyQR.

Rows are centred and then orthogonalised in passes: a pass sums the Gram matrix of the
rows over all tasks, factors it (with a small shift where it is nearly singular) and
solves every row against the factor. After two or three passes the rows are orthonormal
to the last digits; the factors multiplied give R of the centred table, and the singular
values and right vectors of R are those of the table. Only one d x d matrix a pass
leaves the tasks. Squaring the condition number, as one covariance matrix does, is
avoided: what a pass loses is made up by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
PASSES = 8  # three or four do for any table of full rank; the rest is for those without
CLOSE = 1e-12  # how near to orthonormal is near enough
PARTS = 32  # tasks that add up the partial sums of all others
_LARGEST = 2.0**62


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, stored.

    Rows go whose vector is null, empty, or holds an entry that is null, not finite or,
    times 64, beyond a long. Of vectors of several lengths the most frequent length
    stays (of equally frequent ones the longest).
    """
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    good = good.filter(
        F.col("vector").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda c: F.coalesce(F.abs(c * SCALE) < F.lit(_LARGEST), F.lit(False)))
    )
    good = stored(good, "vectors")
    length = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.filter(F.size("vector") == (length["d"] if length else 0))


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, row by row."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, d) + OFFSET


def _added(rows: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``partial`` over all batches, added in tasks, then in few, then in one."""

    def add_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                here = partial(batch)
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column("sums"):
                here = np.frombuffer(cell.as_buffer(), dtype=np.float64)
                total = here.copy() if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    first = rows.mapInArrow(add_batches, "sums binary").repartition(PARTS)
    row = first.mapInArrow(add_sums, "sums binary").repartition(1).mapInArrow(add_sums, "sums binary").first()
    return np.zeros(size) if row is None else np.frombuffer(row["sums"], dtype=np.float64)


def _totals(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of every dimension.

    Tasks add the upper and the lower halves of the numbers apart, which overflows
    neither; per task one row for each dimension is left, which Spark adds as decimals.
    """

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, upper, lower = 0, [0] * d, [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch, d)
                n += len(x)
                upper = [a + int(b) for a, b in zip(upper, (x >> 31).sum(axis=0))]
                lower = [a + int(b) for a, b in zip(lower, (x & (2**31 - 1)).sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(upper, pa.int64()), pa.array(lower, pa.int64())],
                names=["dimension", "n", "upper", "lower"],
            )

    wide = "decimal(38,0)"
    sums = (
        rows.mapInArrow(halves, "dimension int, n long, upper long, lower long")
        .groupBy("dimension")
        .agg(F.sum("n").alias("n"), F.sum(F.col("upper").cast(wide)).alias("upper"), F.sum(F.col("lower").cast(wide)).alias("lower"))
        .orderBy("dimension")
        .collect()  # one row per dimension
    )
    return (sums[0]["n"] if sums else 0), [int(r["upper"]) * 2**31 + int(r["lower"]) for r in sums]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: in 64 bits where it surely fits, else in unbounded numbers."""
    peak = max(int(np.abs(x).max()) * n, max(abs(s) for s in sums))
    if peak < 2**61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None where it is beyond a long."""
    if deviations.dtype == np.int64:
        peak = int(np.abs(deviations).max(initial=0))
        if peak * peak * deviations.shape[1] < 2**63:
            return (deviations * deviations).sum(axis=1).tolist()
    sums = (deviations.astype(object) ** 2).sum(axis=1).tolist()
    return [int(v) if v < 2**63 else None for v in sums]


@dataclass(frozen=True)
class Whitening:
    """What whitens a table: ``vectors`` (d x k, unit columns), their eigenvalues, and the table's figures."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _deviations(x, self.n, self.sums).astype(np.float64) / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """The upper Cholesky factor; the first is shifted, so that no table is too singular for it.

    The shift bounds the rounding of the Gram matrix. It leaves the rows less than
    orthonormal, which the passes after it mend; a later factor needs one only where
    the table has directions without extent.
    """
    d, norm, unit = len(gram), np.linalg.norm(gram, 2), np.finfo(np.float64).eps / 2
    safe = min(11 * (n * d + d * (d + 1)) * unit, 1e-6) * norm
    shift = safe if first else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = 10 * shift or d * unit * norm


def _solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a times the inverse of the upper triangle r, column after column."""
    out = np.empty_like(a)
    for j in range(len(r)):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening components of the rows of ``usable``; None where nothing varies.

    Components are numbered by falling eigenvalue; each has its largest entry positive,
    so reruns agree. Those whose singular value vanishes against the first one (to
    working precision) do not exist: there is nothing to be whitened along them.
    """
    sample = rows.select(F.size("vector").alias("d")).first()
    if sample is None:
        return None
    d = sample["d"]
    n, sums = _totals(rows, d)
    moves: list[np.ndarray] = []  # each a d x d' matrix rows are multiplied by
    r_whole, trace = np.eye(d), None

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        a = _deviations(_whole(batch, d), n, sums).astype(np.float64) / n
        for move in moves:
            # A triangular factor is solved against; anything else is a change of basis.
            a = _solved(a, move) if move.shape[0] == move.shape[1] else a @ move
        return (a.T @ a).ravel()

    for done in range(1, PASSES + 1):
        size = moves[-1].shape[1] if moves else d
        matrix = _added(rows, gram, size * size).reshape(size, size)
        if trace is None:
            trace = float(np.trace(matrix)) / n
            # Dimensions that never vary are exactly zero and leave at once.
            varying = np.flatnonzero(np.diagonal(matrix) > 0)
            if not len(varying):
                return None
            if len(varying) < d:
                basis = np.eye(d)[:, varying]
                moves.append(basis)
                r_whole, matrix = basis.T, matrix[np.ix_(varying, varying)]
        else:
            values, basis = np.linalg.eigh(matrix)
            kept = values > 1e-10 * values[-1]
            if not kept.all():
                # What is still nothing after a pass was rounding: it is no direction of the table.
                moves.append(basis[:, kept])
                r_whole, matrix = basis[:, kept].T @ r_whole, np.diag(values[kept])
            elif np.abs(matrix - np.eye(size)).max() < CLOSE * max(1.0, np.sqrt(size)):
                break
        r = _factor(matrix, n, first=done == 1)
        moves.append(r)
        r_whole = r @ r_whole
    _, singular, right = np.linalg.svd(r_whole, full_matrices=False)
    real = singular > max(n, d) * np.finfo(np.float64).eps * singular[0]
    k = min(components, int(real.sum()))
    vectors = right[:k].T
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return Whitening(n, sums, vectors, singular[:k] ** 2 / n, trace, done)


def identity_error(rows: DataFrame, found: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""
    d, k = found.vectors.shape

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w = found.apply(_whole(batch, d))
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = _added(rows, moments, k + k * k) / found.n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, found: Whitening) -> DataFrame:
    """Per row of ``usable``: vec_id, deviation, and the whitened vector."""
    d, _ = found.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch, d)
            if not len(x):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(_squares(_deviations(x, found.n, found.sums)), pa.int64()),
                    pa.array(list(found.apply(x)), pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whitened_components(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    All rows that ``usable`` keeps are fitted and returned; a row with a null vec_id and
    rows with equal ids are rows of their own. ``deviation`` is exact, and null where it
    is beyond a long. Components with equal eigenvalues may be turned among themselves.
    An empty table, or one in which nothing varies, gives no rows. Memory does not grow
    with the table: a task holds a batch and one d x d matrix.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    found = fit(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, found)
    explained = F.array(*[F.lit(float(v)) for v in found.eigenvalues / found.trace])
    return whiten(rows, found).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")
    ).select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("_at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
