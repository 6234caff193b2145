"""Whitening of embeddings along their principal components.

Spark sums the covariance exactly, in whole numbers. Its leading eigenpairs
are found interval by interval: counts of eigenvalues above a shift (the
inertia of the shifted matrix) say where to cut and how many pairs each
interval has. Within an interval the contour integral of the resolvent,
taken by quadrature on a circle around it, projects a few random vectors
onto the eigenvectors of the interval; a Rayleigh-Ritz step takes the pairs
out, and they go through the integral again until they are exact. Intervals
do not need each other, so each is a task. At the end the inertia is asked
again whether as many eigenvalues lie above the last component as were found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.llm.batches import slices
from clusterloom.llm.vectors import is_usable, scaled_down
from clusterloom.storage import drop_snapshot, snapshot, work_dir

#: The covariance goes to the driver and to every task of an interval.
MOST_DIMENSIONS = 2048

#: Entries beyond this size are not taken: sums of products must fit 38 digits.
LARGEST_ENTRY = float(1 << 40)

#: Values that a task holds as a matrix at a time.
VALUES = 1 << 19

#: Quadrature points on the upper half of a circle, and eigenvalues that an interval should have at most.
POINTS = 8
PER_INTERVAL = 4

#: Passes through the integral before the subspace is made larger.
PASSES = 12

#: Shares of the largest eigenvalue: below the first an eigenvalue counts as zero, cuts are not made finer than the
#: second, and a pair is exact when its residual is below the third.
ZERO, FINEST, EXACT = 1e-11, 1e-9, 1e-14

#: Bits of a digit when whole numbers are multiplied in double precision.
DIGIT = 18


@dataclass(frozen=True)
class Fit:
    """The fit list's size, sums, and the leading eigenpairs of its covariance."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def centre(self) -> tuple[np.ndarray, list[int]]:
        """Whole part of the means, and what the sums have beyond it."""
        whole = [total // self.n for total in self.sums]
        return np.array(whole, np.int64), [total - self.n * c for total, c in zip(self.sums, whole)]


def matrices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in slices(batches, max(1, VALUES // max(1, dimensions))):
        yield batch, batch["x"].flatten().to_numpy().reshape(batch.num_rows, dimensions)


class Total:
    """Sums of 64-bit integers, as two halves."""

    def __init__(self, *shape: int):
        self.high, self.low = np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def add(self, values: np.ndarray) -> None:
        self.high += values >> 30
        self.low += values & ((1 << 30) - 1)

    def value(self) -> np.ndarray:
        return self.high.astype(object) * (1 << 30) + self.low.astype(object)


def sums_in_batches(dimensions: int):
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Total(dimensions)
        for _, matrix in matrices(batches, dimensions):
            total.add(matrix.sum(axis=0))
        values = pa.array(total.value().tolist(), pa.decimal128(38))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions)), values], ["i", "value"])

    return add_up


def digits(matrix: np.ndarray) -> list[np.ndarray]:
    """Digits of ``DIGIT`` bits, the first with the sign; as many as the largest entry needs."""
    found, rest = [], matrix
    while np.abs(rest).max(initial=0) >= 1 << DIGIT:
        found.append((rest & ((1 << DIGIT) - 1)).astype(float))
        rest = rest >> DIGIT
    return [*found, rest.astype(float)]


def products_in_batches(centre: np.ndarray):
    """Exact sums of the products of centred entries, the upper triangle."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(centre)
        totals: dict[int, Total] = {}
        for _, matrix in matrices(batches, size):
            # A product of digits has 36 bits and a piece fewer than 2**16 rows, or one: its sums are exact doubles.
            for start in range(0, len(matrix), 1 << 15):
                parts = digits(matrix[start : start + (1 << 15)] - centre)
                for i, one in enumerate(parts):
                    for j, other in enumerate(parts):
                        totals.setdefault(i + j, Total(size, size)).add((one.T @ other).astype(np.int64))
        if totals:
            i, j = np.triu_indices(size)
            value = sum(total.value()[i, j] * (1 << DIGIT * place) for place, total in totals.items())
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value.tolist(), pa.decimal128(38))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "value"])

    return add_up


def covariance(rows: DataFrame, dimensions: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums, and the covariance, rounded once from exact whole numbers."""
    n = rows.count()
    found = rows.mapInArrow(sums_in_batches(dimensions), "i long, value decimal(38,0)")
    sums = {r["i"]: int(r["value"]) for r in found.groupBy("i").agg(F.sum("value").alias("value")).collect()}
    sums = [sums.get(i, 0) for i in range(dimensions)]
    fit = Fit(n, sums, 0.0, np.zeros(0), np.zeros((dimensions, 0)))
    centre, rest = fit.centre
    found = rows.mapInArrow(products_in_batches(centre), "i int, j int, value decimal(38,0)")
    products = found.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    matrix = np.zeros((dimensions, dimensions))
    for i, j, value in zip(*(products[name].to_pylist() for name in ("i", "j", "value"))):
        matrix[i, j] = matrix[j, i] = (n * int(value) - rest[i] * rest[j]) / (n * n)
    return n, sums, matrix


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive pivots of its shifted L D L'.

    Pivots are single entries or blocks of two, chosen by Bunch and Kaufman's rule.
    """
    a = matrix - shift * np.eye(len(matrix))
    alpha, positive = (1 + 17**0.5) / 8, 0
    while len(a):
        column = np.abs(a[1:, 0])
        at = int(column.argmax()) + 1 if len(column) else 0
        most = column[at - 1] if at else 0.0
        if at and abs(a[0, 0]) < alpha * most:
            row = np.abs(a[at])
            row[at] = 0.0
            if abs(a[0, 0]) * row.max() < alpha * most**2:
                to = 0 if abs(a[at, at]) >= alpha * row.max() else 1
                a[[to, at]] = a[[at, to]]
                a[:, [to, at]] = a[:, [at, to]]
                if to:
                    block, side = a[:2, :2], a[2:, :2]
                    positive += int((np.linalg.eigvalsh(block) > 0).sum())
                    a = a[2:, 2:] - side @ np.linalg.solve(block, side.T)
                    continue
        pivot = a[0, 0]
        positive += bool(pivot > 0)
        side = a[1:, 0]
        a = a[1:, 1:] - np.outer(side, side / pivot) if pivot else a[1:, 1:]
    return positive


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high] that hold the ``wanted`` largest eigenvalues, and how many each holds.

    Eigenvalues too close to be cut apart stay together, so there can be a few more; zeros stay out.
    """
    top = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not top:
        return []
    top *= 1 + FINEST
    low, n = ZERO * top, above(matrix, ZERO * top)
    high = top
    while n > wanted and high - low > FINEST * top:
        middle = (low + high) / 2
        found = above(matrix, middle)
        if found >= wanted:
            low, n = middle, found
        else:
            high = middle
    ready, left = [], [(low, top, n)]
    while left:
        low, high, n = left.pop()
        if n <= PER_INTERVAL or high - low <= FINEST * top:
            ready += [(low, high, n)] if n else []
            continue
        middle = (low + high) / 2
        upper = above(matrix, middle) - above(matrix, high)
        left += [(low, middle, n - upper), (middle, high, upper)]
    return sorted(ready)


def filtered(matrix: np.ndarray, vectors: np.ndarray, low: float, high: float) -> np.ndarray:
    """The contour integral of the resolvent around the interval, applied to the vectors.

    Points below the real line give the conjugates of those above.
    """
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    total = np.zeros_like(vectors)
    for point, weight in zip(points, weights):
        turn = np.exp(0.5j * np.pi * (1 - point))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, vectors.astype(complex))
        total += weight / 2 * radius * (turn * solved).real
    return total


def extracted(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh and Ritz: the best eigenpairs that the span of the vectors has."""
    basis = np.linalg.qr(vectors)[0]
    image = basis.T @ matrix @ basis
    values, own = np.linalg.eigh((image + image.T) / 2)
    return values, basis @ own


def eigenpairs(matrix: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenpairs of an interval, from a subspace somewhat larger, which grows if some are not found."""
    top = float(np.abs(matrix).sum(axis=1).max())
    random = np.random.default_rng(0)
    size = min(len(matrix), max(n + 4, 2 * n))
    while True:
        vectors = random.standard_normal((len(matrix), size))
        last = False
        for _ in range(PASSES):
            values, vectors = extracted(matrix, filtered(matrix, vectors, low, high))
            inside = np.flatnonzero((values > low) & (values <= high))
            residual = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0.0)
            if last:
                break
            last = len(inside) == n and residual <= EXACT * top * len(matrix)  # once more, to full precision
        # A subspace of all dimensions misses nothing; what lies on a cut is settled by the caller.
        if len(inside) == n and last or size == len(matrix):
            near = (values > low - FINEST * top) & (values <= high + FINEST * top)
            kept = inside if len(inside) == n else np.flatnonzero(near)
            return values[kept], vectors[:, kept]
        size = min(len(matrix), 2 * size)


def pairs_in_frames(held: Broadcast):
    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for low, high, n in frame[["low", "high", "n"]].itertuples(index=False):
                _, vectors = eigenpairs(held.value, low, high, n)
                yield pd.DataFrame({"vector": [vector.tobytes() for vector in vectors.T]})

    return solve


def leading(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as columns; zeros are left out."""
    cuts = intervals(matrix, wanted)
    if not cuts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    held = spark.sparkContext.broadcast(matrix)
    try:
        tasks = spark.createDataFrame(cuts, "low double, high double, n int").repartition(len(cuts))
        found = tasks.mapInPandas(pairs_in_frames(held), "vector binary").collect()
    finally:
        held.destroy()
    vectors = np.stack([np.frombuffer(row["vector"]) for row in sorted(found)], axis=1)
    # Vectors of different intervals become orthogonal to the last digit.
    values, vectors = extracted(matrix, vectors)
    order = np.argsort(-values)[:wanted]
    top = float(np.abs(matrix).sum(axis=1).max())
    edge = values[order[-1]] - FINEST * top
    if above(matrix, edge) > (values > edge).sum() or len(order) < min(wanted, sum(n for _, _, n in cuts)):
        raise ArithmeticError("an eigenvalue of the covariance was missed")
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


def whitened_in_batches(fit: Fit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, rest = fit.centre
        directions = fit.vectors / np.sqrt(fit.values)
        for batch, matrix in matrices(batches, len(centre)):
            near = matrix - centre
            largest = fit.n * (int(np.abs(near).max(initial=0)) + 1)
            exact = np.int64 if largest**2 * len(centre) < 1 << 62 else object
            apart = near.astype(exact) * fit.n - np.array(rest, exact)
            deviation = [value if value < 1 << 63 else None for value in (apart * apart).sum(axis=1).tolist()]
            whitened = (near - np.array([r / fit.n for r in rest])) @ directions
            offsets = np.arange(0, whitened.size + 1, max(1, len(fit.values)), dtype=np.int32)
            columns = [
                batch["id"], pa.array(deviation, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(whitened.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "whitened"])

    return run


def identity_error(rows: DataFrame, n: int, size: int) -> float:
    """Largest entry of the covariance of the whitened values less the identity."""
    value = [F.col("whitened")[i] for i in range(size)]
    means = rows.agg(*[(F.sum(value[i]) / n).alias(f"m{i}") for i in range(size)]).first()
    apart = [value[i] - F.lit(means[i]) for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = rows.agg(*[(F.sum(apart[i] * apart[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(entry - (i == j)) for (i, j), entry in zip(pairs, found))


def whiten(
    df: DataFrame,
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Columns id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Entries become x = floor(scale * entry) + offset. Components are the unit
    eigenvectors of the covariance of x (divisor n) with the largest
    eigenvalues e, from 1; of equal eigenvalues any vectors. ``whitened`` is
    x less the mean, projected and divided by the root of e, ``explained``
    e's share of the trace, ``deviation`` the exact sum of (n x - sum)^2 over
    the dimensions, null where it passes 64 bits. ``identity_error`` tells how
    far the covariance of ``whitened`` is from the identity.

    Vectors that are null, or hold null, non-finite or huge entries (2^40
    after scaling) take no part, nor those that have not the most frequent
    length (of equally frequent ones the greater). Eigenvalues below
    1e-11 of the largest count as zero and have no component, so equal
    vectors, or a single one, give no rows, nor does an empty table. Rows
    without an id and repeated rows count as others do; other columns are
    ignored. Vectors longer than 2048 are an error: the covariance is held as a whole.

    Nothing is shuffled but sums; the usable rows and the result of each are
    written once to the shared folder.
    """
    spark = df.sparkSession
    vector, found = F.col(vector_column), "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fits = F.forall(vector.cast("array<double>"), lambda c: F.abs(c * F.lit(float(scale))) < F.lit(LARGEST_ENTRY))
    rows = df.filter(is_usable(vector) & fits).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(scaled_down(vector, scale), lambda c: c + F.lit(offset).cast("long")).alias("x"),
    )
    folder = work_dir(spark)
    try:
        rows = snapshot(rows, f"{folder}/rows")
        lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
        usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
        length = usual["length"] if usual else 0
        if length > MOST_DIMENSIONS:
            raise ValueError(f"vectors of {length} entries: more than {MOST_DIMENSIONS}")
        rows = rows.filter(F.size("x") == length)
        values = np.zeros(0)
        if length:
            n, sums, matrix = covariance(rows, length)
            values, vectors = leading(spark, matrix, components)
        if not len(values):
            return spark.createDataFrame([], found).withColumnRenamed("id", id_column)
        fit = Fit(n, sums, float(np.trace(matrix)), values, vectors)
        done = rows.mapInArrow(whitened_in_batches(fit), "id long, deviation long, whitened array<double>")
        done = snapshot(done, f"{folder}/whitened")
    finally:
        drop_snapshot(spark, f"{folder}/rows")
    error = identity_error(done, n, len(values))
    explained = F.array(*[F.lit(float(value / fit.trace)) for value in values])
    return done.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias(id_column),
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
