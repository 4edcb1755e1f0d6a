"""Embedding whitening by spectral divide-and-conquer.

Vectors become integers, ``x = floor(64 * c) + 1000000``. The fit list holds
each distinct x vector once; its covariance V (divisor: the list's length) is
summed by Spark as exact integers, after centring on the whole-number mean, and
corrected for the rest of the mean as exact fractions.

V's eigenvectors come from polar decompositions. For a symmetric matrix the
polar factor of ``V - s`` is the matrix sign, so ``(U + 1) / 2`` projects on the
eigenvectors above the shift s; an orthonormal basis of its range and one of
the rest split V into two smaller blocks, and so on until a block is a number
times the identity (Nakatsukasa and Higham 2013). The polar factors are found
by dynamically weighted Halley steps (QDWH): by a QR factorisation while the
weights are large, by a Cholesky one after. Blocks below the components that
are asked for are not split. All this is on one matrix of the vectors'
dimension; the components are broadcast (components x dimension numbers), and
every row is whitened where it lies.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, as are rows whose vector has another length than most
(the shorter one, in a tie). A null id is kept. Repeated rows are whitened each
for itself and count once in the fit list. Components whose eigenvalue is zero
to double precision have no scale and are left out, so a table with one
distinct vector, or none, gives no rows. Of equal eigenvalues any orthonormal
components are right. Other columns of the input, whatever their names, are
not looked at. Where 64 * c is beyond 2**30 it is taken as that, of either sign.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: The integer form of an entry.
SCALE, OFFSET = 64, 1_000_000
#: Scaled entries go so far: squares of two of them are below 2**63.
LIMIT = float(1 << 30)
COMPONENTS = 16
#: Vectors of a step within a task.
STEP = 8192
_EPS = float(np.finfo(np.float64).eps)


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QDWH."""
    n = len(matrix)
    scale = float(np.linalg.norm(matrix))
    if not scale:
        return np.zeros_like(matrix)
    x = matrix / scale
    # No singular value above rounding is smaller; six steps are enough.
    low = _EPS
    eye = np.eye(n)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        a = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        before = x
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            x = b / c * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(eye + c * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            x = b / c * x + (a - b / c) * np.linalg.solve(lower.T, half).T
        low = min(low * (a + b * square) / (1 + c * square), 1.0)
        if np.linalg.norm(x - before) < 1e-9 and abs(1 - low) < 1e-9:
            break
    return x


def _split(block: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift, or None
    if the block is a multiple of the identity as far as doubles tell."""
    n = len(block)
    mean = float(np.trace(block)) / n
    spread = float(np.linalg.norm(block - mean * np.eye(n)))
    size = float(np.linalg.norm(block))
    if n == 1 or spread <= n * _EPS * size:
        return None
    # The median of the diagonal halves the work; the mean always separates.
    # A shift that meets an eigenvalue gives no projector, so others follow.
    shifts = [float(np.median(np.diag(block))), mean]
    shifts += [mean + spread * f / np.sqrt(n) for f in (0.01, -0.01, 0.07, -0.07, 0.3, -0.3)]
    best = None
    for shift in shifts:
        sign = polar(block - shift * np.eye(n))
        sign = (sign + sign.T) / 2
        projector = (sign + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < n:
            continue
        start = np.random.default_rng(11).standard_normal((n, rank))
        basis, _ = np.linalg.qr(projector @ start)
        basis, _ = np.linalg.qr(projector @ basis)
        whole, _ = np.linalg.qr(basis, mode="complete")
        upper, lower = whole[:, :rank], whole[:, rank:]
        left = float(np.linalg.norm(lower.T @ block @ upper))
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 20 * n * _EPS * size:
            break
    if best is None:
        return None
    return best[1], best[2]


def spectrum(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns."""
    matrix = (matrix + matrix.T) / 2
    found: list[np.ndarray] = []
    todo = [np.eye(len(matrix))]
    while todo and len(found) < most:
        basis = todo.pop()
        parts = _split(basis.T @ matrix @ basis)
        if parts is None:
            found += list(basis.T)
        else:
            # The upper part is on top: what lies below it may never be split.
            todo += [basis @ parts[1], basis @ parts[0]]
    vectors = np.array(found).reshape(-1, len(matrix))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), _EPS)
    values = np.einsum("ij,jk,ik->i", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[order].T


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def whole(c):
        scaled = F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT)))
        return scaled.cast("long") + OFFSET

    kept = rows.filter((F.size(v) > 0) & finite).select(
        F.col("vec_id").cast("long"), F.transform(v, whole).alias("x")
    )
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    return kept.filter(F.size("x") == usual["d"]) if usual else kept.limit(0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _steps(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            yield part, _matrix(part.column("x"))


def _numbers(values: np.ndarray) -> pa.Array:
    """Whole numbers as strings, which hold any size."""
    if values.dtype == object:
        return pa.array(list(map(str, values)), pa.string())
    return pa.array(values).cast(pa.string())


def _wide(y: np.ndarray, terms: int) -> np.ndarray:
    """y in a type whose products summed over so many terms are exact."""
    most = terms * (int(np.abs(y).max(initial=0)) + 1) ** 2
    # Doubles multiply fastest.
    return y.astype(np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object)


def _entries(rows: DataFrame, compute, exact: bool) -> dict[tuple[int, int], object]:
    """Sums over all rows of the matrices that ``compute`` gives for some: a
    task adds its own up, Spark those of the tasks."""

    def run(batches):
        total = None
        for _, x in _steps(batches):
            own = compute(x)
            own = own.astype(object) if exact else own
            total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            values = _numbers(total.ravel()) if exact else pa.array(total.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], names=["i", "j", "value"]
            )

    # As many numbers come back as the matrix has, whatever the rows.
    fields = f"i int, j int, value {'string' if exact else 'double'}"
    value = F.col("value").cast("decimal(38,0)" if exact else "double")
    sums = rows.select("x").mapInArrow(run, fields).groupBy("i", "j").agg(F.sum(value).alias("s"))
    return {(r["i"], r["j"]): r["s"] for r in sums.collect()}


def _dense(entries: dict, shape: tuple[int, int]) -> np.ndarray:
    made = np.zeros(shape, object)
    for at, value in entries.items():
        made[at] = value
    return made


class Fit:
    """What the fit list tells: its length n, the sums S, the components."""

    def __init__(self, fit: DataFrame, most: int) -> None:
        self.n = fit.count()
        d = fit.select(F.size("x")).first()[0] if self.n else 0
        sums = _dense(_entries(fit, lambda x: (x - OFFSET).sum(axis=0, keepdims=True), True), (1, d))[0]
        self.sums = [int(s) + OFFSET * self.n for s in sums]
        # The whole part of the mean, and what is left of n times the mean.
        self.centre = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        centre = self.centre

        def products(x: np.ndarray) -> np.ndarray:
            y = _wide(x - centre, len(x))
            made = y.T @ y
            return made.astype(np.int64) if made.dtype == np.float64 else made

        products_ = _dense(_entries(fit, products, True), (d, d))
        covariance = np.zeros((d, d))
        for i in range(d):
            for j in range(d):
                exact = self.n * int(products_[i, j]) - self.rest[i] * self.rest[j]
                covariance[i, j] = float(Fraction(exact, self.n * self.n)) if self.n else 0.0
        self.trace = float(np.trace(covariance))
        values, vectors = spectrum(covariance, min(most, d)) if d else (np.zeros(0), np.zeros((0, 0)))
        real = values > d * _EPS * max(values.max(initial=0.0), 0.0)
        self.values, self.vectors = values[real], vectors[:, real]

    def matrix(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole centre, the rest of the mean, and components over the root of
        their eigenvalues."""
        rest = np.array([float(Fraction(r, self.n)) for r in self.rest])
        return self.centre, rest, self.vectors / np.sqrt(self.values)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each of ``rows`` (vec_id, embedding) that takes part and
    each component: vec_id, component, n, deviation (a decimal, the exact sum
    over dimensions of (n * x - S) ** 2), whitened, explained, identity_error."""
    spark = rows.sparkSession
    given = integers(rows)
    fit = stage(given.select("x").distinct(), "white-fit")
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    if fit.isEmpty():
        return spark.createDataFrame([], schema)
    learned = Fit(fit, components)
    k = len(learned.values)
    if not k:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(learned.matrix())
    n, rest = learned.n, learned.rest

    def white(x: np.ndarray) -> np.ndarray:
        centre, part, matrix = shared.value
        return ((x - centre) - part) @ matrix

    def moments(x: np.ndarray) -> np.ndarray:
        w = white(x)
        # Sums beside products, for the centring.
        return np.vstack([w.T @ w, w.sum(axis=0, keepdims=True)])

    found = _dense(_entries(fit, moments, False), (k + 1, k)).astype(np.float64) / n
    error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())

    def run(batches):
        r = np.array(rest, object if n >= 1 << 31 else np.int64)
        for batch, x in _steps(batches):
            y = x - shared.value[0]
            square = _wide(y, y.shape[1])
            squares = (square * square).sum(axis=1)
            squares = squares if squares.dtype == object else squares.astype(np.int64)
            cross = (y.astype(object if np.abs(y).max(initial=0) >= 1 << 24 else np.int64) * r).sum(axis=1)
            offsets = np.arange(0, k * len(x) + 1, k, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _numbers(squares), _numbers(cross),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(white(x).ravel()))],
                names=["vec_id", "squares", "cross", "whitened"],
            )

    made = given.mapInArrow(run, "vec_id long, squares string, cross string, whitened array<double>")
    exact = "decimal(38,0)"
    # (n * y - r)**2 summed: n*n*yy - 2*n*yr + rr, where y = x - centre.
    deviation = (
        F.lit(str(n * n)).cast(exact) * F.col("squares").cast(exact)
        - F.lit(str(2 * n)).cast(exact) * F.col("cross").cast(exact)
        + F.lit(str(sum(v * v for v in rest))).cast(exact)
    )
    explained = F.array(*(F.lit(float(v) / learned.trace) for v in learned.values))
    return (
        made.withColumn("deviation", deviation.cast(exact))
        .select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
        .select(
            "vec_id",
            (F.col("_at") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(explained, F.col("_at") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
