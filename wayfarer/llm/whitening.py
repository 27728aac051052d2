"""Whitening of embeddings: uncorrelated components of variance one.

Spark sums the vectors and the products of their centred entries, a task its own rows first. Entries
are whole numbers and centred by the whole number next to their mean, so these sums are exact, whatever
the order in which tasks end; what the rounded centre leaves over is taken off exactly too. The
covariance, as large as the dimension squared, is brought to tridiagonal form by Householder reflections.
Bisection with Sturm counts gives its leading eigenvalues, inverse iteration their vectors, made
orthogonal again within clusters of close eigenvalues. The components go out with the task's code and
every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfarer.llm.common import stored

# An entry c of a vector becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000

COMPONENTS = 8
LARGEST = 2.0 ** 42  # entries from here on have no exact whole number in a double after scaling
LEAST = 1e-11  # variance of a component, as a share of the first's; less is a rounding error
LIMB = 20  # bits of a whole number that go through one product of matrices
ROWS = 4096  # rows multiplied at a time: products of two limbs and their sums stay below 2**53
CLUSTER = 1e-3  # eigenvalues closer than this share of the matrix's norm are orthogonalised
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """``sums`` of the ``n`` vectors' whole numbers, and of the leading components the unit vectors
    (rows) and variances by falling variance; ``trace`` is the whole variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], "i8")


# -- the vectors ----------------------------------------------------------------------------------

def usable(vector: str):
    """Whether a vector is there, not empty, and all its entries are there and finite."""
    ok = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ok


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = rows.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    return v.where(usable("_v"))


def dimension(vectors: DataFrame) -> int | None:
    """The length of most vectors (of several such lengths the largest); None without vectors."""
    most = vectors.groupBy(F.size("_v").alias("_d")).count().orderBy(F.desc("count"), F.desc("_d")).first()
    return most["_d"] if most else None


def whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch, all of length ``d``, as whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype("i8").reshape(-1, d) + SHIFT


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python's integers; the halves of the numbers can't overflow."""
    low = (1 << 26) - 1
    return [(int(a) << 26) + int(b) for a, b in zip((x >> 26).sum(axis=0), (x & low).sum(axis=0), strict=True)]


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` in Python's integers: matrix products of limbs, of which each sum is exact in a double."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for a in range(0, len(y), ROWS):
        part = y[a: a + ROWS]
        limbs = []
        while True:
            low = ((part + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))  # from -2**19 to 2**19 - 1
            limbs.append(low.astype("f8"))
            part = (part - low) >> LIMB
            if not part.any():
                break
        for i, u in enumerate(limbs):
            for j, v in enumerate(limbs):
                total += (u.T @ v).astype("i8").astype(object) * (1 << (LIMB * (i + j)))
    return total


# -- the eigenvectors of one small matrix ---------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: the diagonal and the side diagonal of a symmetric matrix brought to tridiagonal form,
    and the unit normals of the reflections, the k-th for the coordinates from k + 1 on."""
    a = a.copy()
    n = len(a)
    normals = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        x[0] += np.copysign(length, x[0])
        size = np.linalg.norm(x)
        v = x / size if size > 0 else x  # nothing to reflect: a normal of zeros
        normals.append(v)
        block = a[k + 1:, k + 1:]
        p = 2 * (block @ v)
        w = p - (v @ p) * v
        block -= np.outer(v, w) + np.outer(w, v)
        row = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = row
    return np.diag(a).copy(), np.diag(a, -1).copy(), normals


def reflected(normals: list[np.ndarray], vector: np.ndarray) -> np.ndarray:
    """A vector of the tridiagonal matrix as one of the matrix it comes from."""
    out = vector.copy()
    for k in range(len(normals) - 1, -1, -1):
        v = normals[k]
        out[k + 1:] -= 2 * v * (v @ out[k + 1:])
    return out


def sturm_counts(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are below each of ``at``: the negative terms of the
    Sturm sequence."""
    least = np.finfo(float).tiny * max(1.0, float((side ** 2).max(initial=0.0)))
    q = diagonal[0] - at
    count = (q < 0).astype("i8")
    for d, e in zip(diagonal[1:], side, strict=True):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - at - e * e / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` largest eigenvalues, falling, by bisection of all their intervals at once."""
    n = len(diagonal)
    reach = np.abs(np.append(side, 0)) + np.abs(np.insert(side, 0, 0))
    norm = max(np.abs(diagonal - reach).max(), np.abs(diagonal + reach).max())
    low = np.full(m, (diagonal - reach).min() - 2 * EPS * norm)
    high = np.full(m, (diagonal + reach).max() + 2 * EPS * norm)
    below = n - 1 - np.arange(m)  # eigenvalues below the wanted one
    while True:
        middle = low + (high - low) / 2
        if ((high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))) | (middle <= low) | (middle >= high)
                | (high - low <= EPS * EPS * norm)).all():
            return middle
        up = sturm_counts(diagonal, side, middle) <= below
        low, high = np.where(up, middle, low), np.where(up, high, middle)


def solver(diagonal: np.ndarray, side: np.ndarray, value: float, least: float):
    """Elimination with row exchanges for the tridiagonal matrix less ``value``; pivots of ``least`` or more."""
    n = len(diagonal)
    main, upper, second = diagonal - value, np.append(side, 0.0), np.zeros(n)
    lower, swapped = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        under = side[i]
        if abs(main[i]) >= abs(under):
            main[i] = np.copysign(max(abs(main[i]), least), main[i])
            lower[i] = under / main[i]
            main[i + 1] -= lower[i] * upper[i]
        else:
            swapped[i] = True
            lower[i] = main[i] / under
            main[i], main[i + 1], upper[i] = under, upper[i] - lower[i] * main[i + 1], main[i + 1]
            if i + 1 < n - 1:
                second[i], upper[i + 1] = upper[i + 1], -lower[i] * upper[i + 1]
    main[-1] = np.copysign(max(abs(main[-1]), least), main[-1])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - lower[i] * x[i + 1]
            else:
                x[i + 1] -= lower[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= upper[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= second[i] * x[i + 2]
            x[i] /= main[i]
        return x

    return solve


def inverse_iteration(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) for falling eigenvalues. Within a cluster of close ones each vector is made
    orthogonal to those before it after every step, and equal values are set a little apart."""
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(side).max(initial=0.0)))
    rng = np.random.default_rng(11)
    found: list[np.ndarray] = []
    cluster = 0
    used = np.inf
    for k, value in enumerate(values.tolist()):
        if k and values[k - 1] - value > CLUSTER * norm:
            cluster = k
        used = min(value, used - 10 * EPS * norm) if k > cluster else value
        solve = solver(diagonal, side, used, EPS * norm)
        x = rng.normal(size=n)
        grown = 0
        for _ in range(12):
            x = solve(x / np.linalg.norm(x))
            for _ in range(2):
                for v in found[cluster:k]:
                    x -= (v @ x) * v
            grown += np.linalg.norm(x) * norm * EPS * 1e3 > 1  # at an eigenvector: solving blew it up
            if grown == 3:
                break
        found.append(x / np.linalg.norm(x))
    return np.array(found).reshape(len(values), n)


def leading_components(v: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit eigenvectors (rows; the largest entry positive) and eigenvalues of the ``m`` largest
    eigenvalues of a covariance, less those below ``LEAST`` of the first."""
    scale = float(np.abs(v).max(initial=0.0))
    if scale == 0.0:
        return np.zeros((0, len(v))), np.zeros(0)
    diagonal, side, normals = tridiagonal(v / scale)
    values = leading_eigenvalues(diagonal, side, min(m, len(v)))
    values = values[values > LEAST * values[0]]
    vectors = np.array([reflected(normals, x) for x in inverse_iteration(diagonal, side, values)])
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return vectors * signs[:, None], values * scale


# -- on Spark -------------------------------------------------------------------------------------

def fit(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The components of all usable vectors of the table's dimension; None without any. The driver gets
    sums: one number for each dimension, then one for each pair of dimensions."""
    vectors = _vectors(rows, id_col, vector_col)
    d = dimension(vectors)
    if d is None:
        return None
    vectors = vectors.where(F.size("_v") == d).select("_v")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = whole_numbers(batch.column("_v"), d)
            n, total = n + len(x), [a + b for a, b in zip(total, exact_sums(x), strict=True)]
        yield pa.record_batch({"i": pa.array([-1, *range(d)], pa.int32()), "s": pa.array([n, *total], pa.decimal128(38, 0))})

    found = vectors.mapInArrow(sums, "i int, s decimal(38, 0)").groupBy("i").agg(F.sum("s").alias("s"))
    said = {r["i"]: int(r["s"]) for r in found.collect()}
    model = Whitening(said[-1], tuple(said[i] for i in range(d)), np.zeros((0, d)), np.zeros(0), 0.0)
    centre = model.centre

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            total += exact_products(whole_numbers(batch.column("_v"), d) - centre)
        i, j = np.triu_indices(d)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                               "s": pa.array(total[i, j].tolist(), pa.decimal128(38, 0))})

    found = vectors.mapInArrow(products, "i int, j int, s decimal(38, 0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    n, rest = model.n, [s - model.n * int(c) for s, c in zip(model.sums, centre.tolist(), strict=True)]
    v = np.zeros((d, d))
    for r in found.collect():
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)  # exact but for this division
    vectors, values = leading_components(v, components)
    return Whitening(n, model.sums, vectors, values, float(np.trace(v)))


def deviations(y: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """Of each row the sum of ``(n * y + rest) ** 2`` over its entries, in Python's integers; None when 38
    digits don't hold it."""
    wide = int(np.abs(y).max(initial=0)) * (max(map(abs, rest), default=0) + int(np.abs(y).max(initial=0))) * y.shape[1] >= 1 << 62
    y = y.astype(object) if wide else y
    squares, mixed = (y * y).sum(axis=1).tolist(), y.dot(np.array(rest, object if wide else "i8")).tolist()
    own = sum(r * r for r in rest)
    out = [n * n * a + 2 * n * b + own for a, b in zip(squares, mixed, strict=True)]
    return [x if x < 10 ** 38 else None for x in out]


def transform(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Usable vectors: ``id_col``, deviation (decimal: the sum of squares of n times the whole numbers less
    their sums; NULL beyond 38 digits) and whitened (an array: one double for each component)."""
    d, centre, n = len(model.sums), model.centre, model.n
    rest = [n * c - s for s, c in zip(model.sums, centre.tolist(), strict=True)]
    offset = np.array([r / n for r in rest])
    weights = (model.vectors / np.sqrt(model.variances)[:, None]).T
    vectors = _vectors(rows, id_col, vector_col).where(F.size("_v") == d)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                y = whole_numbers(batch.column("_v"), d) - centre
                z = (y + offset) @ weights
                ends = np.arange(len(y) + 1, dtype="i4") * weights.shape[1]
                yield pa.record_batch({
                    "_id": batch.column("_id"), "deviation": pa.array(deviations(y, rest, n), pa.decimal128(38, 0)),
                    "whitened": pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))})

    schema = T.StructType([T.StructField("_id", rows.schema[id_col].dataType), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return vectors.mapInArrow(project, schema).withColumnRenamed("_id", id_col)


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity."""
    w = F.col("whitened")
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = whitened.agg(*[F.covar_pop(w[i], w[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable row of ``rows`` and each component: ``id_col``, component (from 1 on, by
    falling variance), n (the vectors fitted), deviation, whitened, explained (the component's share of the
    variance), identity_error (one value: the largest absolute entry of the whitened vectors' covariance
    less the identity).

    Rows whose vector is NULL, empty, holds NULL or non-finite entries or entries of 2**42 or more are
    dropped; so are vectors of another length than most have. A NULL id is kept as it is and rows that
    repeat an id or a vector all count. Components of no variance (less than ``LEAST`` of the first's) can't be
    whitened and have no rows: equal vectors, and an empty table, give none. deviation is NULL where a
    long can't hold it. Other columns are not read.
    """
    model = fit(rows, components, id_col, vector_col)
    id_type = rows.schema[id_col].dataType
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], T.StructType([
            T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]))
    found = stored(transform(rows, model, id_col, vector_col).withColumnRenamed(id_col, "_id"), "whitened")
    error = identity_error(found, len(model.variances))
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.variances])
    found = found.select("_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                         F.posexplode("whitened").alias("_at", "whitened"))
    return found.select(F.col("_id").alias(id_col), (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                        "deviation", "whitened", explained[F.col("_at")].alias("explained"),
                        F.lit(error).alias("identity_error"))
