"""Whitening of embeddings onto their leading principal components.

Entries become integers of 1/256 first, so sums and products are exact and do not
depend on how rows are spread. The fit sees each distinct vector once: a group of
copies, however large, is combined before the shuffle. One aggregate gives the
sums per dimension; then each task multiplies its vectors, centred at the whole
numbers next to the means, into one square matrix of integers, and the matrices
are added up entry by entry. What centring at whole numbers leaves is corrected
exactly. Only that matrix, of a size that no row count changes, reaches the driver.

There it is brought to tridiagonal form by Householder reflections; Sturm counts
bisect for the leading eigenvalues; inverse iteration, made orthogonal again
within clusters of close eigenvalues, gives the vectors. Means and components are
broadcast, as small as the matrix, and every row is projected where it lies.

Defined cases: a NULL vector, and one with a NULL, NaN or infinite entry, is left
out, and so is a vector of another length than ``dims`` (the most frequent length,
the longer one on a tie, unless given); repeated rows keep a result each; other
columns are carried along unchanged in ``row``, whatever their names and NULLs; a
component without variance is left out, so fewer distinct vectors than components
give fewer of them; an empty table, and one distinct vector, give no projection.
A deviation beyond the range of its type is NULL. A matrix of more than
``MOST_DIMS`` dimensions is refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.llm.common import packed, table
from cohortry.session import checkpointed

UNITS = 256
COMPONENTS = 4
MOST_DIMS = 4096
# Entries below this keep products and block sums exact in doubles: 2^22 squared, 512 rows.
EXACT_ENTRY, EXACT_ROWS = 2**22, 512
LONG = 2**63 - 1
WIDE = T.DecimalType(38, 0)
EPS = float(np.finfo(float).eps)
# Eigenvalues closer than this share of the norm count as a cluster.
CLUSTER = 1e-3
# A variance below this share of the trace is no variance.
NO_VARIANCE = 1e-12


def grid(vector: Column, units: int = UNITS) -> Column:
    """The entries as whole numbers of 1/units, rounded down; NULL for an unusable vector."""
    entries = vector.cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * F.lit(float(units))) + F.lit(0)))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The lists of an Arrow column, all of one length, as the rows of a matrix."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dims)


def usual_length(fit: DataFrame) -> int | None:
    """The most frequent length of the vectors, the longer one on a tie."""
    lengths = fit.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.agg(F.max(F.struct("n", "dims")).alias("top")).first()["top"]
    return top["dims"] if top and top["dims"] else None


def column_sums(fit: DataFrame) -> list[int]:
    """The exact sum of each dimension."""
    entries = fit.select(F.posexplode("x").alias("at", "value"))
    sums = entries.groupBy("at").agg(F.sum(F.col("value").cast(WIDE)).alias("s"))
    return [int(r["s"]) for r in sums.orderBy("at").collect()]


def products(fit: DataFrame, centre: Sequence[int]) -> np.ndarray:
    """Sum over all rows of (x - centre)(x - centre)^T, in whole numbers of any size.

    A task returns one matrix whatever its rows; Spark adds the matrices entry by entry.
    """
    dims, at = len(centre), np.array(centre, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, total = np.zeros((dims, dims), dtype=np.int64), None
        for batch in batches:
            for start in range(0, batch.num_rows, EXACT_ROWS):
                y = matrix(batch.column(0).slice(start, EXACT_ROWS), dims) - at
                if np.abs(y).max(initial=0) < EXACT_ENTRY:
                    part = (y.astype(float).T @ y.astype(float)).astype(np.int64)
                else:
                    part = y.astype(object).T @ y.astype(object)
                if part.dtype == object or max(np.abs(exact).max(), np.abs(part).max()) > LONG // 4:
                    total = (0 if total is None else total) + exact.astype(object) + part
                    exact[:] = 0
                else:
                    exact += part
        whole = exact if total is None else exact.astype(object) + total
        found = [int(v) for v in whole[np.triu_indices(dims)]]
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in found]], pa.list_(pa.string()))], names=["p"])

    partial = fit.select("x").mapInArrow(run, "p array<string>")
    entries = partial.select(F.posexplode("p").alias("at", "value"))
    sums = entries.groupBy("at").agg(F.sum(F.col("value").cast(WIDE)).alias("s"))
    whole = np.zeros((dims, dims), dtype=object)
    whole[np.triu_indices(dims)] = [int(r["s"]) for r in sums.orderBy("at").collect()]
    return whole + np.triu(whole, 1).T


def covariance(n: int, sums: Sequence[int], centre: Sequence[int], squares: np.ndarray) -> np.ndarray:
    """The covariance with divisor n: the rest of the centring is taken out in whole numbers, then divided once."""
    left = np.array([s - n * c for s, c in zip(sums, centre, strict=True)], dtype=object)
    scaled = n * squares - np.outer(left, left)
    return np.array([[int(v) / (n * n) for v in row] for row in scaled], dtype=float)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix, by Householder reflections.

    A reflection (k, v) stands for I - 2 v v^T on the rows from k on.
    """
    a = a.copy()
    reflections = []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        size = float(np.linalg.norm(x))
        if size == 0.0 or not np.abs(x[1:]).max(initial=0):
            continue
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        w = block @ v
        w -= v * (v @ w)
        block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0.0
        a[k + 1, k] = -math.copysign(size, v[0])
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, at: float) -> int:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are smaller than ``at``."""
    tiny = EPS * max(1e-300, float(np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)))
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off])
    floor, roof = float((diagonal - reach).min()), float((diagonal + reach).max())
    pad = EPS * n * max(abs(floor), abs(roof), 1e-300)
    found = []
    for j in range(k):
        low, high = floor - pad, roof + pad
        while True:
            middle = low + (high - low) / 2
            if not low < middle < high:
                break
            if below(diagonal, off, middle) >= n - j:
                high = middle
            else:
                low = middle
        found.append(middle)
    return found


def solved(diagonal: np.ndarray, off: np.ndarray, at: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """z with (T - at) z = right, by elimination with row exchanges; a zero pivot becomes tiny."""
    n = len(diagonal)
    main, upper, second, z = diagonal - at, np.r_[off, 0.0], np.zeros(n), right.astype(float)
    for i in range(n - 1):
        lower, here, over = off[i], main[i + 1], upper[i + 1]
        if abs(lower) > abs(main[i]):
            main[i], lower = lower, main[i]
            upper[i], here = here, upper[i]
            second[i], over = over, 0.0
            z[i], z[i + 1] = z[i + 1], z[i]
        if main[i] == 0.0:
            main[i] = tiny
        factor = lower / main[i]
        main[i + 1] = here - factor * upper[i]
        upper[i + 1] = over - factor * second[i]
        z[i + 1] -= factor * z[i]
    if abs(main[n - 1]) < tiny:
        main[n - 1] = tiny
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            z[i] -= upper[i] * z[i + 1]
        if i + 2 < n:
            z[i] -= second[i] * z[i + 2]
        z[i] /= main[i]
    return z


def leading_components(v: np.ndarray, k: int) -> tuple[list[float], np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows.

    The entry of a vector that is largest in size is positive.
    """
    k = min(k, len(v))
    scale = float(np.abs(v).max(initial=0.0))
    if not scale:
        return [], np.zeros((0, len(v)))
    diagonal, off, reflections = tridiagonal(v / scale)
    values = leading_values(diagonal, off, k)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0))
    found: list[np.ndarray] = []
    for j, value in enumerate(values):
        # Equal values are moved apart by a few roundings, so that their vectors differ.
        near = [i for i in range(j) if values[i] - value < CLUSTER * norm]
        at = value - EPS * norm * sum(values[i] - value < 10 * EPS * norm for i in near)
        z = np.cos(np.arange(1, len(v) + 1) * (j + 1.0))
        for _ in range(6):
            z = solved(diagonal, off, at, z, EPS * norm)
            z /= np.abs(z).max()
            for _ in range(2):
                for i in near:
                    z -= found[i] * (found[i] @ z)
            z /= np.linalg.norm(z)
        found.append(z)
    vectors = np.array(found)
    for start, mirror in reversed(reflections):
        vectors[:, start:] -= 2.0 * np.outer(vectors[:, start:] @ mirror, mirror)
    for z in vectors:
        z *= math.copysign(1.0, z[np.abs(z).argmax()]) / np.linalg.norm(z)
    return [value * scale for value in values], vectors


@dataclass(frozen=True)
class Whitening:
    """A fit: n distinct vectors, their sums, eigenvalues (falling) and components (rows), the trace of the covariance."""

    n: int
    sums: list[int]
    values: list[float]
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [e / self.trace for e in self.values]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, centred, on each component, in units of its standard deviation."""
        # Whole and broken part of the mean apart: the difference of large whole numbers is exact.
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        centred = (x - whole).astype(float) - rest
        return centred @ self.components.T / np.sqrt(np.array(self.values))

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - sums)^2, exact."""
        sums = np.array(self.sums, dtype=object)
        most = self.n * max(int(np.abs(x).max(initial=0)), 1) + max((abs(s) for s in self.sums), default=0)
        if most * most * max(len(sums), 1) < LONG:
            away = self.n * x - sums.astype(np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * x.astype(object) - sums
        return [int(v) for v in (away * away).sum(axis=1)]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The fit over ``fit`` (x: vectors of one length, each once); None without two different vectors."""
    sums = column_sums(fit)
    if not sums:
        return None
    if len(sums) > MOST_DIMS:
        raise ValueError(f"vectors of {len(sums)} dimensions; at most {MOST_DIMS} are allowed")
    n = fit.count()
    centre = [(2 * s + n) // (2 * n) for s in sums]
    v = covariance(n, sums, centre, products(fit, centre))
    values, vectors = leading_components(v, components)
    trace = float(np.trace(v))
    some = [i for i, e in enumerate(values) if e > NO_VARIANCE * trace]
    if not some:
        return None
    return Whitening(n, sums, [values[i] for i in some], vectors[some], trace)


def projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` without x, with deviation decimal(38,0) and whitened array<double>, one entry a component."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in rows.columns if c != "x"]
    given = rows.select(*(F.col(f"`{c}`") for c in keep), "x")
    names = [*keep, "deviation", "whitened"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, most = shared.value, 10**38
        for batch in batches:
            x = matrix(batch.column(len(keep)), len(fitted.sums))
            far = [str(d) if d < most else None for d in fitted.deviation(x)]
            white = fitted.project(x)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, white.size + 1, white.shape[1]), pa.int32()), pa.array(white.ravel())
            )
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(far, pa.string()), lists], names=names)

    schema = T.StructType([given.schema[c] for c in keep])
    out = given.mapInArrow(run, schema.add("deviation", "string").add("whitened", T.ArrayType(T.DoubleType())))
    return out.withColumn("deviation", F.col("deviation").cast(WIDE))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry, in size, of the covariance of the whitened fit list less the identity, from its rows."""
    k = len(model.values)
    white = checkpointed(projected(fit.select("x"), model).select("whitened"))
    means = white.agg(*(F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(k))).first()
    away = [F.col("whitened")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*(F.sum(away[i] * away[j]).alias(f"s{i}_{j}") for i, j in pairs)).first()
    return max(abs(s / model.n - (i == j)) for s, (i, j) in zip(found, pairs, strict=True))


@dataclass(frozen=True)
class Whitened:
    """``rows`` (row, deviation, whitened), the fit (None if there is none) and its identity error."""

    rows: DataFrame
    model: Whitening | None
    error: float | None


def whiten(
    vectors: DataFrame,
    column: str = "embedding",
    components: int = COMPONENTS,
    units: int = UNITS,
    dims: int | None = None,
) -> Whitened:
    """Whiten the vectors of ``column``; ``row`` of the result holds the columns of ``vectors`` as they were."""
    usable = packed(vectors, x=grid(F.col(f"`{column}`"), units)).filter(F.col("x").isNotNull())
    fit = checkpointed(usable.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x"))
    dims = dims or usual_length(fit)
    fit, usable = (d.filter(F.size("x") == F.lit(dims or -1)) for d in (fit, usable))
    model = fit_whitening(fit, components)
    if model is None:
        nothing = usable.limit(0).select("row", F.lit(None).cast(WIDE).alias("deviation"))
        return Whitened(nothing.withColumn("whitened", F.lit(None).cast("array<double>")), None, None)
    return Whitened(projected(usable, model), model, identity_error(fit, model))


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Each usable embedding on the four leading components, with what the fit says of them."""
    done = whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    each = done.rows.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(e) for e in (done.model.explained if done.model else []))).cast("array<double>")
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(done.model.n if done.model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(done.error).cast("double").alias("identity_error"),
    )
