"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Entries become whole numbers, ``x = floor(64 * c) + 1000000``. The fit list holds each distinct vector once; with
its n vectors and sums S, the matrix ``A = n * sum(x x') - S S'`` is exact and n * n times the covariance V.

1. The characteristic polynomial of A is computed modulo many primes, each by a reduction to Hessenberg form, in
   Spark tasks, and put together by Chinese remainders; the trace bounds its coefficients.
2. All its roots are real, so the sign changes of the polynomial moved to t count the roots above t exactly,
   repeated ones too. Bisection isolates the largest roots and goes on, by exact signs, to ``PRECISION`` bits.
3. A component is the null space of ``A - root * I``: inverse iteration in numbers of ``FRACTION`` binary places.
   Roots that can't be told apart at that precision share a space, of which an orthonormal basis is taken.

Only what has the size of the matrix passes the driver; vectors are reduced, projected and counted in tasks.

Rows with a null vector, a null or non-finite entry, or an entry too large for a long (64 * c beyond 2**62) take no part.
Nor do vectors of another length than the most frequent one (the longer of equally frequent ones), as they have no
covariance with the others. Rows that repeat a vec_id, or have none, are rows of their own. Components with the
eigenvalue 0 can't be scaled and are left out, so fewer distinct vectors, or fewer dimensions, give fewer rows;
none or one vector gives none. Extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.session import materialize

SCALE = 64
COMPONENTS = 16
PRECISION = 112  # bits of a root, counted from the trace
FRACTION = 320  # binary places of the inverse iteration
HALF = 48  # bits in the lower half of a sum
LARGEST = float(1 << 62)
BATCH = 2048


def packed_row(y: np.ndarray) -> bytes:
    """Little-endian integers of the smallest width that holds all: equal bytes if and only if equal vectors."""
    high = max(int(y.max()), -int(y.min()) - 1)
    width = next(w for w in (1, 2, 4, 8) if high < 1 << (8 * w - 1))
    return y.astype(f"<i{width}").tobytes()


def unpacked(x: pa.Array, d: int) -> np.ndarray:
    """The packed rows as one array of longs, without the offset."""
    return np.array([np.frombuffer(b, f"<i{len(b) // d}") for b in x.to_pylist()], np.int64).reshape(len(x), d)


def integers(df: DataFrame, d: int, key: str, vector: str) -> DataFrame:
    """(vec_id, x): the whole numbers of every row that takes part, packed."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(F.size("v") == d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)  # null: nan
            with np.errstate(over="ignore", invalid="ignore"):
                y = np.floor(SCALE * flat)
                good = (np.abs(y) < LARGEST).all(axis=1)
            packed = [packed_row(row) for row in y[good].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.array(packed, pa.binary())], names=["vec_id", "x"])

    return rows.mapInArrow(run, "vec_id long, x binary")


def products(y: np.ndarray) -> np.ndarray:
    """Exact sum of the rows' outer products; floats and longs while they hold it."""
    size = int(np.abs(y).max()) ** 2 * len(y)
    if size < 1 << 53:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    if size < 1 << 63:
        return (y.T @ y).astype(object)
    return y.T.astype(object) @ y.astype(object)


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S and the sums of products of the distinct vectors, all exact."""
    names = ["i", "j", "high", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row and column belong to a 1 that is added to every vector: sums and count.
        total = np.zeros((d + 1, d + 1), object)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                y = unpacked(batch.column(0).slice(at, BATCH), d)
                total += products(np.concatenate([y, np.ones((len(y), 1), np.int64)], axis=1))
        i, j = np.tril_indices(d + 1)
        sums = [int(v) for v in total[i, j]]
        halves = [[str(v >> HALF) for v in sums], [str(v & ((1 << HALF) - 1)) for v in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, halves)], names=names)

    rows = fit.select("x").mapInArrow(run, "i int, j int, high string, low string")
    add = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    full = [[0] * (d + 1) for _ in range(d + 1)]
    for i, j, high, low in rows.groupBy("i", "j").agg(add("high"), add("low")).collect():
        full[i][j] = full[j][i] = (int(high) << HALF) + int(low)
    return full[d][d], full[d][:d], [row[:d] for row in full[:d]]


def primes(bits: float) -> list[int]:
    """Primes below 2**31, largest first, with a product of over ``bits`` bits."""

    def prime(n: int) -> bool:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(base, odd, n)
            if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
                return False
        return True

    out, n, size = [], (1 << 31) - 1, 0.0
    while size <= bits:
        if prime(n):
            out.append(n)
            size += math.log2(n)
        n -= 2
    return out


def characteristic_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - a) modulo ``p``, lowest first, by a reduction to Hessenberg form."""
    h, d = a.copy() % p, len(a)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        if below[0]:
            swap = [k, k + below[0]]
            h[swap] = h[swap[::-1]]
            h[:, swap] = h[:, swap[::-1]]
        f = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - f[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        weights, t = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * t % p
            t = t * int(h[i, i - 1]) % p if i else t
        polys[k + 1, 1:] = polys[k, :-1]
        polys[k + 1] = (polys[k + 1] - (weights[:, None] * polys[: k + 1] % p).sum(axis=0)) % p
    return polys[d]


def characteristic(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x I - a), lowest first, of a matrix without negative eigenvalues."""
    d, trace = len(a), sum(a[k][k] for k in range(len(a)))
    # Coefficients are sums of products of eigenvalues, together the product of all (1 + eigenvalue).
    moduli = primes(d * math.log2(trace // d + 2) + 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                p = moduli[k]
                found = characteristic_modulo(np.array([[v % p for v in row] for row in a], np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([found.tolist()], pa.list_(pa.int64()))], names=["k", "c"])

    parts = min(len(moduli), max(1, spark.sparkContext.defaultParallelism))
    found = spark.range(0, len(moduli), 1, parts).mapInArrow(run, "k long, c array<long>").collect()
    whole = math.prod(moduli)
    total = np.zeros(d + 1, object)
    for k, c in found:
        rest = whole // moduli[k]
        total = total + np.array(c, object) * (rest * pow(rest, -1, moduli[k]))
    return [int(v) - whole if 2 * int(v) > whole else int(v) for v in total % whole]


def above(poly: list[int], a: int, b: int) -> int:
    """How many roots lie above a / 2**b (a > 0), counted exactly since all are real."""
    d = len(poly) - 1
    # poly(t * (1 + z)) up to a positive factor; its sign changes are its positive roots
    moved, power = [], 1
    for k, c in enumerate(poly):
        moved.append((c * power) << (b * (d - k)))
        power *= a
    moved = np.array(moved[::-1], object)
    for k in range(d):
        moved[: d + 1 - k] = np.add.accumulate(moved[: d + 1 - k])
    signs = [c > 0 for c in moved if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, b: int) -> int:
    """Sign of poly(a / 2**b)."""
    value, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        value = value * a + (poly[k] << (b * (d - k)))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int, trace: int) -> list[tuple[int, int, int, int]]:
    """(low, high, b, count): intervals (low, high] / 2**b that hold the ``wanted`` largest roots, falling."""
    top = trace.bit_length()
    places = max(0, PRECISION - top)  # binary places of the final intervals
    out, found = [], 0
    # intervals as (low, high, binary places, roots above low, roots above high)
    todo = [(0, 1 << top, 0, len(poly) - 1 - next(k for k, c in enumerate(poly) if c), 0)]
    while todo and found < wanted:
        low, high, b, many, few = todo.pop()
        if many == few:
            continue
        if many - few == 1:
            side = sign_at(poly, high, b)
            # one simple root in (low, high]: the sign at a point tells on which side it lies
            while side and (b < places or high - low > 1):
                if high - low == 1:
                    low, high, b = 2 * low, 2 * high, b + 1
                mid = (low + high) // 2
                s = sign_at(poly, mid, b)
                if s == 0:
                    low = high = mid
                    break
                low, high = (low, mid) if s == side else (mid, high)
            if not side:
                low = high
            out.append((low, high, b, 1))
            found += 1
        elif high - low == 1 and b >= places:
            out.append((low, high, b, many - few))
            found += many - few
        else:
            if high - low == 1:
                low, high, b = 2 * low, 2 * high, b + 1
            mid = (low + high) // 2
            between = above(poly, mid, b)
            todo += [(low, mid, b, many, between), (mid, high, b, between, few)]
    return out


def null_space(a: list[list[int]], root: Fraction, count: int) -> np.ndarray:
    """Orthonormal rows that span the null space of ``a - root * I``: two inverse iterations in long fixed-point numbers."""
    d = len(a)
    shift = int(root * (1 << FRACTION))
    rng = np.random.default_rng(5)
    vectors = [[int(v) << FRACTION for v in rng.integers(1, 1 << 30, count)] for _ in range(d)]
    for _ in range(2):
        m = np.array([[v << FRACTION for v in row] + vectors[i] for i, row in enumerate(a)], object)
        for k in range(d):
            m[k, k] -= shift
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(m[k + i, k]))
            if pivot != k:
                m[[k, pivot]] = m[[pivot, k]]
            if m[k, k] == 0:
                m[k, k] = 1  # the smallest number there is
            f = (m[k + 1 :, k] << FRACTION) // m[k, k]
            m[k + 1 :, k:] -= (f[:, None] * m[k, k:]) >> FRACTION
        solved = np.zeros((d, count), object)
        for k in range(d - 1, -1, -1):
            rest = m[k, d:] - ((m[k, k + 1 : d, None] * solved[k + 1 :]).sum(axis=0) >> FRACTION if k < d - 1 else 0)
            solved[k] = (rest << FRACTION) // m[k, k]
        for c in range(count):  # orthogonal and of size 1, still in fixed-point numbers
            for o in range(c):
                dot = (solved[:, c] * solved[:, o]).sum() >> FRACTION
                solved[:, c] -= (dot * solved[:, o]) >> FRACTION
            length = math.isqrt(int((solved[:, c] * solved[:, c]).sum()))
            solved[:, c] = (solved[:, c] << FRACTION) // max(length, 1)
        vectors = solved.tolist()
    return np.array([[v / (1 << FRACTION) for v in row] for row in solved.tolist()], float).T


def eigen(spark: SparkSession, a: list[list[int]], most: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest positive eigenvalues of ``a``, falling, and their unit vectors as rows; one task a distinct root."""
    trace = sum(a[k][k] for k in range(len(a)))
    if trace == 0:
        return [], np.zeros((0, len(a)))
    poly = characteristic(spark, a)
    rank = len(a) - next(k for k, c in enumerate(poly) if c)
    spots = [(Fraction(low + high, 2 << b), count) for low, high, b, count in largest_roots(poly, min(most, rank), trace)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = null_space(a, *spots[k])
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([found.ravel().tolist()], pa.list_(pa.float64()))], names=["k", "v"])

    vectors = dict(map(tuple, spark.range(0, len(spots), 1, len(spots)).mapInArrow(run, "k long, v array<double>").collect()))
    values = [value for value, count in spots for _ in range(count)]
    rows = np.concatenate([np.array(vectors[k]).reshape(-1, len(a)) for k in range(len(spots))])
    return values[:most], rows[:most]


class Projection:
    """Deviation from the mean, exact, and the whitened components of packed rows."""

    def __init__(self, n: int, sums: list[int], values: list[Fraction], vectors: np.ndarray):
        self.n, self.sums = n, sums
        # eigenvalues of A are n * n times those of V, and rows come n times too large
        self.factors = (vectors / np.array([math.sqrt(v) for v in values])[:, None]).T

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * x - S, which the offset doesn't change."""
        if (int(np.abs(y).max()) + 1) * self.n * 2 < 1 << 62:
            return self.n * y - np.array(self.sums, np.int64)
        return self.n * y.astype(object) - np.array(self.sums, object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return deviations.astype(float) @ self.factors

    @staticmethod
    def squares(deviations: np.ndarray) -> list[int]:
        if deviations.dtype == object or int(np.abs(deviations).max()) >= 1 << 50:
            wide = deviations.astype(object)
            return [int(v) for v in (wide * wide).sum(axis=1)]
        high, low = deviations >> 24, deviations & ((1 << 24) - 1)
        parts = [(p * q).sum(axis=1).astype(object) for p, q in ((high, high), (high, low), (low, low))]
        return [int(v) for v in (parts[0] << 48) + (parts[1] << 25) + parts[2]]


def identity_error(fit: DataFrame, project: Projection, d: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance, centred before multiplying, minus the identity."""
    k = project.factors.shape[1]

    def summed(measure, width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH):
                    total += measure(project.whitened(project.deviations(unpacked(batch.column(0).slice(at, BATCH), d))))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["at", "x"])

        out = np.zeros(width)
        for at, x in fit.select("x").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x")).collect():
            out[at] = x
        return out / project.n

    mean = summed(lambda w: w.sum(axis=0), k)
    covariance = summed(lambda w: ((w - mean).T @ (w - mean)).ravel(), k * k).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each row that takes part and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is null beyond 38 digits.
    """
    spark = df.sparkSession
    none = spark.createDataFrame([], SCHEMA)
    widths = df.select(F.size(vector).alias("d")).filter("d > 0").groupBy("d").count()
    common = widths.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return none
    d = common[0]
    rows = integers(df, d, key, vector)
    fit = materialize(rows.select("x").distinct(), "fit-list")
    n, sums, sum_products = scatter(fit, d)
    a = [[n * sum_products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    values, vectors = eigen(spark, a, most)
    if not values:
        return none
    project = Projection(n, sums, values, vectors)
    error = identity_error(fit, project, d)
    trace = sum(a[k][k] for k in range(d))
    explained = F.array(*[F.lit(float(v / trace)) for v in values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                deviations = project.deviations(unpacked(part.column(1), d))
                squares = [Decimal(v) if v < 10**38 else None for v in project.squares(deviations)]
                white = project.whitened(deviations)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(squares, pa.decimal128(38, 0)), pa.array(list(white), pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "white"])

    found = rows.mapInArrow(run, "vec_id long, deviation decimal(38,0), white array<double>")
    found = found.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return found.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
