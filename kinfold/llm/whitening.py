"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Components become whole numbers, so counts, sums and cross products over all vectors are exact however the rows are
spread. The scatter n * sum(x x') - S S' is an integer matrix. Its characteristic polynomial is found modulo many
primes, each by reduction to Hessenberg form in a task of its own, and put together by Chinese remaindering. All roots are real,
so the number of roots above a point is the number of sign changes after moving the origin there (Descartes' rule is exact then);
halving intervals isolates the largest roots, signs of the polynomial refine them. Components follow by inverse iteration into
the null space of scatter - root in 70-digit arithmetic, one task per root; roots that stay together share a block.

Rows are read three times and never shuffled. What the driver and the tasks share depends on the number of
dimensions alone: a row per matrix cell, a polynomial per prime, a component per root.
"""

from __future__ import annotations

import decimal
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.vector_codes import finite_vectors

SCALE = 64
COMPONENTS = 32
LARGEST = 1 << 26
DIGITS = 70
# Roots are known to this many bits; roots that agree in more are one multiple root.
ROOT_BITS, SAME_BITS = 130, 110
STEPS = 4


def whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return whole(np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, length))


def _moments(batches, length: int):
    """Cells of the cross products of (1, y) over the task, in two halves of 32 bits each, so that no sum overflows."""
    low, high = np.zeros((length + 1, length + 1), np.int64), np.zeros((length + 1, length + 1), np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << 10):
            part = batch.slice(start, 1 << 10)
            y = np.column_stack([np.ones(part.num_rows, np.int64), _matrix(part, length)])
            if int(np.abs(y).max()) ** 2 * len(y) < 1 << 53:
                cells = (y.T.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
            else:
                cells = y.T @ y
            low += cells & 0xFFFFFFFF
            high += cells >> 32
    i, j = np.triu_indices(length + 1)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(low[i, j]), pa.array(high[i, j])],
                                     ["i", "j", "low", "high"])


def moments(vectors: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums and cross products of their whole components, exact."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    cells = vectors.select("vector").mapInArrow(
        lambda batches: _moments(batches, length), "i int, j int, low bigint, high bigint").groupBy("i", "j").agg(
        total("low"), total("high"))
    found = [[0] * (length + 1) for _ in range(length + 1)]
    for cell in cells.collect():  # (length + 1)(length + 2) / 2 rows
        found[cell.i][cell.j] = found[cell.j][cell.i] = (int(cell.high) << 32) + int(cell.low)
    return found[0][0], found[0][1:], [row[1:] for row in found[1:]]


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    return [[n * products[i][j] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]


def _is_prime(n: int) -> bool:
    """Miller-Rabin with the bases that decide every number below 3.4e14."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17):
        power = pow(base, odd, n)
        if power not in (1, n - 1) and all((power := power * power % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bits: float) -> list[int]:
    """Primes below 2^31 whose product has more than ``bits`` bits."""
    found, candidate, have = [], (1 << 31) - 1, 0.0
    while have <= bits:
        if _is_prime(candidate):
            found.append(candidate)
            have += math.log2(candidate)
        candidate -= 2
    return found


def coefficient_bits(matrix: list[list[int]]) -> float:
    """Bits that hold every coefficient: the k-th is at most C(d, k) (trace / d)^k, as no root is negative."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if trace == 0:
        return 2.0
    ways = lambda k: (math.lgamma(d + 1) - math.lgamma(k + 1) - math.lgamma(d - k + 1)) / math.log(2)
    return max(ways(k) + k * (math.log2(trace) - math.log2(d)) for k in range(d + 1)) + 4


def hessenberg(h: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo p without entries below the first subdiagonal."""
    d = len(h)
    for j in range(d - 2):
        below = np.flatnonzero(h[j + 1:, j])
        if not len(below):
            continue
        if below[0]:
            i = j + 1 + below[0]
            h[[i, j + 1]] = h[[j + 1, i]]
            h[:, [i, j + 1]] = h[:, [j + 1, i]]
        factors = h[j + 2:, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2:] = (h[j + 2:] - factors[:, None] * h[j + 1] % p) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2:] * factors % p).sum(1)) % p
    return h


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo p, the leading one first."""
    h = hessenberg(matrix % p, p)
    d = len(h)
    # Row k is the polynomial of the leading k x k block, constant term first.
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        weights, path = np.zeros(k, np.int64), 1
        weights[k - 1] = h[k - 1, k - 1]
        for i in range(k - 1, 0, -1):
            path = path * int(h[i, i - 1]) % p
            weights[i - 1] = int(h[i - 1, k - 1]) * path % p
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(0)) % p
    return polys[d, ::-1].tolist()


def _polynomials(batches, matrix: list[list[int]]):
    for batch in batches:
        for p in batch.column("p").to_pylist():
            residues = np.array([[v % p for v in row] for row in matrix], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(residues, p)], pa.list_(pa.int64()))],
                                             ["p", "residues"])


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), the leading one first, for an integer matrix without negative roots."""
    primes = primes_beyond(coefficient_bits(matrix))
    shared = spark.sparkContext.broadcast(matrix)
    frame = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), 64), "p")
    rows = frame.mapInArrow(lambda batches: _polynomials(batches, shared.value), "p bigint, residues array<bigint>").collect()
    modulus, found = 1, [0] * (len(matrix) + 1)
    for row in rows:
        inverse = pow(modulus, -1, row.p)
        # The k-th coefficient has the sign of (-1)^k: its absolute value is put together.
        for k, r in enumerate(row.residues):
            r = -r if k % 2 else r
            found[k] += modulus * ((r - found[k]) * inverse % row.p)
        modulus *= row.p
    return [-c if k % 2 else c for k, c in enumerate(found)]


def _scaled(coefficients: list[int], s: int) -> list[int]:
    """The polynomial whose roots are 2^s times as large."""
    return [c << (s * k) for k, c in enumerate(coefficients)]


def roots_above(coefficients: list[int], m: int, s: int = 0) -> int:
    """Number of roots beyond m / 2^s, repeated ones as often as they occur."""
    b = _scaled(coefficients, s)
    d = len(b) - 1
    for i in range(d):
        for j in range(1, d - i + 1):
            b[j] += m * b[j - 1]
    signs = [c > 0 for c in b if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def isolate(coefficients: list[int], wanted: int) -> list[tuple[int, int, int, int]]:
    """Intervals (low, high, s, roots) that hold the ``wanted`` largest positive roots, falling: low / 2^s < root <= high / 2^s."""
    found, seen = [], 0
    top = 1 << max(1, (-coefficients[1]).bit_length() + 1)  # beyond the sum of the roots
    todo = [(0, top, 0, roots_above(coefficients, 0), 0)]
    while todo and seen < wanted:
        low, high, s, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if inside == 0:
            continue
        if inside == 1 or (high - low) << SAME_BITS <= high:
            found.append((low, high, s, inside))
            seen += inside
            continue
        if high - low == 1:
            low, high, s = 2 * low, 2 * high, s + 1
        middle = (low + high) // 2
        above = roots_above(coefficients, middle, s)
        todo += [(low, middle, s, above_low, above), (middle, high, s, above, above_high)]
    return found


def refine(coefficients: list[int], low: int, high: int, s: int) -> tuple[int, int]:
    """The single root of an interval as (m, s) for m / 2^s, right to ``ROOT_BITS`` bits."""
    def sign(m: int, scaled: list[int]) -> int:
        value = reduce(lambda total, c: total * m + c, scaled)
        return (value > 0) - (value < 0)

    scaled = _scaled(coefficients, s)
    at_high = sign(high, scaled)
    while at_high and (high - low) << ROOT_BITS > high:
        if high - low < 1 << 16:
            low, high, s = low << 16, high << 16, s + 16
            scaled = _scaled(coefficients, s)
        middle = (low + high) // 2
        at_middle = sign(middle, scaled)
        if at_middle == at_high:
            high = middle
        elif at_middle:
            low = middle
        else:
            return middle, s
    return high, s


def null_vectors(matrix: list[list[int]], m: int, s: int, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors that matrix - m / 2^s takes nearest to zero, by inverse iteration."""
    with decimal.localcontext(prec=DIGITS):
        d, root = len(matrix), decimal.Decimal(m) / (1 << s)
        a = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
        largest = max(abs(v) for v in a.ravel())
        least = largest * decimal.Decimal(10) ** (1 - DIGITS)
        for i in range(d):
            a[i, i] -= root
        order = np.arange(d)
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
            if abs(a[k, k]) < least:
                a[k, k] = least
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        # Any start will do; this one is the same on every machine and has no zero.
        start = np.random.default_rng(d).integers(1, 1 << 20, (count, d))
        vectors = [np.array([decimal.Decimal(int(v)) for v in row], object) for row in start]
        for _ in range(STEPS):
            done = []
            for v in vectors:
                z = v[order]
                for i in range(1, d):
                    z[i] -= a[i, :i] @ z[:i]
                for i in range(d - 1, -1, -1):
                    z[i] = (z[i] - (a[i, i + 1:] @ z[i + 1:] if i + 1 < d else 0)) / a[i, i]
                z = z / max(abs(x) for x in z)
                for _ in range(2):
                    for u in done:
                        z = z - (u @ z) * u
                done.append(z / (z @ z).sqrt())
            vectors = done
        out = []
        for v in vectors:
            first = max(range(d), key=lambda i: abs(v[i]))
            out.append([float(x) for x in (v if v[first] > 0 else -v)])
        return out


def _null_vectors(batches, matrix: list[list[int]]):
    for batch in batches:
        for row in batch.to_pylist():
            for k, vector in enumerate(null_vectors(matrix, int(row["m"]), row["s"], row["roots"])):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["place"] + k], pa.int32()), pa.array([vector], pa.list_(pa.float64()))], ["place", "vector"])


class Whitening:
    """Fitted on n vectors: sums, and for each component its unit vector, eigenvalue and share of the trace."""

    def __init__(self, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.vectors, self.values, self.explained = n, sums, vectors, values, explained

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n y - S, exact, as 64-bit numbers where they fit."""
        if self.n * LARGEST < 1 << 62:
            return self.n * y - np.array(self.sums, np.int64)
        return self.n * y.astype(object) - np.array(self.sums, object)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, length: int, components: int = COMPONENTS) -> Whitening:
    """Whitening from all of ``vectors`` (column vector, all of this length)."""
    spark = vectors.sparkSession
    n, sums, products = moments(vectors, length)
    matrix = scatter(n, sums, products)
    common = math.gcd(*[v for row in matrix for v in row])
    if not common:
        return Whitening(n, sums, np.zeros((length, 0)), np.zeros(0), np.zeros(0))
    matrix = [[v // common for v in row] for row in matrix]
    polynomial = characteristic_polynomial(spark, matrix)
    places, roots = [], []
    for low, high, s, inside in isolate(polynomial, components):
        m, s = refine(polynomial, low, high, s) if inside == 1 else (low + high, s + 1)
        places.append((len(roots), str(m), s, inside))
        roots += [(m, s)] * inside
    shared = spark.sparkContext.broadcast(matrix)
    frame = spark.createDataFrame(places, "place int, m string, s int, roots int").repartition(len(places), "place")
    rows = frame.mapInArrow(lambda batches: _null_vectors(batches, shared.value), "place int, vector array<double>").collect()
    unit = np.array([r.vector for r in sorted(rows, key=lambda r: r.place)])[:components].T
    roots, trace = roots[:components], sum(matrix[i][i] for i in range(length))
    # Quotients of whole numbers are rounded once.
    values = np.array([m * common / ((n * n) << s) for m, s in roots])
    return Whitening(n, sums, unit, values, np.array([m / (trace << s) for m, s in roots]))


def _products(batches, fitted: Whitening, length: int):
    """Sums and cross products of whitened components over the task."""
    size = len(fitted.values)
    total = np.zeros((size + 1, size + 1))
    for batch in batches:
        if batch.num_rows:
            w = fitted.project(fitted.deviations(_matrix(batch, length)))
            w = np.column_stack([np.ones(len(w)), w])
            total += w.T @ w
    i, j = np.triu_indices(size + 1)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"])


def identity_error(vectors: DataFrame, fitted: Whitening, length: int) -> float:
    """Largest absolute entry of the covariance of all whitened vectors minus the identity.

    Whitened vectors are centred before they are multiplied; what rounding leaves of their mean is taken off.
    """
    size = len(fitted.values)
    cells = vectors.select("vector").mapInArrow(
        lambda batches: _products(batches, fitted, length), "i int, j int, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total"))
    total = np.zeros((size + 1, size + 1))
    for cell in cells.collect():  # (components + 1)(components + 2) / 2 rows
        total[cell.i, cell.j] = total[cell.j, cell.i] = cell.total
    mean = total[0, 1:] / fitted.n
    return float(np.abs(total[1:, 1:] / fitted.n - np.outer(mean, mean) - np.eye(size)).max())


def _whitened(batches, fitted: Whitening, length: int):
    size = len(fitted.values)
    for batch in batches:
        if not batch.num_rows:
            continue
        deviations = fitted.deviations(_matrix(batch, length))
        if deviations.dtype != object and int(np.abs(deviations).max()) ** 2 * length < 1 << 63:
            squares = pa.array((deviations * deviations).sum(1)).cast(pa.decimal128(38, 0))
        else:
            own = (deviations.astype(object) ** 2).sum(1)
            squares = pa.array([decimal.Decimal(v) for v in own], pa.decimal128(38, 0))
        values = fitted.project(deviations)
        rows = pa.array(np.repeat(np.arange(len(values)), size))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(rows), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(values))),
             squares.take(rows), pa.array(values.ravel()), pa.array(np.tile(fitted.explained, len(values)))],
            ["vec_id", "component", "deviation", "whitened", "explained"])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per finite vector of ``vectors`` (vec_id, embedding; other columns are ignored) and component.

    vec_id, component (from 1, by falling eigenvalue), n, deviation (sum of (n x - S)^2, exact), whitened (the centred
    vector on the component's unit vector, over the root of its eigenvalue), explained (share of the trace) and
    identity_error, where x = floor(64 c) + a constant, which no result depends on.

    Rows with a null vector or one with null or non-finite components are left out. The fit takes the vectors of the most
    common length (the shortest of equally common ones); those of another length are left out too. Components
    with eigenvalue 0 can't be whitened and have no rows, so equal vectors, a single one or an empty table give none.
    The sign of a component makes its largest entry positive. Repeated rows count as often as they occur; a null id
    stays null. Components are set to the range of +-2^20.
    """
    spark = vectors.sparkSession
    kept = finite_vectors(vectors).select("vec_id", F.col("embedding").alias("vector"))
    usual = kept.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").head(1)
    length = usual[0].length if usual else 0
    kept = kept.filter(F.size("vector") == length)
    fitted = fit(kept, length, components) if length else None
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
                                         "explained double, identity_error double")
    error = identity_error(kept, fitted, length)
    rows = kept.mapInArrow(
        lambda batches: _whitened(batches, fitted, length),
        "vec_id bigint, component int, deviation decimal(38,0), whitened double, explained double")
    return rows.select("vec_id", "component", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
                       F.lit(error).alias("identity_error"))
