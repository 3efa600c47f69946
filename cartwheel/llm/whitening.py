"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

1. Every entry c of a vector becomes the integer x = floor(64 c) + 1000000.  Spark tasks add up the products of
   x - 1000000 exactly (blocks of rows as one matrix product of 20-bit digits, which doubles hold exactly), two exchanges
   merge the matrix rows, and d x d integers reach the driver: n, S and the scatter n * sum(x x') - S S' = n^2 V.
2. The scatter's characteristic polynomial is computed modulo primes below 2^31 (Hessenberg reduction, one Spark row
   per group of primes) and joined by the Chinese remainder theorem; Maclaurin's inequality bounds the coefficients.
3. One Spark row per component: all roots are real, so the sign variations of the polynomial shifted by a (Descartes)
   count the roots above a exactly.  Bisection isolates the k-th largest root, further bisection by sign gives
   ``ROOT_BITS`` bits; roots equal to that precision are one eigenspace, whose basis all of its components share.
   Inverse iteration in 120-digit decimals finds the null space.
4. A second scan whitens every vector and measures the covariance of the result; a third returns the rows.

Driver and closures hold d x d integers and d polynomial coefficients; nothing there grows with the number of rows.

Defined results: vectors that are null or hold null, NaN or infinite entries take no part; neither do those whose length
is not the most frequent one (the longer of equally frequent ones).  64 c beyond +-2^62 counts as +-2^62.  Components
of eigenvalue 0 are left out, so a constant table, one of a single vector and an empty one give no row.  Rows with a
null or repeated id are rows of their own; other columns are ignored.  A deviation beyond 64 bits is null, and then
``deviation_digits`` (else null) has it in decimal.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 64
COMPONENTS = 32
ROOT_BITS = 192       # of a root, counted from the trace's highest bit
DIGITS = 120          # of the decimals of the inverse iteration
PRIMES_A_ROW = 16
_DIGIT = 20           # bits of a digit of an entry; 4,096 rows of products of two stay below 2**52
_BLOCK_ROWS = 4096
_LIMIT = float(1 << 62)


# ---------------------------------------------------------------- vectors and sums

def _finite(column: str):
    return F.col(column).isNotNull() & F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def usable(vectors: DataFrame, vec_col: str) -> tuple[DataFrame, int]:
    """Rows that take part, and their dimension."""
    good = vectors.where(_finite(vec_col) & (F.size(vec_col) > 0))
    most = good.groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return good.where(F.size(vec_col) == d), d


def _entries(column: pa.Array, d: int) -> np.ndarray:
    """(rows, d) of floor(64 c) as int64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * flat), -_LIMIT, _LIMIT).astype(np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact z'z of z = (y, 1) as Python integers."""
    total = None
    for lo in range(0, len(y), _BLOCK_ROWS):
        z = np.hstack([y[lo:lo + _BLOCK_ROWS], np.ones((len(y[lo:lo + _BLOCK_ROWS]), 1), np.int64)])
        digits, rest = [], z
        while True:  # signed digits of 20 bits, the lowest first
            low = ((rest + (1 << (_DIGIT - 1))) & ((1 << _DIGIT) - 1)) - (1 << (_DIGIT - 1))
            digits.append(low.astype(np.float64))
            rest = (rest - low) >> _DIGIT
            if not rest.any():
                break
        for a, p in enumerate(digits):
            for b, q in enumerate(digits):
                part = (p.T @ q).astype(np.int64).astype(object) * (1 << (_DIGIT * (a + b)))
                total = part if total is None else total + part
    return total


def _moments(rows: DataFrame, vec_col: str, products: Callable[[np.ndarray], np.ndarray], d: int, number: type) -> list[list]:
    """Sum over all rows of ``products`` (a square matrix a block), merged by matrix row in two exchanges."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                part = products(_entries(batch.column(0), d))
                total = part if total is None else total + part
        if total is not None:
            salt = TaskContext.get().partitionId() % 64
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([salt] * len(total), pa.int32()),
                                   pa.array([" ".join(map(repr, r)) for r in total.tolist()])], ["i", "salt", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for i, cells in zip(batch.column("i").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                row = list(map(number, cells.split()))
                sums[i] = [a + b for a, b in zip(sums[i], row, strict=True)] if i in sums else row
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([0] * len(sums), pa.int32()),
                                   pa.array([" ".join(map(repr, r)) for r in sums.values()])], ["i", "salt", "cells"])

    shape = "i int, salt int, cells string"
    parts = rows.select(vec_col).mapInArrow(partial, shape)
    merged = parts.repartition("i", "salt").mapInArrow(merge, shape).repartition("i").mapInArrow(merge, shape)
    return [list(map(number, r["cells"].split())) for r in merged.orderBy("i").collect()]  # a matrix: its size is the dimension's


@dataclass
class Scatter:
    """n, the sums S of x - 1000000, and the integer matrix n^2 V of ``n`` vectors."""
    n: int
    sums: list[int]
    matrix: list[list[int]]

    @property
    def trace(self) -> int:
        return sum(self.matrix[i][i] for i in range(len(self.matrix)))


def scatter(rows: DataFrame, vec_col: str, d: int) -> Scatter:
    z = _moments(rows, vec_col, _products, d, int)
    n, s = z[d][d], z[d][:d]
    return Scatter(n, s, [[n * z[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)])


# ---------------------------------------------------------------- characteristic polynomial

def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    small = np.ones(math.isqrt(top) + 2, bool)
    small[:2] = False
    for k in range(2, math.isqrt(len(small)) + 1):
        if small[k]:
            small[k * k::k] = False
    divisors = np.flatnonzero(small)
    found: list[int] = []
    hi = top
    while len(found) < count and hi > 2:
        lo = max(2, hi - (1 << 14))
        alive = np.ones(hi - lo, bool)
        for q in divisors[divisors < hi]:
            first = max(q * q, -(-lo // q) * q)
            alive[first - lo::q] = False
        found += (lo + np.flatnonzero(alive)[::-1]).tolist()
        hi = lo
    return found[:count]


def _power(base: np.ndarray, e: np.ndarray, p: np.ndarray) -> np.ndarray:
    out, e = np.ones_like(base), e.copy()
    while e.any():
        out = np.where(e & 1, out * base % p, out)
        base = base * base % p
        e >>= 1
    return out


def charpoly_mod(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients, constant first, of det(x - matrix) modulo every prime below 2**31: (primes, d + 1)."""
    d = len(matrix)
    a = np.array([[[c % p for c in row] for row in matrix] for p in primes], np.int64).reshape(len(primes), d, d)
    p = np.array(primes, np.int64)
    each = np.arange(len(primes))
    p2, p3 = p[:, None], p[:, None, None]
    for k in range(1, d - 1):
        pivot = k + (a[:, k:, k - 1] != 0).argmax(axis=1)
        a[each, k], a[each, pivot] = a[each, pivot], a[each, k].copy()
        a[each, :, k], a[each, :, pivot] = a[each, :, pivot], a[each, :, k].copy()
        u = a[:, k + 1:, k - 1] * _power(a[:, k, k - 1], p - 2, p)[:, None] % p2
        a[:, k + 1:] = (a[:, k + 1:] + (p2 - u)[:, :, None] % p3 * a[:, k, None]) % p3
        a[:, :, k] = (a[:, :, k] + (a[:, :, k + 1:] * u[:, None] % p3).sum(axis=2)) % p2
    poly = np.zeros((d + 1, len(primes), d + 1), np.int64)
    poly[0, :, 0] = 1
    for k in range(1, d + 1):
        new = -(a[:, k - 1, k - 1][:, None] * poly[k - 1] % p2)
        new[:, 1:] += poly[k - 1][:, :-1]
        chain = np.ones(len(primes), np.int64)
        for i in range(1, k):
            chain = chain * a[:, k - i, k - i - 1] % p
            new -= (a[:, k - 1 - i, k - 1] * chain % p)[:, None] * poly[k - 1 - i] % p2
        poly[k] = new % p2
    return poly[d]


def charpoly(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant first, of det(x - matrix) of a positive semidefinite integer matrix."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    mean = -(-trace // d)
    bound = max(math.comb(d, k) * mean ** k for k in range(d + 1))  # Maclaurin: e_k <= C(d, k) (trace / d)^k
    need = (2 * bound).bit_length() // 30 + 1   # every prime taken is above 2**30
    primes = primes_below(1 << 31, need)
    groups = [(g, primes[g:g + PRIMES_A_ROW]) for g in range(0, need, PRIMES_A_ROW)]

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.record_batch([pa.array([g]), pa.array([charpoly_mod(matrix, group).tolist()])], ["g", "rows"])

    found = (spark.createDataFrame(groups, "g long, primes array<long>").repartition(len(groups), "g")
             .mapInArrow(residues, "g long, rows array<array<long>>").collect())
    by_group = {r["g"]: r["rows"] for r in found}
    rows = [row for g, _ in groups for row in by_group[g]]
    whole = math.prod(primes)
    parts = [(whole // p) * pow(whole // p, -1, p) for p in primes]
    out = []
    for j in range(d + 1):
        c = sum(r[j] * e for r, e in zip(rows, parts, strict=True)) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


# ---------------------------------------------------------------- roots and null spaces

class Roots:
    """Exact counts of the roots, all real and not negative, of an integer polynomial, on a grid of 2**-shift."""

    def __init__(self, coefficients: list[int], trace: int, bits: int = ROOT_BITS):
        self.d = len(coefficients) - 1
        self.shift = max(0, bits - trace.bit_length())
        self.scaled = [c << (self.shift * (self.d - j)) for j, c in enumerate(coefficients)]
        self.top = (trace << self.shift) + 1
        self.rank = self.d - next(j for j, c in enumerate(coefficients) if c)

    def above(self, a: int) -> int:
        """Roots greater than a / 2**shift, with multiplicity: sign variations of the shifted polynomial."""
        b = list(self.scaled)
        for i in range(self.d):
            carry = b[self.d]
            for j in range(self.d - 1, i - 1, -1):
                carry = b[j] = b[j] + a * carry
        signs = [c > 0 for c in b if c]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, a: int) -> int:
        v = 0
        for c in reversed(self.scaled):
            v = v * a + c
        return (v > 0) - (v < 0)

    def find(self, k: int) -> tuple[int, int, int]:
        """(grid value, first, size): the k-th largest root, rounded up, and the roots equal to it on the grid."""
        lo, hi = -1, self.top          # above(lo) >= k > above(hi)
        over, under = self.d, 0        # above(lo), above(hi)
        while hi - lo > 1 and over - under > 1:
            mid = (lo + hi) // 2
            count = self.above(mid)
            if count >= k:
                lo, over = mid, count
            else:
                hi, under = mid, count
        if hi - lo > 1:                # one simple root in (lo, hi]
            right = -1 if under % 2 else 1
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if self.sign(mid) in (0, right):
                    hi = mid
                else:
                    lo = mid
        return hi, under + 1, over - under


def _solve(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    d = len(lu)
    x = b[order].copy()
    for i in range(1, d):
        x[i] -= lu[i, :i] @ x[:i]
    for i in range(d - 1, -1, -1):
        if i < d - 1:
            x[i] -= lu[i, i + 1:] @ x[i + 1:]
        x[i] /= lu[i, i]
    return x


def _factor(a: np.ndarray, least: decimal.Decimal) -> list[int]:
    """LU with row exchanges in place; a pivot of 0 becomes ``least``."""
    order = list(range(len(a)))
    for k in range(len(a)):
        pivot = max(range(k, len(a)), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if not a[k, k]:
            a[k, k] = least
        a[k + 1:, k] /= a[k, k]
        a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
    return order


def null_space(matrix: list[list[int]], root: decimal.Decimal, size: int, rounds: int = 3) -> np.ndarray:
    """Orthonormal basis (size, d) of the eigenspace at ``root``; every vector's largest entry is positive."""
    d = len(matrix)
    a = np.array([[decimal.Decimal(c) for c in row] for row in matrix], object).reshape(d, d)
    norm = max(abs(c) for c in a.ravel())
    for i in range(d):
        a[i, i] -= root
    order = _factor(a, norm.scaleb(-DIGITS))
    basis = np.array([[decimal.Decimal(1 + (7919 * (i + 1) * (k + 3) + k * k) % 1009) for i in range(d)] for k in range(size)], object)
    for _ in range(rounds):
        for k in range(size):
            v = _solve(a, order, basis[k])
            v = v / max(abs(c) for c in v)
            for _ in range(2):
                for other in basis[:k]:
                    v = v - (v @ other) * other
            basis[k] = v / (v @ v).sqrt()
    for k in range(size):
        if basis[k][max(range(d), key=lambda i: (abs(basis[k][i]), -i))] < 0:
            basis[k] = -basis[k]
    return basis


@dataclass
class Components:
    vectors: np.ndarray   # (components, d) unit rows
    values: np.ndarray    # eigenvalues of V, falling
    explained: np.ndarray


def components(spark: SparkSession, fit: Scatter, most: int = COMPONENTS) -> Components:
    """The ``most`` largest principal components with a positive eigenvalue, one Spark row each."""
    d, trace, matrix = len(fit.matrix), fit.trace, fit.matrix
    if fit.n == 0 or trace == 0:
        return Components(np.zeros((0, d)), np.zeros(0), np.zeros(0))
    poly = charpoly(spark, matrix)
    count = min(most, Roots(poly, trace).rank)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal.setcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN))
        roots = Roots(poly, trace)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                at, first, size = roots.find(k)
                root = decimal.Decimal(at) / (1 << roots.shift)
                v = null_space(matrix, root, size)[k - first]
                yield pa.record_batch([pa.array([k]), pa.array([str(root)]), pa.array([[float(c) for c in v]])], ["k", "root", "v"])

    rows = (spark.range(1, count + 1).repartition(count, "id").mapInArrow(solve, "k long, root string, v array<double>")
            .orderBy("k").collect())  # at most ``most`` rows of d numbers
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        values = [decimal.Decimal(r["root"]) for r in rows]
        return Components(np.array([r["v"] for r in rows]), np.array([float(v / fit.n ** 2) for v in values]), np.array([float(v / trace) for v in values]))


# ---------------------------------------------------------------- whitening

def _centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: int64 where that holds it, else Python integers."""
    if len(y) and int(np.abs(y).max()) * n + max(map(abs, sums)) >= 1 << 62:
        return y.astype(object) * n - np.array(sums, object)
    return y * n - np.array(sums, np.int64)


def _whitened(c: np.ndarray, n: int, comp: Components) -> np.ndarray:
    return ((c / n).astype(np.float64) @ comp.vectors.T) / np.sqrt(comp.values)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_digits): a row a vector and component."""
    spark = vectors.sparkSession
    rows, d = usable(vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "v")
    out = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_digits string"
    if d == 0:
        return spark.createDataFrame([], out)
    fit = scatter(rows, "v", d)
    comp = components(spark, fit, most)
    k, n, sums = len(comp.values), fit.n, fit.sums
    if k == 0:
        return spark.createDataFrame([], out)

    def spread(y: np.ndarray) -> np.ndarray:
        w = _whitened(_centred(y, n, sums), n, comp)
        w = np.hstack([w, np.ones((len(w), 1))])
        return w.T @ w

    z = np.array(_moments(rows, "v", spread, d, float))
    mean = z[k, :k] / n
    error = float(np.abs(z[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):  # a row becomes ``k`` rows
                batch = whole.slice(lo, 2048)
                c = _centred(_entries(batch.column("v"), d), n, sums)
                if c.dtype == object or int(np.abs(c).max()) ** 2 * d >= 1 << 63:
                    exact = [sum(e * e for e in row) for row in c.astype(object).tolist()]
                else:
                    exact = (c * c).sum(axis=1).tolist()
                short = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
                digits = pa.array([str(e) if e >= 1 << 63 else None for e in exact], pa.string())
                rep = pa.array(np.repeat(np.arange(batch.num_rows), k))
                size = batch.num_rows * k
                yield pa.record_batch([batch.column("id").take(rep), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                                       pa.array(np.full(size, n)), short.take(rep), pa.array(_whitened(c, n, comp).ravel()),
                                       pa.array(np.tile(comp.explained, batch.num_rows)), pa.array(np.full(size, error)), digits.take(rep)],
                                      [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return rows.mapInArrow(project, out)
