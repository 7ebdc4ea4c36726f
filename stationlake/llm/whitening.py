"""Embedding whitening by the exact characteristic polynomial of the scatter matrix.

Entries become integers x = floor(1024 c) + 100000, so sums and products are exact. With n vectors, S their sums
and M = n * sum(x x^T) - S S^T (an integer matrix, n^2 times the covariance V):

1. Tasks add up sums and products of their rows; Spark adds these in limbs of 40 bits, at any size.
2. The characteristic polynomial of M is computed modulo many primes, each by reduction to Hessenberg form
   and its recurrence (Spark deals the primes to tasks), and put together by Chinese remaindering; the
   primes' product exceeds every coefficient's bound, so the polynomial is exact.
3. All roots are real. For such a polynomial the sign changes of p(x + a) count its roots above a exactly, so
   the largest roots are isolated by halving dyadic intervals, then narrowed by the sign of p, all in integers,
   to ``BITS`` bits. Equal roots never come apart and share one value.
4. A component is the null vector of M - root: inverse iteration on an LU factorisation in ``DIGITS`` decimal digits,
   made orthogonal to earlier components.
5. Rows are projected in double precision; one more pass measures the covariance of the result.

Rows whose vector is null or has a null or non-finite entry are dropped; rows with equal ids or vectors count each.
A vector shorter than the longest one is filled up with entries of 0. Components without variance
(equal vectors, fewer vectors than dimensions) have ``whitened`` and ``explained`` 0 and are left out of ``identity_error``, which is 0
if none is left. ``deviation`` is null where it does not fit a long; ``deviation_exact`` has it up to 38 digits. An empty table, or
vectors without entries, give an empty result.

What the driver holds is a matrix of d x d integers. Its share grows with d alone, not with the rows: the factorisations
take about d^3 / 3 decimal operations each, counting roots d^2 / 2 additions of integers of d * log2(trace) bits.
"""

from __future__ import annotations

import decimal
import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Bits of a root (below the leading one), decimal digits of the factorisation.
BITS, DIGITS = 256, 100
#: Bits of a limb of an exact sum; primes of a task.
LIMB, PRIMES = 40, 16
_EXACT = 1 << 53


def fitting(table: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows that take part, their vector as ``_c`` of doubles."""
    c = F.col(column).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return table.withColumn("_c", c).where(F.col("_c").isNotNull() & finite)


def _matrix(batch: pa.Array, d: int):
    """The x - OFFSET of each row as an int64 matrix if its entries are small, the other rows as lists of ints."""
    c = np.zeros((len(batch), d))
    lengths = np.diff(batch.offsets.to_numpy())
    inside = np.arange(d) < lengths[:, None]
    c[inside] = batch.flatten().to_numpy(zero_copy_only=False)
    small = (np.abs(c) < 2.0 ** 15).all(axis=1)
    return small, np.floor(c * np.where(small[:, None], SCALE, 0)).astype(np.int64), c


def _big(row: np.ndarray) -> list[int]:
    def scaled(c: float) -> int:
        up, down = c.as_integer_ratio()
        return up * SCALE // down

    return [scaled(float(c)) for c in row]


def _limbs(value: int):
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield k, sign * (value & (1 << LIMB) - 1)
        value >>= LIMB
        k += 1


def _moments(d: int):
    """Rows -> (i, j, limb, value): sums of products of entries i <= j, and sums of entries j as i = -1."""

    def fn(batches):
        sums, products = np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            small, y, c = _matrix(batch.column("_c"), d)
            if len(y) and small.any():
                y = y[small]
                top = int(np.abs(y).max()) or 1
                step = max(1, _EXACT // (top * top))  # products of so many rows add up exactly in doubles
                for lo in range(0, len(y), step):
                    part = y[lo:lo + step].astype(np.float64)
                    sums += part.sum(axis=0).astype(np.int64).astype(object)
                    products += (part.T @ part).astype(np.int64).astype(object)
            for row in c[~small]:
                big = np.array(_big(row), object)
                sums += big
                products += np.outer(big, big)
        rows = [(-1, j, k, v) for j in range(d) for k, v in _limbs(int(sums[j]))]
        rows += [(i, j, k, v) for i in range(d) for j in range(i, d) for k, v in _limbs(int(products[i, j]))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [()] * 4)], names=["i", "j", "limb", "value"])

    return fn


def _sums(rows: DataFrame, d: int) -> tuple[list[int], list[list[int]]]:
    """S and the sums of products, of x - OFFSET."""
    s, q = [0] * d, [[0] * d for _ in range(d)]
    total = rows.select("_c").mapInArrow(_moments(d), "i long, j long, limb long, value long") \
        .groupBy("i", "j", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    for r in total.collect():  # at most d * (d + 3) / 2 numbers in a few limbs
        value = int(r["value"]) << LIMB * r["limb"]
        if r["i"] < 0:
            s[r["j"]] += value
        else:
            q[r["i"]][r["j"]] += value
            if r["i"] != r["j"]:
                q[r["j"]][r["i"]] += value
    return s, q


def _primes(bits: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product has more than ``bits`` bits."""
    small = [p for p in range(2, 46341) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    out, have, high = [], 0.0, 1 << 31
    while have <= bits + 1:
        low = high - (1 << 16)
        sieve = np.ones(high - low, bool)
        for p in small:
            sieve[-low % p::p] = False
        found = (np.flatnonzero(sieve)[::-1] + low).tolist()
        for p in found:
            out.append(p)
            have += math.log2(p)
            if have > bits + 1:
                break
        high = low
    return out


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, from the constant on, of det(x - matrix) modulo the prime p."""
    h, d = matrix.astype(np.int64) % p, len(matrix)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factor[:, None] * h[k] % p) % p
        # the products of a row with the factors are added one residue at a time: no sum exceeds 64 bits
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factor % p).sum(axis=1)) % p
    polynomials = [np.array([1], np.int64)]
    for k in range(d):
        last = polynomials[-1]
        new = np.zeros(k + 2, np.int64)
        new[1:] = last
        new[:-1] = (new[:-1] - int(h[k, k]) * last) % p
        scale = 1
        for i in range(k - 1, -1, -1):
            scale = scale * int(h[i + 1, i]) % p
            if not scale:
                break
            f = scale * int(h[i, k]) % p
            new[:i + 1] = (new[:i + 1] - f * polynomials[i]) % p
        polynomials.append(new % p)
    return polynomials[-1].tolist()


def _residues(matrix: list[list[int]]):
    """Primes -> their residues of the polynomial."""

    def fn(frames):
        exact = np.array(matrix, object)
        for frame in frames:
            yield pd.DataFrame({"prime": frame["prime"], "residues": [hessenberg_polynomial((exact % p).astype(np.int64), p) for p in frame["prime"]]})

    return fn


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - matrix), from the constant on, of a positive semi-definite integer matrix."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # coefficients are sums of products of eigenvalues: none exceeds (1 + trace / d)^d (Maclaurin)
    bound = (1 + -(-trace // d)) ** d
    primes = _primes(bound.bit_length() + 1)
    frame = spark.createDataFrame(pd.DataFrame({"prime": primes})).repartition(math.ceil(len(primes) / PRIMES))
    found = {r["prime"]: r["residues"] for r in frame.mapInPandas(_residues(matrix), "prime long, residues array<long>").collect()}
    modulus = math.prod(primes)
    out = [0] * (d + 1)
    for p in primes:
        rest = modulus // p
        weight = rest * pow(rest, -1, p)
        for k, r in enumerate(found[p]):
            out[k] += r * weight
    out = [c % modulus for c in out]
    return [c - modulus if c > modulus // 2 else c for c in out]


def _above(poly: list[int], a: int, shift: int) -> int:
    """How many roots exceed a / 2^shift, each as often as it is one; all roots of ``poly`` are real."""
    d = len(poly) - 1
    c = [v << shift * (d - k) for k, v in enumerate(poly)]  # roots times 2^shift
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int, shift: int) -> int:
    """Of the value at a / 2^shift."""
    value, power = 0, 0
    for c in reversed(poly):
        value = value * a + (c << power)
        power += shift
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], count: int, bits: int = BITS) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots, falling, each as often as it is one: (a, shift) for a / 2^shift, less than
    1 / 2^bits of the root below or above it."""
    positive = _above(poly, 0, 0)
    top = 1
    while _above(poly, top, 0):
        top <<= 1
    out: list[tuple[int, int]] = []
    # intervals (lo, hi] / 2^shift with the roots above hi and above lo
    todo = [(0, top, 0, 0, positive)]
    while todo and len(out) < min(count, positive):
        lo, hi, shift, over_hi, over_lo = todo.pop()
        if over_lo == over_hi:
            continue
        if lo and hi - lo == 1 and lo.bit_length() > bits:
            out += [(hi, shift)] * (over_lo - over_hi)  # roots that do not come apart
            continue
        if over_lo - over_hi == 1 and lo:
            out.append(_narrowed(poly, lo, hi, shift, bits))
            continue
        if hi - lo == 1:
            lo, hi, shift = 2 * lo, 2 * hi, shift + 1
        middle = (lo + hi) // 2
        over = _above(poly, middle, shift)
        todo += [(lo, middle, shift, over, over_lo), (middle, hi, shift, over_hi, over)]
    return out[:count]


def _narrowed(poly: list[int], lo: int, hi: int, shift: int, bits: int) -> tuple[int, int]:
    """The one simple root in (lo, hi] / 2^shift, by halving and the secant's guess in turn."""
    if _sign(poly, hi, shift) == 0:
        return hi, shift
    low = _sign(poly, lo, shift)
    if low == 0:  # a root of its own at the open end: step off it
        low = -_sign(poly, hi, shift)
    while lo.bit_length() - (hi - lo).bit_length() < bits:
        if hi - lo < 4:
            lo, hi, shift = lo << 64, hi << 64, shift + 64
        middle = (lo + hi) // 2
        sign = _sign(poly, middle, shift)
        if sign == 0:
            return middle, shift
        lo, hi = (middle, hi) if sign == low else (lo, middle)
        # Newton's guess from the middle: where its neighbourhood holds the root, the interval is that
        step = _newton(poly, middle, shift)
        if step is None:
            continue
        guess, width = step
        a, b = max(lo, guess - width), min(hi, guess + width)
        if lo < a < b < hi and _sign(poly, a, shift) == low and _sign(poly, b, shift) == -low:
            lo, hi = a, b
    return (lo + hi) // 2, shift


def _newton(poly: list[int], a: int, shift: int) -> tuple[int, int] | None:
    """Newton's next place from a / 2^shift, and how far from it the root may be looked for."""
    value, slope, power = 0, 0, 0
    for c in reversed(poly):
        slope = slope * a + value
        value = value * a + (c << power)
        power += shift
    if not slope:
        return None
    move = -(value // slope)
    return a + move, (move * move >> max(0, abs(a).bit_length() - 16)) + 1  # the error falls as its square


def null_vector(matrix: list[list[int]], root: tuple[int, int], before: list[list[Decimal]]) -> list[Decimal]:
    """The unit vector whose product with ``matrix - root`` vanishes, orthogonal to those of ``before``."""
    d = len(matrix)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        value = Decimal(root[0]) / Decimal(1 << root[1])
        rows = [[Decimal(v) - (value if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        tiny = max(abs(v) for row in matrix for v in row) * Decimal(10) ** (10 - DIGITS)
        swaps = []
        for k in range(d):  # LU with row exchanges
            pivot = max(range(k, d), key=lambda i: abs(rows[i][k]))
            rows[k], rows[pivot] = rows[pivot], rows[k]
            swaps.append(pivot)
            own = rows[k]
            if abs(own[k]) < tiny:
                own[k] = tiny
            for i in range(k + 1, d):
                row = rows[i]
                if row[k]:
                    f = row[k] = row[k] / own[k]
                    for j in range(k + 1, d):
                        row[j] -= f * own[j]
        v = [Decimal(1 + (i * 7919 + len(before) * 104729) % 1009) for i in range(d)]
        for _ in range(4):
            for k, pivot in enumerate(swaps):
                v[k], v[pivot] = v[pivot], v[k]
            for i in range(d):
                v[i] -= sum((rows[i][j] * v[j] for j in range(i)), Decimal(0))
            for i in range(d - 1, -1, -1):
                v[i] = (v[i] - sum((rows[i][j] * v[j] for j in range(i + 1, d)), Decimal(0))) / rows[i][i]
            for _ in range(2):
                largest = max(abs(x) for x in v)
                v = [x / largest for x in v]
                for w in before:
                    dot = sum((x * y for x, y in zip(v, w)), Decimal(0))
                    v = [x - dot * y for x, y in zip(v, w)]
                size = sum((x * x for x in v), Decimal(0)).sqrt()
                v = [x / size for x in v]
        return v


class Whitening:
    """What was fitted: n, sums of x - OFFSET, components (rows, already over the root of the eigenvalue), explained shares."""

    def __init__(self, n: int, sums: list[int], d: int, axes: np.ndarray, explained: list[float], live: int):
        self.n, self.sums, self.d, self.axes, self.explained, self.live = n, sums, d, axes, explained, live

    def project(self, batch: pa.Array) -> np.ndarray:
        small, y, c = _matrix(batch, self.d)
        centred = y - np.array([s / self.n for s in self.sums])
        for i in np.flatnonzero(~small):
            centred[i] = [float((self.n * v - s) / Decimal(self.n)) for v, s in zip(map(Decimal, _big(c[i])), map(Decimal, self.sums))]
        return centred @ self.axes.T

    def deviation(self, batch: pa.Array) -> list[int]:
        small, y, c = _matrix(batch, self.d)
        top = int(np.abs(y).max()) if len(y) else 0
        if self.n * (top + max(map(abs, self.sums), default=0)) * max(1, self.d) < 1 << 31:
            away = self.n * y - np.array(self.sums, np.int64)
            out = (away * away).sum(axis=1).tolist()
        else:
            away = self.n * y.astype(object) - np.array(self.sums, object)
            out = (away * away).sum(axis=1).tolist() if len(y) else []
        for i in np.flatnonzero(~small):
            out[i] = sum((self.n * v - s) ** 2 for v, s in zip(_big(c[i]), self.sums))
        return out


def fit(table: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> Whitening:
    """The components of largest variance; of equal eigenvalues any orthogonal set, the same at every run."""
    spark, rows = table.sparkSession, fitting(table, column)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("_c")), F.lit(0)).alias("d")).first()
    n, d = size["n"], size["d"]
    if not n or not d:
        return Whitening(n, [], d, np.zeros((0, d)), [], 0)
    s, q = _sums(rows, d)
    matrix = [[n * q[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]
    shared = math.gcd(*(v for row in matrix for v in row)) or 1
    matrix = [[v // shared for v in row] for row in matrix]
    trace = sum(matrix[i][i] for i in range(d))
    roots = largest_roots(characteristic_polynomial(spark, matrix), min(components, d)) if trace else []
    vectors: list[list[Decimal]] = []
    for root in roots:
        vectors.append(null_vector(matrix, root, vectors))
    axes, explained = np.zeros((min(components, d), d)), [0.0] * min(components, d)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        for k, ((a, shift), v) in enumerate(zip(roots, vectors)):
            e = Decimal(a) / Decimal(1 << shift)
            deviation = (e * shared).sqrt() / n  # of V = matrix * shared / n^2
            axes[k] = [float(x / deviation) for x in v]
            explained[k] = float(e / trace)
    return Whitening(n, s, d, axes, explained, len(roots))


def _second_moments(held):
    def fn(batches):
        w = held.value
        sums, products, n = np.zeros(w.live), np.zeros((w.live, w.live)), 0
        for batch in batches:
            z = w.project(batch.column("_c"))[:, :w.live]
            sums, products, n = sums + z.sum(axis=0), products + z.T @ z, n + len(z)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64())), pa.array([products.ravel().tolist()], pa.list_(pa.float64()))], names=["s", "q"])

    return fn


def identity_error(rows: DataFrame, fitted: Whitening, held) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    k = fitted.live
    if not k:
        return 0.0
    parts = rows.select("_c").mapInArrow(_second_moments(held), "s array<double>, q array<double>")
    sums = parts.select(F.posexplode(F.concat("s", "q")).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(k + k * k)
    for r in sums:
        v[r["at"]] = r["v"]
    mean = v[:k] / fitted.n
    return float(np.abs(v[k:].reshape(k, k) / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


_OUT = "component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"


def _whitened(held, error: float):
    def fn(batches):
        w = held.value
        k = len(w.explained)
        for batch in batches:
            c, m = batch.column("_c"), batch.num_rows
            z, dev = w.project(c), w.deviation(c)
            ids = batch.column("_id").take(pa.array(np.repeat(np.arange(m), k)))
            exact = pa.array([Decimal(x) if x < 10 ** 38 else None for x in dev for _ in range(k)], pa.decimal128(38, 0))
            narrow = pa.array([x if x < 1 << 63 else None for x in dev for _ in range(k)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), narrow, exact, pa.array(z.ravel()),
                 pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                names=["_id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"])

    return fn


def whiten(table: DataFrame, components: int = COMPONENTS, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """A row for each remaining row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact``."""
    spark = table.sparkSession
    kind = table.schema[id_column].dataType.simpleString()
    fitted = fit(table, components, column)
    if not fitted.explained:
        return spark.createDataFrame([], f"`{id_column}` {kind}, {_OUT}")
    held = spark.sparkContext.broadcast(fitted)  # components * dimensions numbers
    rows = fitting(table, column)
    error = identity_error(rows, fitted, held)
    out = rows.select(F.col(id_column).alias("_id"), "_c").mapInArrow(_whitened(held, error), f"_id {kind}, {_OUT}")
    return out.select(F.col("_id").alias(id_column), "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact")
