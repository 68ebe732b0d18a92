"""Whitening of embeddings with components from the exact characteristic polynomial of their scatter matrix.

Vectors become integers, so that the scatter of the distinct ones, n * sum(x x') - S S', is an exact integer matrix: tasks add up
their part and one aggregation adds the parts.  Its characteristic polynomial is found modulo many primes, each in a task, by
reduction to Hessenberg form, and put together by Chinese remaindering.  All roots of the polynomial are real, so the sign
variations of its exact shift by a count the roots above a; bisection isolates the largest ones and narrows them to many more
digits than a double has.  Inverse iteration in decimal arithmetic then gives the null space of scatter - root, the component.

The driver holds the scatter, the polynomial and the components, all bounded by the number of dimensions, never by the rows.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; a vector shorter than the longest
counts as filled up with zeros, an empty one too; entries beyond the range of a long stay at its ends; equal vectors are fitted
once, and every row is returned, with null and repeated ids as they are.  Components number at most the dimensions.  A component
of eigenvalue zero has a null ``whitened`` and does not enter the identity error; without any spread ``explained`` is 0.
Equal eigenvalues get an orthonormal basis of their space.  ``deviation`` is null where it exceeds a long, ``deviation_exact``
holds its digits always.  An empty table gives no rows; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condoflow.llm.common import staged

LIMB = 20  # bits of a part of a number whose products are added in doubles without rounding
EXACT = 2**53  # doubles hold all integers up to here
BITS = 31  # size of the primes
DIGITS = 100  # of decimal arithmetic; roots are narrowed to FINE bits below the largest one
FINE = 200
Matrix = list[list[int]]


def clean(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id and integer vector ``x`` of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return embeddings.where(v.isNotNull() & ~bad).select(
        F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda c: F.floor(c * 256)).alias("x"))


def padded(x: pa.Array, d: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``d`` columns."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    sizes = np.diff(x.offsets.to_numpy())
    out = np.zeros((len(x), d), np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = x.flatten().to_numpy(zero_copy_only=False)
    return out


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as sum of part * 2**(LIMB * k), each part below 2**LIMB in size, as doubles."""
    parts, sign, rest = [], np.where(x < 0, -1.0, 1.0), np.abs(x.astype(object)) if (x == -(2**63)).any() else np.abs(x)
    while True:
        parts.append((rest & ((1 << LIMB) - 1)).astype(np.float64) * sign)
        rest = rest >> LIMB
        if not (rest > 0).any():
            return parts


def add_products(x: np.ndarray, sums: dict[int, np.ndarray]) -> None:
    """Adds the products of all pairs of columns to ``sums``, one matrix of Python integers for each power of two."""
    step = EXACT >> (2 * LIMB)
    for at in range(0, len(x), step):
        parts = limbs(x[at : at + step])
        for p, a in enumerate(parts):
            for q, b in enumerate(parts):
                product = (a.T @ b).astype(np.int64).astype(object)
                sums[LIMB * (p + q)] = sums.get(LIMB * (p + q), 0) + product


@dataclass(frozen=True)
class Scatter:
    """Number of vectors, sums of their entries and the integer matrix n * sum(x x') - S S'."""

    n: int
    sums: list[int]
    matrix: Matrix


def scatter_of(vectors: DataFrame, d: int) -> Scatter:
    """Exact scatter of the vectors in column ``x``; every task adds up its rows first."""

    def part(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = padded(batch.column(0), d)
            add_products(np.hstack([np.ones((len(x), 1), np.int64), x]), sums)
        for shift, matrix in sums.items():
            i, j = np.triu_indices(d + 1)
            size = len(i)
            value = [matrix[a, b] for a, b in zip(i.tolist(), j.tolist())]
            for k in range(0, 3 * BITS, BITS):  # a sum of longs cannot overflow where each has 31 bits
                last = k == 2 * BITS
                piece = [v >> k if last else (v >> k) & ((1 << BITS) - 1) for v in value]
                if any(piece):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(size, shift + k), pa.int32()), pa.array(piece, pa.int64())],
                        names=["i", "j", "shift", "value"])

    parts = vectors.select("x").mapInArrow(part, "i int, j int, shift int, value long")
    total = np.zeros((d + 1, d + 1), object)
    for r in parts.groupBy("i", "j", "shift").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r.i, r.j] += int(r.value) << r.shift
    total = np.where(np.tri(d + 1, k=-1, dtype=bool), total.T, total)
    n, s = int(total[0, 0]), total[0, 1:]
    return Scatter(n, s.tolist(), (n * total[1:, 1:] - s[:, None] * s[None, :]).tolist())


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 2**32."""
    if n < 4 or n % 2 == 0:
        return n in (2, 3)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if base % n and x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_above(product: int) -> list[int]:
    """The largest primes of BITS bits whose product exceeds the given number."""
    found, have, p = [], 1, (1 << BITS) - 1
    while have <= product:
        if is_prime(p):
            found.append(p)
            have *= p
        p -= 2
    return found


def times(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Product modulo p, which has at most 31 bits, so that a product fits an unsigned 64-bit number."""
    return (a * b) % np.uint64(p)


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """Similar matrix modulo p with zeros below the first subdiagonal."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        below = np.nonzero(a[k + 1 :, k])[0]
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = times(a[k + 2 :, k], np.uint64(pow(int(a[k + 1, k]), -1, p)), p)
        a[k + 2 :] = (a[k + 2 :] + np.uint64(p) - times(factor[:, None], a[k + 1][None, :], p)) % np.uint64(p)
        column = times(a[:, k + 2 :], factor[None, :], p)
        a[:, k + 1] = (a[:, k + 1] + column.sum(axis=1) % np.uint64(p)) % np.uint64(p)
    return a


def polynomial_modulo(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - a) modulo p, constant term first."""
    h, d = hessenberg(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), np.uint64)  # row k: the polynomial of the leading block of size k
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        minus = times(polys[k - 1], h[k - 1, k - 1], p)
        below = np.uint64(1)
        for i in range(k - 1, 0, -1):  # h[i - 1, k - 1] times the subdiagonal entries from i to k - 1
            below = times(below, h[i, i - 1], p)
            minus = (minus + times(polys[i - 1], times(below, h[i - 1, k - 1], p), p)) % np.uint64(p)
        polys[k] = (polys[k] + np.uint64(p) - minus) % np.uint64(p)
    return polys[d].tolist()


def characteristic_polynomial(spark, matrix: Matrix) -> list[int]:
    """Exact coefficients of det(t - matrix) of a positive semidefinite matrix, constant term first; one task for some primes."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # The k-th coefficient is a sum of products of k of the d eigenvalues, none negative: at most binomial(d, k) * (trace / d) ** k.
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes = primes_above(2 * bound)

    def residues(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                a = np.array([[v % p for v in row] for row in matrix], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(a, p)], pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), 2 * spark.sparkContext.defaultParallelism)
    given = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    product, found = math.prod(primes), [0] * (d + 1)
    for p, c in given.mapInArrow(residues, "p long, c array<long>").collect():
        rest = product // p
        unit = rest * pow(rest, -1, p)
        found = [(f + unit * r) % product for f, r in zip(found, c)]
    return [f - product if 2 * f > product else f for f in found]


def roots_above(poly: list[int], a: int, bits: int) -> int:
    """Number of roots of a real-rooted polynomial above a / 2**bits, by sign variations of the exact shift."""
    d = len(poly) - 1
    c = [v << (bits * (d - k)) for k, v in enumerate(poly)]  # roots times 2**bits
    for k in range(d):
        for j in range(d - 1, k - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, bits: int) -> int:
    """Sign of the polynomial at a / 2**bits."""
    value, scale = 0, 0
    for v in reversed(poly):
        value = value * a + (v << scale)
        scale += bits
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int) -> list[tuple[int, int, int]]:
    """(numerator, bits, multiplicity) of the largest positive roots, descending, until ``wanted`` roots are counted.

    Bisection halves an interval until it holds one distinct root, told by the count, or until it is narrower than FINE bits
    below the bound of all roots, where the roots it holds count as one; roots that differ by less have equal components to a double.
    """
    top = max(1, 1 + max(abs(v) for v in poly[-2:-1])).bit_length()  # the sum of all roots bounds each
    bits = max(0, FINE - top)
    found: list[tuple[int, int, int]] = []
    positive = roots_above(poly, 0, 0)

    def look(low: int, high: int, above_low: int, above_high: int) -> None:  # roots in (low, high] over 2**bits
        if above_low == above_high or sum(m for _, _, m in found) >= wanted:
            return
        if above_low - above_high == 1:
            sign = sign_at(poly, high, bits)
            while sign and high - low > 1:
                mid = (low + high) // 2
                s = sign_at(poly, mid, bits)
                if s == 0:
                    high, sign = mid, 0
                elif s == sign:
                    high = mid
                else:
                    low = mid
            found.append((high, bits, 1))
        elif high - low <= 1:
            found.append((high, bits, above_low - above_high))
        else:
            mid = (low + high) // 2
            above = roots_above(poly, mid, bits)
            look(mid, high, above, above_high)
            look(low, mid, above_low, above)

    look(0, 1 << (top + bits), positive, 0)
    return found


def eliminated(matrix: Matrix, root: decimal.Decimal) -> tuple[np.ndarray, np.ndarray]:
    """LU form of matrix - root with the order of its rows; a pivot of zero becomes tiny, as inverse iteration wants."""
    d = len(matrix)
    a = np.array([[decimal.Decimal(v) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= root
    order, least = np.arange(d), max(abs(a).max(), decimal.Decimal(1)).scaleb(20 - DIGITS)
    for k in range(d):
        pivot = k + int(np.argmax(abs(a[k:, k])))
        a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[None, k, k + 1 :]
    return a, order


def solved(lu: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, d = b[order].copy(), len(b)
    for k in range(d):
        x[k] -= (lu[k, :k] * x[:k]).sum() if k else 0
    for k in range(d - 1, -1, -1):
        x[k] = (x[k] - (lu[k, k + 1 :] * x[k + 1 :]).sum()) / lu[k, k] if k < d - 1 else x[k] / lu[k, k]
    return x


def null_space(matrix: Matrix, root: decimal.Decimal, size: int) -> list[list[float]]:
    """Orthonormal vectors v with matrix v = root v, by inverse iteration; the largest entry of each is positive."""
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        lu, order = eliminated(matrix, root)
        d, basis = len(matrix), []
        starts = np.random.default_rng(7).integers(1, 1000, (size, d))
        for start in starts:
            v = np.array([decimal.Decimal(int(s)) for s in start], object)
            for _ in range(3):
                v = solved(lu, order, v)
                for _ in range(2):
                    for u in basis:
                        v = v - (u * v).sum() * u
                    v = v / (v * v).sum().sqrt()
            basis.append(v if v[int(np.argmax(abs(v)))] > 0 else -v)
        return [[float(c) for c in v] for v in basis]


@dataclass(frozen=True)
class Whitening:
    """Fitted components: unit vectors, square roots of their eigenvalues and shares of the trace, falling."""

    d: int
    n: int
    sums: list[int]
    vectors: list[list[float]]
    scales: list[float]
    explained: list[float]


def fit(vectors: DataFrame, components: int) -> Whitening:
    """Components of the distinct integer vectors in column ``x``."""
    d = vectors.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    scatter = scatter_of(vectors, d)
    matrix, trace, k = scatter.matrix, sum(scatter.matrix[i][i] for i in range(d)), min(components, d)
    found: list[tuple[list[float], float, float]] = []
    if trace:
        poly = characteristic_polynomial(vectors.sparkSession, matrix)
        with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
            for top, bits, size in largest_roots(poly, k):
                root = decimal.Decimal(top) / (1 << bits)
                scale, share = float(root.sqrt() / scatter.n), float(root / trace)
                found += [(v, scale, share) for v in null_space(matrix, root, size)]
    found = found[:k]
    if len(found) < k:  # the space of eigenvalue zero
        with decimal.localcontext(decimal.Context(prec=DIGITS)):
            rest = null_space(matrix, decimal.Decimal(0), k - len(found))
        found += [(v, 0.0, 0.0) for v in rest]
    return Whitening(d, scatter.n, scatter.sums, *map(list, zip(*found)) if found else ([], [], []))


def span(x: np.ndarray) -> int:
    """Largest size of an entry."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def whitened(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Projections of integer rows on the components, NaN where a component has no spread, and exact deviations."""
    safe = max([1, *(abs(s) for s in model.sums)]) < 2**62 and span(x) < 2**62 // max(model.n, 1)
    off = x * model.n - np.array(model.sums, np.int64) if safe else x.astype(object) * model.n - np.array(model.sums, object)
    small = safe and span(off) ** 2 * max(model.d, 1) < 2**63
    exact = off if small else off.astype(object)
    deviation = (exact * exact).sum(axis=1).tolist()
    scales = np.array([s or np.nan for s in model.scales])
    return (off.astype(np.float64) / model.n) @ np.array(model.vectors, np.float64).reshape(-1, model.d).T / scales, deviation


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, over components with spread."""
    has = [k for k, s in enumerate(model.scales) if s]
    if not has:
        return 0.0

    def part(batches):
        for batch in batches:
            w = whitened(model, padded(batch.column(0), model.d))[0][:, has]
            w = np.hstack([np.ones((len(w), 1)), w])
            yield pa.RecordBatch.from_arrays(
                [pa.array([(w.T @ w).ravel().tolist()], pa.list_(pa.float64()))], names=["p"])

    sums = vectors.select("x").mapInArrow(part, "p array<double>").select(F.posexplode("p").alias("at", "p"))
    total = np.zeros((len(has) + 1) ** 2)
    for r in sums.groupBy("at").agg(F.sum("p").alias("p")).collect():
        total[r.at] = r.p
    total = total.reshape(len(has) + 1, -1) / model.n
    return float(np.abs(total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(len(has))).max())


def whiten(embeddings: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every row that takes part on the leading components: id, component, whitened value, deviation and what the fit says."""
    rows = clean(embeddings, id_col, vector_col)
    vectors = staged(rows.select("x").distinct())
    model = fit(vectors, components)
    error, k = identity_error(vectors, model), len(model.vectors)

    def project(batches):
        for batch in batches:
            w, deviation = whitened(model, padded(batch.column(1), model.d))
            fits = [v if v < 2**63 else None for v in deviation]
            for c in range(k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(w), c + 1), pa.int32()), pa.array(fits, pa.int64()),
                     pa.array([str(v) for v in deviation], pa.string()), pa.array(w[:, c], from_pandas=True),
                     pa.array(np.full(len(w), model.explained[c]))],
                    names=["id", "component", "deviation", "deviation_exact", "whitened", "explained"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, component int, deviation long, deviation_exact string, whitened double, explained double"
    return rows.mapInArrow(project, schema).withColumn("n", F.lit(model.n).cast("long")).withColumn("identity_error", F.lit(error))


def op12_embedding_whitening(embeddings: DataFrame) -> DataFrame:
    """Four components of every row of embeddings."""
    return whiten(embeddings).select(
        F.col("id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact")
