"""Whitening of embeddings by exact principal components.

Vectors become whole numbers, so their scatter matrix is exact: tasks add up
products, Spark adds the sums. From then on only matrices of the vectors'
length are handled. The characteristic polynomial of the integer scatter is
found modulo many primes (Hessenberg form and its recurrence, the primes
spread over tasks) and put together by Chinese remaindering. Its largest roots
are isolated by counting sign changes of shifted coefficients, which is exact
for a polynomial with real roots only, and narrowed far beyond double
precision. Each component is the null vector that inverse iteration finds at
its root, in long decimal arithmetic.
"""

from __future__ import annotations

import decimal
import random
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docloom.llm.common import Scratch, spread_input

#: Whole numbers made of entries: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1_024, 100_000
COMPONENTS = 8
#: Bits of a root behind its first one, and digits of the inverse iteration.
ROOT_BITS, DIGITS = 200, 90
#: Primes just below 2 ** 31: products of two residues fit a long.
PRIME_TOP = 1 << 31
LIMIT = (1 << 63) - 1
#: Sums are sent in two parts, so that each fits 38 digits.
PART = 1 << 60
ROWS_AT_ONCE = 4_096


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Centred whole numbers (without SHIFT) of a batch of vectors; those beyond a long count as its limit."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    whole = np.floor(flat * SCALE)
    edge = float(1 << 62)
    if (np.abs(whole) < edge).all():
        return whole.astype(np.int64)
    return np.array([[max(-LIMIT, min(LIMIT, int(v))) if np.isfinite(v) else (LIMIT if v > 0 else -LIMIT) for v in row] for row in whole], object)


def _products(x: np.ndarray) -> np.ndarray:
    """Exact ``x.T @ x`` as Python integers: in doubles while these hold every sum, else in integers of any length."""
    largest = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    total = np.zeros((x.shape[1], x.shape[1]), object)
    if largest >= 1 << 25:
        return total + x.astype(object).T @ x.astype(object)
    rows = max(1, (1 << 53) // max(1, largest * largest))
    for low in range(0, len(x), rows):
        some = x[low : low + rows].astype(np.float64)
        total += (some.T @ some).astype(np.int64)
    return total


def scatter(vectors: DataFrame, width: int) -> tuple[int, list[int], list[list[int]]]:
    """``(n, sums, products)`` of ``vectors(v)``, exact: without SHIFT, each a sum over all rows.

    A task sends a row for each pair of dimensions; their sums come to the driver.
    """
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, n = np.zeros((width, width), object), np.zeros(width, object), 0
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = _matrix(batch.column(0).slice(low, ROWS_AT_ONCE), width)
                products, sums, n = products + _products(x), sums + x.astype(object).sum(axis=0), n + len(x)
        if not n:
            return
        values = [(i, j, products[i, j]) for i in range(width) for j in range(i + 1)]
        values += [(i, -1, sums[i]) for i in range(width)] + [(-1, -1, n)]
        columns = [[i for i, _, _ in values], [j for _, j, _ in values], [Decimal(int(v) // PART) for *_, v in values], [Decimal(int(v) % PART) for *_, v in values]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    sent = vectors.select("v").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    n, sums, products = 0, [0] * width, [[0] * width for _ in range(width)]
    for i, j, high, low in sent.groupBy("i", "j").agg(F.sum("high"), F.sum("low")).collect():
        value = int(high) * PART + int(low)
        if i < 0:
            n = value
        elif j < 0:
            sums[i] = value
        else:
            products[i][j] = products[j][i] = value
    return n, sums, products


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2 ** 32."""
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below ``PRIME_TOP``, largest first, whose product has more than ``bits`` bits."""
    found, total, n = [], 0, PRIME_TOP - 1
    while total <= bits:
        if _is_prime(n):
            found.append(n)
            total += n.bit_length() - 1
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of ``det(x I - matrix)`` modulo the prime ``p``."""
    h = matrix.astype(np.int64) % p
    size = len(h)
    for m in range(1, size - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factors = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factors[:, None] * h[m] % p) % p
        # The inverse step on the columns keeps the matrices similar; products are reduced before they are added.
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factors % p).sum(axis=1)) % p
    rows = [np.zeros(size + 1, np.int64)]
    rows[0][0] = 1
    for m in range(size):
        made = (np.concatenate(([0], rows[m][:-1])) - rows[m] * int(h[m, m]) % p) % p
        below = 1
        for i in range(m - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            made = (made - rows[i] * (below * int(h[i, m]) % p) % p) % p
        rows.append(made)
    return [int(c) for c in rows[size]]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Whole coefficients, constant first, of ``det(x I - matrix)`` for a symmetric matrix without negative eigenvalues.

    Each prime is a row of a Spark job; its answer has a number for each dimension.
    """
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # Coefficients are elementary symmetric functions of the eigenvalues, at most those of equal ones.
    most = max(comb(size, k) * (trace // size + 1) ** k for k in range(size + 1))
    moduli = primes(most.bit_length() + 2)  # one bit more for the sign
    whole = np.array(matrix, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo((whole % p).astype(np.int64), p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    parts = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(parts).mapInArrow(run, "p long, c array<long>").collect()
    product = reduce(lambda a, b: a * b, moduli)
    result = [0] * (size + 1)
    for p, residues in rows:
        rest = product // p
        weight = rest * pow(rest, -1, p)
        result = [(r + weight * c) % product for r, c in zip(result, residues)]
    return [r - product if 2 * r > product else r for r in result]


def _shifted(coefficients: list[int], by: int) -> list[int]:
    """The coefficients of ``f(x + by)``."""
    c = list(coefficients)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += by * c[k + 1]
    return c


def roots_above(coefficients: list[int], at: int) -> int:
    """How many roots, counted as often as they occur, exceed ``at``: the sign changes of the shifted coefficients.

    By Descartes' rule that is exact if all roots are real.
    """
    signs = [c > 0 for c in _shifted(coefficients, at) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], number: int, bits: int) -> int:
    """``f(number / 2 ** bits)`` times ``2 ** (bits * degree)``."""
    total, unit = 0, 1
    for c in reversed(coefficients):
        total, unit = total * number + c * unit, unit << bits
    return total


def largest_roots(coefficients: list[int], wanted: int, top: int) -> list[tuple[int, int]]:
    """The ``wanted`` largest roots, falling, as ``(number, bits)``: the root lies in ``(number, number + 1] / 2 ** bits``.

    ``top`` is no smaller than any root, and no root is negative. Whole bounds
    are halved until a root is alone between them or they are neighbours; then
    a lone root is narrowed by signs, and roots that stay together by counts.
    """
    counted: dict[int, int] = {}

    def above(at: int) -> int:
        if at not in counted:
            counted[at] = roots_above(coefficients, at)
        return counted[at]

    found = []
    for k in range(1, wanted + 1):
        low, high = -1, top  # at least k roots above low, fewer than k above high
        while high - low > 1 and not (above(low) == k and above(high) == k - 1):
            middle = (low + high) // 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        alone = above(low) == k and above(high) == k - 1
        bits = max(0, ROOT_BITS - max(high, 1).bit_length())
        low, high = low << bits, high << bits
        if alone:
            # No further root lies below high: the sign there is that of no root passed.
            over = _value(coefficients, high, bits)
            sign = (over > 0) - (over < 0)
            while high - low > 1 and sign:
                middle = (low + high) // 2
                value = _value(coefficients, middle, bits)
                low, high = (low, middle) if (value > 0) - (value < 0) in (sign, 0) else (middle, high)
            low = high - 1
        else:
            scaled = [c << (bits * (len(coefficients) - 1 - i)) for i, c in enumerate(coefficients)]
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if roots_above(scaled, middle) >= k else (low, middle)
        found.append((low, bits))
    return found


def _orthonormal(vector: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for _ in range(2):  # once more, for what rounding leaves
        for o in others:
            share = sum(a * b for a, b in zip(vector, o))
            vector = [a - share * b for a, b in zip(vector, o)]
        length = sum(a * a for a in vector).sqrt()
        vector = [a / length for a in vector]
    return vector


def _solver(matrix: list[list[int]], shift: Decimal):
    """Solves ``(matrix - shift I) x = b`` by elimination with row exchanges; a vanishing pivot counts as a tiny one."""
    size = len(matrix)
    a = [[Decimal(v) - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    tiny = (max((abs(v) for row in a for v in row), default=Decimal(1)) or Decimal(1)).scaleb(8 - DIGITS)
    order = list(range(size))
    for k in range(size):
        best = max(range(k, size), key=lambda i: abs(a[i][k]))
        a[k], a[best], order[k], order[best] = a[best], a[k], order[best], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        pivot, row = a[k][k], a[k]
        for i in range(k + 1, size):
            if a[i][k]:
                factor = a[i][k] / pivot
                line = a[i]
                line[k] = factor
                for j in range(k + 1, size):
                    line[j] -= factor * row[j]

    def solve(b: list[Decimal]) -> list[Decimal]:
        x = [b[i] for i in order]
        for i in range(size):
            x[i] -= sum(a[i][j] * x[j] for j in range(i))
        for i in reversed(range(size)):
            x[i] = (x[i] - sum(a[i][j] * x[j] for j in range(i + 1, size))) / a[i][i]
        return x

    return solve


def null_vectors(matrix: list[list[int]], roots: list[Decimal]) -> list[list[Decimal]]:
    """A unit vector for each root (falling), orthogonal to those before: inverse iteration from fixed starts."""
    vectors: list[list[Decimal]] = []
    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = DIGITS, decimal.MAX_EMAX, decimal.MIN_EMIN
        for number, root in enumerate(roots):
            solve = _solver(matrix, root)
            draw = random.Random(number)
            vector = _orthonormal([Decimal(draw.randint(1, 1 << 30)) for _ in matrix], vectors)
            for _ in range(3):
                vector = _orthonormal(solve(vector), vectors)
            vectors.append(vector)
    return vectors


class Whitening:
    """Components of a table of vectors; everything in it is of the size of the dimension."""

    def __init__(self, width: int, n: int, sums: list[int], components: list[list[float]], values: list[float], explained: list[float]) -> None:
        #: ``sums`` are of the whole numbers with SHIFT; ``values`` the eigenvalues of their covariance.
        self.width, self.n, self.sums = width, n, sums
        self.components, self.values, self.explained = components, values, explained


def width_of(vectors: DataFrame) -> int:
    """The most frequent length of ``vectors(v)`` (of several the smallest); 0 if there is none."""
    sizes = vectors.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).where("size > 0")
    first = sizes.orderBy(F.desc("n"), "size").first()
    return first["size"] if first else 0


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Components of ``vectors(v)``, all of length ``width``."""
    n, plain, products = scatter(vectors, width)
    # n * n times the covariance, which the shift leaves as it is.
    matrix = [[n * products[i][j] - plain[i] * plain[j] for j in range(width)] for i in range(width)]
    sums = [s + n * SHIFT for s in plain]
    trace = sum(matrix[i][i] for i in range(width))
    wanted = min(components, width)
    if not trace:
        unit = [[float(i == k) for i in range(width)] for k in range(wanted)]
        return Whitening(width, n, sums, unit, [0.0] * wanted, [0.0] * wanted)
    polynomial = characteristic_polynomial(vectors.sparkSession, matrix)
    found = largest_roots(polynomial, wanted, trace)
    with decimal.localcontext() as context:
        context.prec, context.Emax, context.Emin = DIGITS, decimal.MAX_EMAX, decimal.MIN_EMIN
        # The middle of the last interval; a root below half a unit is zero.
        roots = [(2 * Decimal(low) + 1) / (2 * Decimal(1 << bits)) if low >= 0 else Decimal(0) for low, bits in found]
        roots = [r if r > Decimal(trace).scaleb(-40) else Decimal(0) for r in roots]
        vectors_found = null_vectors(matrix, roots)
        values = [float(r / n / n) for r in roots]
        explained = [float(r / trace) for r in roots]
    return Whitening(width, n, sums, [[float(v) for v in vector] for vector in vectors_found], values, explained)


def _deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * x - S`` of whole numbers without SHIFT, exact."""
    plain = [s - model.n * SHIFT for s in model.sums]
    most = max(abs(int(x.max())), abs(int(x.min()))) * model.n + max(map(abs, plain)) if x.size else 0
    kind = np.int64 if most <= LIMIT else object
    return x.astype(kind) * model.n - np.array(plain, kind)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows(vec_id, v)`` as ``(vec_id, deviation, whitened)``: one number a component, null without variance."""
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])
    scale = np.array([1.0 / np.sqrt(v) if v > 0 else 0.0 for v in model.values])
    axes = np.array(model.components, np.float64).T
    width, n, live = model.width, model.n, [v > 0 for v in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(low, ROWS_AT_ONCE)
                moved = _deviations(_matrix(some.column(1), width), model)
                most = max(abs(int(moved.max())), abs(int(moved.min())))
                exact = moved.astype(object) if width * most * most > LIMIT else moved
                squares = (exact * exact).sum(axis=1)
                white = (moved.astype(np.float64) / n) @ axes * scale
                lists = [[w if on else None for w, on in zip(row, live)] for row in white.tolist()]
                yield pa.RecordBatch.from_arrays(
                    # Beyond 38 digits there is no number.
                    [some.column(0).cast(pa.int64()), pa.array([Decimal(int(s)) if abs(int(s)) < 10**38 else None for s in squares], pa.decimal128(38, 0)),
                     pa.array(lists, pa.list_(pa.float64()))], schema=schema,
                )

    return spread_input(rows.select("vec_id", "v")).mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity, over components with variance; 0 if there is none.

    Tasks send their sums, then their centred products: a row for each pair of components.
    """
    live = [k for k, v in enumerate(model.values) if v > 0]
    if not live:
        return 0.0
    white = projected.select(F.array(*[F.get("whitened", F.lit(k)) for k in live]).alias("w"))
    means = white.agg(*[F.avg(F.get("w", F.lit(k))).alias(f"m{k}") for k in range(len(live))]).first()
    pairs = [(i, j) for i in range(len(live)) for j in range(i + 1)]
    centred = [F.get("w", F.lit(k)) - F.lit(means[k]) for k in range(len(live))]
    found = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component.

    Left out are rows whose vector is null, has a null or non-finite entry, or
    another length than most vectors. An entry c counts as floor(1024 * c) +
    100000, beyond a long as its limit. All usable rows are the fit list, so repeated
    rows count as often as they occur and each gives its own result rows.
    ``n`` is their number, ``deviation`` (decimal(38,0), null beyond) the exact
    sum over dimensions of ``(n * x - S) ** 2``. Components are numbered from
    1 by falling variance, of equal ones any orthonormal choice, the same for
    all rows; shorter vectors have as many as entries. Without variance
    ``whitened`` is null and ``explained`` 0. Other columns are left out. No usable row
    gives an empty result.
    """
    scratch = Scratch(rows.sparkSession, "whitening")
    kept = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(usable(F.col("v")))
    width = width_of(kept)
    kept = kept.where(F.size("v") == width)
    out = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not width:
        return rows.sparkSession.createDataFrame([], out)
    model = fit(spread_input(kept), width, components)
    projected = scratch.table(project(kept, model), "projected")
    error = identity_error(projected, model)
    explained = F.array(*[F.lit(e) for e in model.explained])
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
