"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter matrix of all distinct vectors is a matrix of whole numbers that no
order of additions changes. From there on nothing is approximated before the last step:

1. The scatter is added up in the tasks, block by block, and by a shuffle of its entries.
2. Its characteristic polynomial is computed modulo primes, in tasks, by reduction to Hessenberg form. A
   bound on the coefficients says how many primes are needed; Chinese remaindering puts them together.
3. All roots are real, so the sign changes of the polynomial moved to a place count the roots above it
   exactly (Descartes). Bisection by that count isolates each wanted root, bisection by sign refines it to
   ``ROOT_BITS`` bits, in whole numbers throughout.
4. A component spans the null space of scatter minus root: two steps of inverse iteration in decimals of
   ``DIGITS`` digits. Roots that stay together to the last bit share a space and get an orthogonal base of it.

What reaches the driver is the scatter, the polynomial and the components: sizes of the dimension alone.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyvein.session import Scratch

#: Fixed by the query's contract: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Bits below the largest possible root to which roots are found, and digits of the inverse iteration.
ROOT_BITS, DIGITS = 160, 100
#: Whole numbers up to this are added exactly in doubles, ``_ROWS`` products of two at a time.
_LIMB, _ROWS = 1 << 20, 4096
#: Primes below this keep products within 64 bits.
_PRIMES_BELOW = 1 << 31


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * c) of each entry as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    """A vector that is not null, not empty and has only finite entries."""
    inf = float("inf")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (c == inf) | (c == -inf))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _products(y: np.ndarray, total: np.ndarray) -> None:
    """Add y's transpose times y to ``total`` (Python integers), exactly."""
    high = int(max(y.max(), -int(y.min()))) if len(y) else 0
    if high < _LIMB:
        for first in range(0, len(y), _ROWS):
            part = y[first : first + _ROWS].astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
    else:
        wide = y.astype(object)
        for first in range(0, len(y), 64):
            part = wide[first : first + 64]
            total += part.T.dot(part)


def _scatter_parts(batches: Iterable[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """This task's sums of entries (i, -1) and of products (i, j >= i), once per task."""
    total, sums, n = np.zeros((d, d), object), np.zeros(d, object), 0
    for batch in batches:
        y = _matrix(batch.column(0), d)
        n += len(y)
        sums += y.astype(object).sum(axis=0) if len(y) else 0
        _products(y, total)
    if n:
        i, j = np.triu_indices(d)
        rows = [*zip(i.tolist(), j.tolist(), total[i, j]), *((k, -1, v) for k, v in enumerate(sums)), (-1, -1, n)]
        columns = list(zip(*rows))
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
        values = [pa.array(columns[0], kinds[0]), pa.array(columns[1], kinds[1]), pa.array([Decimal(int(v)) for v in columns[2]], kinds[2])]
        yield pa.RecordBatch.from_arrays(values, ["i", "j", "value"])


def scatter(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, C) of a column ``y`` of whole vectors: C = n * sum(y y^T) - S S^T, the scatter times n, exactly."""
    parts = fit.select("y").mapInArrow(lambda batches: _scatter_parts(batches, d), "i int, j int, value decimal(38,0)")
    found = {(r.i, r.j): int(r.value) for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    n, s = found.get((-1, -1), 0), [found.get((k, -1), 0) for k in range(d)]
    return n, s, [[n * found.get((min(i, j), max(i, j)), 0) - s[i] * s[j] for j in range(d)] for i in range(d)]


def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest odd primes below ``limit`` (at most 2^31), by a test that is exact in that range."""

    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x in (1, p - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    out, p = [], limit - 1 | 1
    while len(out) < count:
        p -= 2
        if prime(p):
            out.append(p)
    return out


def polynomial_modulo(matrix: list[list[int]], p: int) -> np.ndarray:
    """Coefficients of det(xI - matrix) modulo a prime below 2^31, from the constant on."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if len(below) == 0:
            continue
        r = k + int(below[0])
        if r != k:
            h[[k, r]] = h[[r, k]]
            h[:, [k, r]] = h[:, [r, k]]
        inverse = pow(int(h[k, k - 1]), -1, p)
        factors = h[k + 1 :, k - 1] * inverse % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k][None, :] % p) % p
        # The inverse operation on columns: their products are added one by one modulo p.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors[None, :] % p).sum(axis=1)) % p
    rows = np.zeros((d + 1, d + 1), np.int64)  # row m: polynomial of the leading m x m part
    rows[0, 0] = 1
    for m in range(1, d + 1):
        rows[m, 1:] = rows[m - 1, :-1]
        rows[m] = (rows[m] - h[m - 1, m - 1] * rows[m - 1]) % p
        chain = 1
        for i in range(m - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            if chain == 0:
                break
            rows[m] = (rows[m] - (chain * int(h[i - 1, m - 1]) % p) * rows[i - 1]) % p
    return rows[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(xI - matrix), from the constant on, of a positive semidefinite matrix of whole numbers.

    The size of the coefficient of x^(d-k) is at most C(d,k) * (trace / d)^k; its sign is that of (-1)^k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_below(_PRIMES_BELOW, bound.bit_length() // 30 + 2)

    def solve(batches):
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_modulo(matrix, p).tolist() for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "found"])

    slices = min(len(primes), max(spark.sparkContext.defaultParallelism, 1))
    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(slices)
    rows = table.mapInArrow(solve, "p long, found array<long>").collect()
    modulus, out = 1, [0] * (d + 1)
    for row in rows:
        inverse = pow(modulus, -1, row.p)
        out = [x + modulus * ((int(r) - x) * inverse % row.p) for x, r in zip(out, row.found)]
        modulus *= row.p
    return [x if (d - k) % 2 == 0 else x - modulus if x else 0 for k, x in enumerate(out)]


def _above(coefficients: list[int], place: int) -> int:
    """How many roots are larger than a place: sign changes after moving the place to zero, exact as all roots are real."""
    moved = list(coefficients)
    for first in range(len(moved) - 1):
        for k in range(len(moved) - 2, first - 1, -1):
            moved[k] += place * moved[k + 1]
    signs = [v > 0 for v in moved if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], place: int) -> int:
    out = 0
    for c in reversed(coefficients):
        out = out * place + c
    return out


def isolate_root(coefficients: list[int], number: int, top: int) -> int:
    """floor of the ``number``-th largest root (from 1) of a real-rooted polynomial with roots in [0, top)."""
    low, high, above_low, above_high = 0, top, None, 0
    while high - low > 1 and (above_low is None or above_low - above_high > 1):
        middle = (low + high) // 2
        above = _above(coefficients, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    if high - low > 1:
        # One simple root in (low, high]: its sign tells the halves apart.
        sign = _value(coefficients, high)
        while high - low > 1 and sign:
            middle = (low + high) // 2
            value = _value(coefficients, middle)
            if value == 0:
                return middle
            low, high = (low, middle) if (value > 0) == (sign > 0) else (middle, high)
        if not sign:
            return high
    return high if _value(coefficients, high) == 0 and _above(coefficients, high) < number else low


def largest_roots(spark: SparkSession, coefficients: list[int], top: int, most: int) -> tuple[list[int], int]:
    """(roots, bits): the largest positive roots times 2^bits, rounded down, largest first; at most ``most``."""
    zero = next(k for k, c in enumerate(coefficients) if c)
    positive = len(coefficients) - 1 - zero
    bits = max(0, ROOT_BITS - top.bit_length())
    d = len(coefficients) - 1
    scaled = [c << bits * (d - k) for k, c in enumerate(coefficients)]

    def solve(batches):
        for batch in batches:
            found = [str(isolate_root(scaled, k, (top + 1) << bits)) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["number", "root"])

    wanted = min(most, positive)
    if not wanted:
        return [], bits
    numbers = spark.createDataFrame([(k,) for k in range(1, wanted + 1)], "number long").repartition(wanted, "number")
    found = numbers.mapInArrow(solve, "number long, root string").collect()
    return [int(r.root) for r in sorted(found, key=lambda r: r.number)], bits


def null_space(matrix: list[list[int]], root: int, bits: int, size: int) -> np.ndarray:
    """``size`` orthogonal unit vectors that matrix minus root / 2^bits sends next to zero, one per row."""
    d = len(matrix)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(root) / (Decimal(2) ** bits)
        scale = Decimal(max(1, max(abs(v) for row in matrix for v in row)))
        a = np.array([[(Decimal(v) - (shift if i == j else 0)) / scale for j, v in enumerate(row)] for i, row in enumerate(matrix)], object)
        x = np.array([[Decimal((i * 7919 + k * 104_729 + i * i * 31 * (k + 1)) % 2003 - 1001) / 1001 for k in range(size)] for i in range(d)], object)
        lower, order = _factors(a)
        for _ in range(3):
            x = _unit(_solve(a, lower, order, x))
        signs = [1 if x[max(range(d), key=lambda i: (abs(x[i, k]), -i)), k] > 0 else -1 for k in range(size)]
        return np.array([[float(v) * signs[k] for v in x[:, k]] for k in range(size)])


def _factors(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Gaussian elimination with row exchanges in place; a pivot of zero becomes a last digit."""
    d = len(a)
    order, lower = list(range(d)), np.full((d, d), Decimal(0), object)
    for k in range(d):
        r = max(range(k, d), key=lambda i: abs(a[i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
            lower[[k, r]] = lower[[r, k]]
            order[k], order[r] = order[r], order[k]
        if a[k, k] == 0:
            a[k, k] = Decimal(10) ** -(DIGITS - 10)
        if k + 1 < d:
            lower[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k:] -= lower[k + 1 :, k : k + 1] * a[k : k + 1, k:]
    return lower, order


def _solve(a: np.ndarray, lower: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    x = b[order].copy()
    for k in range(len(a)):
        x[k + 1 :] -= lower[k + 1 :, k : k + 1] * x[k : k + 1]
    for k in range(len(a) - 1, -1, -1):
        x[k] /= a[k, k]
        x[:k] -= a[:k, k : k + 1] * x[k : k + 1]
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """Columns made orthogonal and of length one."""
    for k in range(x.shape[1]):
        x[:, k] /= max(abs(v) for v in x[:, k])
        for _ in range(2):
            for m in range(k):
                x[:, k] -= x[:, m] * sum(x[:, m] * x[:, k])
        x[:, k] /= sum(x[:, k] * x[:, k]).sqrt()
    return x


class Whitening:
    """n, sums and trace of the fit list, eigenvalues and unit components of its covariance, largest first."""

    def __init__(self, n: int, sums: list[int], values: list[float], shares: list[float], vectors: np.ndarray):
        self.n, self.sums, self.values, self.shares, self.vectors = n, sums, values, shares, vectors

    def apply(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates, one row per vector. Added up dimension by dimension: a row's numbers do not depend on its batch."""
        out = np.zeros((len(y), len(self.values)))
        weights = self.vectors / np.sqrt(np.array(self.values))[:, None]
        for j, s in enumerate(self.sums):
            whole, rest = divmod(s, self.n)
            out += ((y[:, j] - whole) - rest / self.n)[:, None] * weights[:, j][None, :]
        return out

    def deviation(self, y: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * y - sum)^2, exact; an error where it leaves 64 bits."""
        widest = max((abs(self.n * int(v) - s) for j, s in enumerate(self.sums) for v in (y[:, j].max(), y[:, j].min())), default=0) if len(y) else 0
        if widest * widest * len(self.sums) < 1 << 63:
            return ((y * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        wide = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in y.tolist()]
        return np.array(wide, np.int64)


def fit_whitening(spark: SparkSession, fit: DataFrame, d: int, components: int) -> Whitening | None:
    """The whitening of a table of distinct whole vectors ``y``; None without a vector or without any spread."""
    n, sums, matrix = scatter(fit, d)
    trace = sum(matrix[i][i] for i in range(d))
    if trace == 0:
        return None
    coefficients = characteristic_polynomial(spark, matrix)
    roots, bits = largest_roots(spark, coefficients, trace, components)
    spaces = [(root, roots.count(root)) for root in dict.fromkeys(roots)]

    def solve(batches):
        for batch in batches:
            for root, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = null_space(matrix, int(root), bits, size).tolist()
                values = [pa.array([root]), pa.array([found], pa.list_(pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays(values, ["root", "found"])

    table = spark.createDataFrame([(str(root), size) for root, size in spaces], "root string, size int").repartition(len(spaces), "root")
    found = {int(r.root): r.found for r in table.mapInArrow(solve, "root string, found array<array<double>>").collect()}
    vectors = np.array([v for root, _ in spaces for v in found[root]])
    values = [float(Decimal(root) / (Decimal(2) ** bits) / n / n) for root in roots]
    shares = [float(Decimal(root) / (Decimal(2) ** bits) / trace) for root in roots]
    return Whitening(n, sums, values, shares, vectors)


def _moments(batches: Iterable[pa.RecordBatch], d: int, model: Whitening) -> Iterator[pa.RecordBatch]:
    """Per task the sums of whitened coordinates (i, -1) and of their products."""
    k = len(model.values)
    sums, products, n = np.zeros(k), np.zeros((k, k)), 0
    for batch in batches:
        w = model.apply(_matrix(batch.column(0), d))
        n += len(w)
        sums += w.sum(axis=0)
        products += w.T @ w
    if n:
        i, j = (x.ravel() for x in np.indices((k, k)))
        columns = [np.r_[i, np.arange(k)], np.r_[j, np.full(k, -1)], np.r_[products.ravel(), sums]]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["i", "j", "value"])


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Whitened coordinates are centred already, exactly but for rounding; what is left of their mean is taken off.
    """
    parts = fit.select("y").mapInArrow(lambda batches: _moments(batches, d, model), "i int, j int, value double")
    found = {(r.i, r.j): r.value for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    k = range(len(model.values))
    mean = [found[i, -1] / model.n for i in k]
    return max(abs(found[i, j] / model.n - mean[i] * mean[j] - (i == j)) for i in k for j in k)


def whitened(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error.

    The fit list is each distinct whole vector once; rows are whitened as often as they are there.

    * A null or empty vector and one with null or non-finite entries is dropped, and so is one with fewer
      entries than the longest that remains.
    * Components with an eigenvalue of zero can't be whitened and give no rows: fewer than ``components`` where
      the dimension or the rank is smaller, none where all vectors are one.
    * Equal eigenvalues share a space; an orthogonal base of it is chosen once for all rows.
    * Entries must stay below 2^52 / 64 in size and a deviation within 64 bits, else the query fails.
    * Repeated and null ids come back as they are; an empty table gives no rows. Other columns are not read.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = table.select(table[id_col].alias("id"), table[vector_col].alias("vector")).where(usable(F.col("vector")))
    d = rows.agg(F.max(F.size("vector")).alias("d")).first().d or 0
    rows = rows.where(F.size("vector") == d).select("id", whole_numbers(F.col("vector")).alias("y"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = scratch.write(rows.select("y").distinct(), "fit")
    model = fit_whitening(spark, fit, d, components) if d else None
    if model is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(fit, d, model)
    shared = spark.sparkContext.broadcast(model)

    def describe(batches):
        model = shared.value
        k = len(model.values)
        for batch in batches:
            y = _matrix(batch.column(1), d)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(y)), k)))
            columns = [
                np.tile(np.arange(1, k + 1, dtype=np.int32), len(y)),
                np.full(len(y) * k, model.n, np.int64),
                np.repeat(model.deviation(y), k),
                model.apply(y).ravel(),
                np.tile(np.array(model.shares), len(y)),
                np.full(len(y) * k, error),
            ]
            names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names)

    return rows.mapInArrow(describe, schema).withColumnRenamed("id", id_col)
