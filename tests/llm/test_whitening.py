import itertools
import random
from fractions import Fraction

import numpy as np
import pytest

from tallyvein.llm import whitening
from tallyvein.llm.whitening import characteristic_polynomial, fit_whitening, isolate_root, polynomial_modulo, primes_below, whitened


def determinant(m):
    """By all permutations."""
    total = 0
    for order in itertools.permutations(range(len(m))):
        sign = (-1) ** sum(order[i] > order[j] for i in range(len(m)) for j in range(i + 1, len(m)))
        product = sign
        for i, j in enumerate(order):
            product *= m[i][j]
        total += product
    return total


def brute_polynomial(m):
    """Sums of principal minors."""
    d = len(m)
    out = [0] * (d + 1)
    for k in range(d + 1):
        minors = sum(determinant([[m[i][j] for j in some] for i in some]) for some in itertools.combinations(range(d), k))
        out[d - k] = (-1) ** k * minors
    return out


def scatter_like(rng, d, n, spread=1000):
    x = [[rng.randint(-spread, spread) for _ in range(d)] for _ in range(n)]
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


def test_primes():
    some = primes_below(1 << 31, 5)
    assert some[0] == 2147483629 and all(all(p % q for q in range(3, 46400, 2)) for p in some)


def test_polynomial_equals_minors(spark):
    rng = random.Random(4)
    for d, n in ((1, 3), (2, 2), (4, 9), (5, 3), (6, 20)):
        m = scatter_like(rng, d, n)
        assert characteristic_polynomial(spark, m) == brute_polynomial(m)
    zero_below = [[2, 5, 0, 1], [0, 3, 7, 2], [4, 0, 1, 0], [0, 0, 0, 6]]  # needs exchanged rows and a broken chain
    for p in (10007, 2147483629):
        assert polynomial_modulo(zero_below, p).tolist() == [c % p for c in brute_polynomial(zero_below)]


def test_roots_with_repeats():
    """(x - 3)^2 (x - 10) (x - 1/2) x, times 2: roots are counted with their multiplicity."""
    factors = [(3, 1), (3, 1), (10, 1), (1, 2), (0, 1)]
    coefficients = [1]
    for top, under in factors:
        coefficients = [under * a - top * b for a, b in zip([0, *coefficients], [*coefficients, 0])]
    scaled = [c << 8 * (5 - k) for k, c in enumerate(coefficients)]
    assert [isolate_root(scaled, k, 64 << 8) for k in (1, 2, 3, 4)] == [10 << 8, 3 << 8, 3 << 8, 1 << 7]


def reference(rows, components):
    x = np.floor(64 * np.array(rows, float))
    u = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True).reshape(x.shape[1], -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [k for k in range(min(components, len(values))) if values[k] > 1e-9 * values[0]]
    deviation = [sum((len(u) * int(a) - int(s)) ** 2 for a, s in zip(r, u.sum(axis=0))) for r in x]
    return (x - u.mean(axis=0)) @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum(), deviation, len(u)


def collected(df):
    return sorted(df.collect(), key=lambda r: (r.vec_id, r.component))


@pytest.mark.parametrize("dim,count,components", [(5, 40, 16), (20, 60, 16), (12, 6, 16), (3, 30, 2)])
def test_equals_reference(spark, dim, count, components):
    rng = random.Random(dim)
    rows = [[rng.gauss(0, 1 + j) for j in range(dim)] for _ in range(count)]
    rows += rows[:7] + [rows[3]] * 20
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").repartition(4)
    got = collected(whitened(df, components=components))
    exact = [[float(np.float32(v)) for v in r] for r in rows]
    coordinates, explained, deviation, n = reference(exact, components)
    k = coordinates.shape[1]
    assert [r.component for r in got] == list(range(1, k + 1)) * len(rows)
    mine = np.array([r.whitened for r in got]).reshape(-1, k)
    signs = np.sign((mine * coordinates).sum(axis=0))
    np.testing.assert_allclose(mine, coordinates * signs, atol=1e-7)
    np.testing.assert_allclose([r.explained for r in got[:k]], explained, rtol=1e-9)
    assert [r.deviation for r in got[::k]] == deviation and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    again = collected(whitened(df.repartition(2), components=components))
    assert [r[:-1] for r in again] == [r[:-1] for r in got]


def test_equal_eigenvalues(spark):
    """The corners of a cube: one space of three dimensions."""
    rows = list(enumerate([list(map(float, p)) for p in itertools.product((-1, 1), repeat=3)]))
    got = collected(whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    w = np.array([r.whitened for r in got]).reshape(-1, 3)
    np.testing.assert_allclose(w.T @ w / 8, np.eye(3), atol=1e-12)
    assert all(abs(r.explained - 1 / 3) < 1e-15 for r in got)


def test_wide_numbers(spark, monkeypatch):
    """Blocks of whole numbers beyond the exact range of doubles."""
    rng = random.Random(1)
    y = [[rng.randint(-(2**30), 2**30) for _ in range(3)] for _ in range(50)]
    fit = spark.createDataFrame([(r,) for r in y], "y array<long>").repartition(3)
    n, s, c = whitening.scatter(fit, 3)
    assert n == 50 and s == [sum(r[i] for r in y) for i in range(3)]
    assert c == [[50 * sum(r[i] * r[j] for r in y) - s[i] * s[j] for j in range(3)] for i in range(3)]
    model = fit_whitening(spark, fit, 3, 3)
    total = [sum(Fraction(v[i] * v[j]) for i, j in ((0, 0), (1, 1), (2, 2))) for v in model.vectors.tolist()]
    assert all(abs(float(t) - 1) < 1e-15 for t in total)


def test_unusable_rows_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, 1.0], [2.0, -1.0], [0.1, 0.1]]
    bad = [None, [], [1.0, None], [nan, 1.0], [1.0, inf], [-inf, 0.0], [1.0]]
    rows = [(i, v, "id", "y") for i, v in enumerate(good + bad)] + [(None, good[0], "", "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, y string")
    got = whitened(df).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [0, 1, 2] and len(got) == 8
    assert {r.n for r in got} == {3}


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitened(df).collect() == []
    assert whitened(df.limit(0)).collect() == []
    assert whitened(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == []
