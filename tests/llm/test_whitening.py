from fractions import Fraction

import numpy as np
import pytest

from textfeat.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def test_op12_equals_plain_linear_algebra(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    whole = np.floor(64 * np.array([r.embedding for r in table], float)) + 1_000_000
    different = np.unique(whole, axis=0)
    n, sums = len(different), different.sum(0)
    variances, axes = np.linalg.eigh(np.cov(different.T, bias=True))
    variances, axes = variances[::-1][:16], axes[:, ::-1][:, :16]
    found = queries.op12_whitening(spark, SF).toPandas()
    assert len(found) == 16 * len(table) and set(found.n) == {n} and set(found.component) == set(range(1, 17))
    by_row = found.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in table]].to_numpy()
    plain = (whole - sums / n) @ axes / np.sqrt(variances)
    sign = np.sign((by_row * plain).sum(0))
    assert np.abs(by_row - sign * plain).max() < 1e-6
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.abs(shares / (variances / np.trace(np.cov(different.T, bias=True))) - 1).max() < 1e-9
    deviation = found[found.component == 1].set_index("vec_id").deviation.loc[[r.vec_id for r in table]]
    assert deviation.tolist() == [int(x) for x in ((n * whole - sums) ** 2).sum(1)]
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_polynomial_is_exact(spark, d):
    rng = np.random.default_rng(d)
    half = rng.integers(-(10**6), 10**6, (d, d))
    if d == 7:
        half[:, 3] = half[:, 1]  # of lower rank
    matrix = (half.T.astype(object) @ half.astype(object)).tolist()
    found = whitening.characteristic_polynomial(spark, matrix)
    # Faddeev and LeVerrier's recurrence in fractions
    a = np.array([[Fraction(x) for x in row] for row in matrix], object)
    m, wanted = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object), [Fraction(1)]
    for k in range(1, d + 1):
        product = a @ m
        wanted.append(-np.trace(product) / k)
        m = product + wanted[-1] * np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
    assert found == [int(c) for c in wanted[::-1]]


def test_hessenberg_with_zero_pivots():
    p = whitening.primes(1)[0]
    matrix = np.array([[0, 0, 1, 0], [0, 2, 0, 5], [1, 0, 3, 0], [0, 5, 0, 4]])
    found = whitening.polynomial_modulo(matrix, p)
    wanted = np.round(np.poly(matrix.astype(float)))[::-1].astype(int) % p
    assert found.tolist() == wanted.tolist()


def test_roots_are_isolated_with_multiplicity():
    # (x - 1)^3 (x - 10)^2 (x - 11) x^2
    polynomial = [1]
    for root in (1, 1, 1, 10, 10, 11, 0, 0):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    assert whitening.roots_above(polynomial, 5) == 3 and whitening.roots_above(polynomial, 10) == 1
    found = whitening.largest_roots(polynomial, 5)
    assert [round(float(r.value()), 12) for r in found] == [11, 10, 1] and [r.times for r in found] == [1, 2, 2]
    assert len(whitening.largest_roots([0, 0, 1], 4)) == 0


def test_equal_variances_give_an_orthonormal_basis():
    matrix = [[2, 0, 0], [0, 2, 0], [0, 0, 7]]
    roots = whitening.largest_roots([-28, 32, -11, 1], 3)
    axes = np.array([v for r in roots for v in whitening.null_space(matrix, r)])
    assert np.abs(axes @ axes.T - np.eye(3)).max() < 1e-12 and abs(abs(axes[0, 2]) - 1) < 1e-12


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    plain = [(i, rng.standard_normal(5).tolist()) for i in range(30)]
    odd = [(50, None), (51, [None] * 5), (52, [float("nan")] * 5), (53, [float("-inf")] * 5), (54, [1.0]), (55, [])]
    again = [(3, plain[3][1])] * 4 + [(None, plain[3][1])]
    rows = spark.createDataFrame([(*r, 1, "x") for r in plain + odd + again], "vec_id long, embedding array<double>, component int, whole string")
    found = whitening.whiten(rows).toPandas()
    assert len(found) == 5 * 35 and set(found.n) == {30}  # repeated vectors are fitted once
    assert found.identity_error[0] < 1e-10 and abs(found[found.vec_id == 0].explained.sum() - 1) < 1e-9
    same = found[(found.vec_id == 3) | found.vec_id.isna()].groupby("component").whitened.nunique()
    assert set(same) == {1}
    assert whitening.whiten(rows.limit(0)).count() == 0
    assert whitening.whiten(rows.where("vec_id = 3")).count() == 0  # one vector does not vary


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**30 + i), -float(i * i) * 2**20, 1.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(df, components=1, scale=1).orderBy("vec_id").collect()
    sums = [sum(int(v[k]) for _, v in rows) for k in range(3)]
    assert [r.deviation for r in found] == [sum((4 * int(x) - s) ** 2 for x, s in zip(v, sums)) for _, v in rows]
    assert len({r.component for r in found}) == 1 and found[0].identity_error < 1e-9
