import numpy as np
import pytest

from loanlens.llm.whitening import fit_whitening, inertia_above, leading_eigenpairs, usable, whiten

SCHEMA = "vec_id long, embedding array<float>, id string, x int, n double, v long"


def vectors(spark, rows, ids=None):
    rows = [(i, v, "a", 1, 2.0, 3) for i, v in zip(ids or range(len(rows)), rows)]
    return spark.createDataFrame(rows, SCHEMA)


def spectra(n):
    return {
        "random": np.random.default_rng(n).random(n),
        "equal": np.ones(n),
        "cluster": np.r_[5, 5, 5, 5, np.ones(n)][:n],
        "graded": 10.0 ** -np.arange(n),
        "near": np.r_[1, 1 - 1e-9, 1 - 2e-9, 0.3, np.zeros(n)][:n],
        "zero": np.zeros(n),
    }


@pytest.mark.parametrize("n", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", spectra(1))
def test_eigenpairs(n, kind):
    q, _ = np.linalg.qr(np.random.default_rng(n + 9).standard_normal((n, n)))
    a = (q * spectra(n)[kind]) @ q.T
    a = (a + a.T) / 2
    values, basis = leading_eigenpairs(a, 4)
    want = np.linalg.eigvalsh(a)[::-1]
    np.testing.assert_allclose(values, want[: len(values)], atol=1e-13)
    assert len(values) == min(4, (want > 1e-11).sum()) and (np.diff(values) <= 0).all()
    np.testing.assert_allclose(a @ basis, basis * values, atol=1e-12)
    np.testing.assert_allclose(basis.T @ basis, np.eye(len(values)), atol=1e-12)


def test_inertia_counts_with_zero_diagonals():
    rng = np.random.default_rng(1)
    for n in range(1, 30):
        a = rng.integers(-3, 4, (n, n)).astype(float)
        a = a + a.T
        np.fill_diagonal(a, 0)
        for shift in (0.3, -1.7, 2.2):
            assert inertia_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def brute(rows):
    x = np.floor(256 * np.array(rows, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(4, (values > 1e-9 * max(values.sum(), 1e-300)).sum())
    deviation = ((n * x - total).astype(object) ** 2).sum(1)
    return n, deviation, (x - total / n) @ basis[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def compare(got, rows):
    n, deviation, white, explained = brute(rows)
    got = sorted(got, key=lambda r: r["vec_id"])
    assert [r["n"] for r in got] == [n] * len(rows)
    assert [r["deviation"] for r in got] == list(deviation)
    mine = np.array([r["whitened"] for r in got])
    sign = np.sign((mine * white).sum(0))
    np.testing.assert_allclose(mine * sign, white, atol=1e-8)
    np.testing.assert_allclose([r["explained"] for r in got], np.tile(explained, (len(rows), 1)), rtol=1e-9)
    assert got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("offset", [0.0, 5000.0])
def test_against_dense_algebra(spark, offset):
    rng = np.random.default_rng(3)
    rows = (rng.standard_normal((300, 7)) * [5, 4, 3, 2, 1, 1, 1] + offset).astype(np.float32)
    rows = np.vstack([rows, rows[:40], rows[:1].repeat(100, 0)]).tolist()
    compare(whiten(vectors(spark, rows).repartition(5)).collect(), rows)


def test_few_dimensions(spark):
    rows = [[float(i), float(i % 3), 2.0] for i in range(9)]
    got = whiten(vectors(spark, rows)).collect()
    assert {len(r["whitened"]) for r in got} == {2}
    compare(got, rows)


def test_broken_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.5, -0.25], [1.0, 0.0], [-0.0, 0.75], [0.5, -0.25]]
    bad = [None, [], [nan, 0.0], [0.0, inf], [None, 1.0], [1.0], [1.0, 2.0, 3.0]]
    got = whiten(vectors(spark, good + bad)).collect()
    assert sorted(r["vec_id"] for r in got) == [0, 1, 2, 3]
    compare(got, good)
    ids = [7, None, 7, None]
    assert sorted(map(str, (r["vec_id"] for r in whiten(vectors(spark, good, ids)).collect()))) == ["7", "7", "None", "None"]


def test_no_or_equal_vectors(spark):
    assert whiten(vectors(spark, [[1.0]]).limit(0)).collect() == []
    assert whiten(vectors(spark, [None, []])).collect() == []
    same = whiten(vectors(spark, [[1.0, 2.0]] * 3)).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in same] == [(1, 0, [])] * 3


def test_huge_entries(spark):
    rows = [[1e30, 0.0], [1e12, 1.0], [0.0, 2.0]]
    got = {r["vec_id"]: r for r in whiten(vectors(spark, rows)).collect()}
    assert got[0]["deviation"] is None  # beyond a long
    points, width = usable(vectors(spark, rows[1:] * 3), "vec_id", "embedding")
    fitted = fit_whitening(points, width, 2)
    assert fitted.sums == (int(np.float32(1e12)) * 256, 3 * 256)
