import math

import numpy as np
import pytest

from loanlens.llm import near_vectors as op
from tests.llm.helpers import by_id, smallest_reachable


def vectors(spark, rows, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for i, v in rows]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, block int")


def clustered(seed, n=300, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, width))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, width)) * rng.choice([0.02, 0.2, 0.5], (n, 1))
    x[n // 2 : n // 2 + 12] = x[0]  # exact copies
    return np.float32(x * rng.choice([0.1, 1, 50], (n, 1)))


def expected(x, cosine):
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    return linked.sum(1).tolist(), smallest_reachable(len(x), list(zip(*map(list, np.nonzero(linked)))))


@pytest.mark.parametrize("cosine, width", [(0.95, 16), (0.8, 5), (0.99, 2), (0.95, 1)])
def test_brute_force(spark, cosine, width, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 50)
    monkeypatch.setattr(op, "LEAF", 8)
    x = clustered(width, width=width)
    found = by_id(op.near_vectors(vectors(spark, enumerate(x)), cosine), "vec_id")
    links, roots = expected(x, cosine)
    assert [found[i]["n_links"] for i in range(len(x))] == links
    assert [found[i]["component_id"] for i in range(len(x))] == roots
    assert [found[i]["kept"] for i in range(len(x))] == [i == r for i, r in enumerate(roots)]


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]),
            (7, [math.nan, 1.0, 0.0]), (8, [math.inf, 0.0, 0.0]), (None, one), (9, [2.0, -0.0, 0.0]), (9, [2.0, -0.0, 0.0]),
            (10, [1e300, 0.0, 0.0]), (11, [-1.0, 0.0, 0.0])]
    found = op.near_vectors(vectors(spark, rows, "double")).collect()
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert len(found) == len(rows)
    lone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 11)} | {(None, 0, None, False)}
    assert got == lone | {(1, 4, 1, True), (2, 4, 1, False), (9, 4, 1, False), (10, 4, 1, False)}


def test_empty_tables(spark):
    assert op.near_vectors(vectors(spark, [])).count() == 0
    rows = op.near_vectors(vectors(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_ties_at_the_threshold(spark, kind):
    """Pairs such as (1, 0, ...) and (19, 6, 1, 1, 1) / 20 have a cosine of exactly 0.95."""
    rows, width = [], 64
    for k in range(60):
        a, b = np.zeros(width), np.zeros(width)
        a[k] = 1.0
        b[[(k + i) % width for i in range(5)]] = [19, 6, 1, 1, 1]
        rows += [a, b]
    x = np.array(rows) * np.array([1.0, 3.0, 0.5])[np.arange(120) % 3][:, None]
    dot = x @ x.T  # whole and half numbers: exact
    norms = np.sqrt((x * x).sum(1))
    linked = dot / (norms[:, None] * norms) >= 0.95
    np.fill_diagonal(linked, False)
    assert linked.sum() >= 120
    found = by_id(op.near_vectors(vectors(spark, enumerate(x), kind)), "vec_id")
    assert [found[i]["n_links"] for i in range(120)] == linked.sum(1).tolist()
    big = by_id(op.near_vectors(vectors(spark, enumerate(x * 1e200), "double")), "vec_id")
    assert sum(r["n_links"] for r in big.values()) >= 120
