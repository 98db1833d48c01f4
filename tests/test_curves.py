import random

import numpy as np
import pytest

from loanlens.operators import curves
from loanlens.operators.evaluation import (
    calibration,
    class_report,
    confusion,
    confusion_at,
    evaluate,
    pd_histogram,
)


def frame(spark, pairs):
    return spark.createDataFrame([(float(p), int(y)) for p, y in pairs], "p double, target int")


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(3)
    out = []
    for _ in range(3000):
        y = rng.random() < 0.3
        out.append((round(min(max(rng.gauss(0.45 if y else 0.35, 0.2), 0), 1), 4), int(y)))
    return out


def brute_force(pairs):
    p, y = (np.array(v, dtype=float) for v in zip(*pairs))
    n_bad, n_good = y.sum(), (1 - y).sum()
    points = []
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        points.append((t, (hit & (y == 1)).sum(), (hit & (y == 0)).sum()))
    tpr = np.array([b / n_bad for _, b, _ in points])
    fpr = np.array([g / n_good for _, _, g in points])
    precision = np.array([b / (b + g) for _, b, g in points])
    steps = np.diff(np.concatenate([[0], tpr]))
    bads, goods = p[y == 1], p[y == 0]
    auc = ((bads[:, None] > goods) + 0.5 * (bads[:, None] == goods)).mean()
    best = int(np.argmax(np.round(tpr - fpr, 12)))
    return {
        "roc_auc": auc,
        "pr_auc": (steps * precision).sum(),
        "ks_stat": np.abs(tpr - fpr).max(),
        "threshold": points[best][0],
        "precision": precision[best],
        "recall": tpr[best],
    }


def test_metrics_against_brute_force(spark, pairs):
    expected = brute_force(pairs)
    for places in (4, None):
        row = evaluate(frame(spark, pairs), places=places).first()
        for name, value in expected.items():
            assert row[name] == pytest.approx(value, abs=5.1e-5), name
        assert row.n_test == len(pairs)


def test_ranges_give_the_same_curve_as_a_single_task(spark, pairs):
    # A third of the rows shares one probability.
    df = frame(spark, pairs + [(0.5, i % 2) for i in range(1500)])
    whole = sorted(map(tuple, curves.curve(df, places=4).select("p", "cum_bad", "cum_good", "n_bad", "n_good").collect()))
    for ranges in (1, 7, 512):
        split = curves.curve(df, ranges=ranges)
        assert sorted(map(tuple, split.select("p", "cum_bad", "cum_good", "n_bad", "n_good").collect())) == whole


def test_swapped_scores_mirror_the_area(spark, pairs):
    points = curves.curve(frame(spark, pairs), places=4)
    mirrored = curves.curve(frame(spark, [(1 - p, y) for p, y in pairs]), places=4)
    total = curves.roc_auc(points).first()[0] + curves.roc_auc(mirrored).first()[0]
    assert total == pytest.approx(1)


def test_one_class_only(spark):
    row = evaluate(frame(spark, [(0.2, 0), (0.4, 0)]), places=4).first()
    assert (row.ks_stat, row.roc_auc, row.threshold, row.f1, row.bad_rate) == (0, None, None, 0, 0)
    counts = confusion(curves.curve(frame(spark, [(0.2, 0), (0.4, 0)]), places=4)).first()
    assert tuple(counts) == (2, 0, 0, 0)


def test_useless_scores_have_no_threshold(spark):
    points = curves.curve(frame(spark, [(0.5, 0), (0.5, 1)]), places=4)
    assert curves.optimal_threshold(points).first()[0] is None
    assert curves.roc_auc(points).first()[0] == 0.5


def test_curve_ends(spark, pairs):
    points = curves.curve(frame(spark, pairs), places=4)
    roc = curves.roc_curve(points).toPandas()
    assert roc.threshold.isna().sum() == 1 and roc.tpr.max() == 1 and roc.fpr.min() == 0
    pr = curves.pr_curve(points).toPandas()
    assert pr[pr.threshold.isna()].precision.item() == 1
    ks = curves.ks_curve(points).toPandas()
    assert ks.population.max() == 1


def test_confusion_and_report(spark):
    df = frame(spark, [(0.9, 1), (0.8, 0), (0.7, 1), (0.2, 0), (0.1, 0)])
    assert tuple(confusion_at(df, 0.7).first()) == (2, 1, 0, 2)
    assert tuple(confusion(curves.curve(df, places=4)).first()) == (2, 1, 0, 2)
    report = {r.label: r for r in class_report(confusion_at(df, 0.7)).collect()}
    assert (report["Good"].recall, report["Good"].support) == (pytest.approx(2 / 3), 3)
    assert report["Bad"].precision == pytest.approx(2 / 3)
    assert report["accuracy"].f1 == pytest.approx(0.8)
    assert report["macro avg"].recall == pytest.approx((1 + 2 / 3) / 2)
    assert report["weighted avg"].recall == pytest.approx(0.8)


def test_calibration_bins(spark, pairs):
    edges = np.linspace(0, 1, 11)
    p, y = (np.array(v, dtype=float) for v in zip(*pairs))
    bins = np.searchsorted(edges[1:-1], p) + 1
    got = {r.bin: r for r in calibration(frame(spark, pairs)).collect()}
    assert set(got) == set(bins)
    for b in set(bins):
        assert got[b].n == (bins == b).sum()
        assert got[b].bad_share == pytest.approx(y[bins == b].mean())
        assert got[b].mean_predicted == pytest.approx(p[bins == b].mean())


def test_histogram_against_numpy(spark, pairs):
    got = {}
    for r in pd_histogram(frame(spark, pairs)).collect():
        got.setdefault(r.label, {})[r.bin] = r.n
    for label in (0, 1):
        counts, _ = np.histogram([p for p, y in pairs if y == label], bins=40)
        # Values on an edge may fall on either side of it.
        mine = np.array([got[label].get(b, 0) for b in range(1, 41)])
        assert mine.sum() == counts.sum() and np.abs(mine - counts).max() <= 2
    flat = pd_histogram(frame(spark, [(0.5, 1)] * 3)).collect()
    assert [(r.bin, r.n) for r in flat] == [(21, 3)]


def test_missing_probabilities_and_labels_are_no_points(spark):
    rows = [(0.9, 1), (0.2, 0), (None, 0), (0.4, 1), (0.5, 0), (0.7, None)]
    df = spark.createDataFrame(rows, "p double, target int")
    for places in (4, None):
        row = evaluate(df, places=places).first()
        assert (row.roc_auc, row.n_test) == (0.75, 4)
    assert sum(r.n for r in calibration(df).collect()) == 4
    assert sum(r.n for r in pd_histogram(df).collect()) == 4


def test_constant_probability_and_empty_table(spark):
    df = frame(spark, [(0.3, i % 2) for i in range(40)])
    assert curves.curve(df).count() == 1 and evaluate(df).first().roc_auc == 0.5
    assert curves.curve(df.limit(0)).count() == 0


def test_points_are_computed_once(spark, pairs, tmp_path):
    """The scored rows are read for the points alone; all else comes from the written points."""
    frame(spark, pairs).write.parquet(str(tmp_path / "scored"))
    points = curves.curve(spark.read.parquet(str(tmp_path / "scored")))
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path) not in plan
