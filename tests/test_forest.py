"""Forests grown tree by tree, against Spark's own and against direct computation."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanlens.config import Config, TrainingProfile
from loanlens.operators import forest, trees
from loanlens.operators.forest import Growth, grow_tree, thresholds
from loanlens.operators.trees import base_value, packed_trees, shapley
from loanlens.plans import training
from loanlens.plans.training import fit_candidate
from loanlens.session import cut_lineage, spread
from tests.test_models import deep_tree

CFG = Config(profile=TrainingProfile(forest_trees=40, max_bins=32))
FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Loans whose risk grows with a and falls with b; d never varies. Ids repeat or are missing."""
    rng = np.random.default_rng(5)
    n = 3000
    a, b, c = rng.normal(size=n), rng.integers(0, 5, n), rng.random(n)
    target = rng.random(n) < 1 / (1 + np.exp(1 - 2 * a + 0.5 * b))
    values = zip([None if i % 7 == 0 else str(i % 900) for i in range(n)], a, b, c, target)
    data = [(i, float(a), float(b), float(c), 1.0, int(y)) for i, a, b, c, y in values]
    return cut_lineage(spark.createDataFrame(data, "LOAN_ID string, a double, b double, c double, d double, target int").repartition(3))


@pytest.fixture(scope="module")
def both(rows):
    """Spark's forest, and that of this module."""
    plain = fit_candidate(rows, FEATURES, "forest", CFG)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(forest, "MOST_ROWS", 1000)
        patch.setattr(RandomForestClassifier, "fit", lambda *_: pytest.fail("fitted by Spark"))
        return plain, fit_candidate(rows, FEATURES, "forest", CFG)


def test_large_tables_are_fitted_tree_by_tree(rows, both):
    """Spark's fit shuffles the counts of every open node again and again. The forests differ
    no more than two of Spark's with different seeds."""
    plain, own = both
    other = fit_candidate(rows, FEATURES, "forest", CFG.with_(seed=7))
    assert type(own.classifier) is type(plain.classifier)
    assert (own.classifier.getNumTrees, own.classifier.numFeatures, own.classifier.numClasses) == (40, 4, 2)
    assert own.classifier.getMaxDepth() == 12 and own.classifier.getMinInstancesPerNode() == 10
    nodes = [m.classifier.totalNumNodes for m in both]
    assert nodes[1] == pytest.approx(nodes[0], rel=0.1)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="target", numBins=0)
    scored = [m.add_probability(rows) for m in (*both, other)]
    auc = [evaluator.evaluate(s) for s in scored]
    assert auc[0] > 0.75 and auc[1] == pytest.approx(auc[0], abs=0.01)
    p = [np.array([r.p for r in s.orderBy(*rows.columns).select("p").collect()]) for s in scored]
    assert abs((p[1] - p[0]).mean()) < 0.01
    assert np.abs(p[1] - p[0]).mean() < 1.2 * np.abs(p[2] - p[0]).mean()
    assert np.allclose(*(m.classifier.featureImportances.toArray() for m in both), atol=0.05)


def test_grown_forests_are_explained_and_kept(spark, rows, both, tmp_path):
    model = both[1]
    packed = packed_trees(model.classifier)
    out = model.add_attributions(model.add_probability(rows), trees=packed).select("p", "attributions").toPandas()
    total = base_value(packed) + np.vstack(out.attributions).sum(axis=1)
    assert np.allclose(total, out.p, atol=1e-9)
    model.save(str(tmp_path / "m"))
    loaded = training.TrainedModel.load(spark, str(tmp_path / "m"))
    before, after = (m.add_probability(rows).select("LOAN_ID", "p") for m in (model, loaded))
    assert before.exceptAll(after).count() == 0
    # Read back from Spark's model, which has no table of nodes at hand.
    again = packed_trees(loaded.classifier).orderBy("tree").collect()
    assert [tuple(r) for r in packed.orderBy("tree").collect()] == [tuple(r) for r in again]


def test_sizes_and_settings_that_go_to_spark():
    plain = RandomForestClassifier(numTrees=500, maxBins=256, featureSubsetStrategy="sqrt", maxDepth=12)
    assert forest.grows_alone(plain, 900_000, 33)
    assert not forest.grows_alone(plain, 60_000, 33) and not forest.grows_alone(plain, 10_000_000, 33)
    for other in ({"impurity": "entropy"}, {"maxBins": 300}, {"subsamplingRate": 0.5}, {"featureSubsetStrategy": "all"}):
        assert not forest.grows_alone(plain.copy().setParams(**other), 900_000, 33)


def test_rows_without_a_usable_label_or_value(spark, rows, monkeypatch):
    """As Spark's own fit, which refuses them."""
    monkeypatch.setattr(forest, "MOST_ROWS", 1000)
    for broken in (F.lit(None).cast("int"), F.lit(-1)):
        some = rows.withColumn("target", F.when(F.col("a") < 2, F.col("target")).otherwise(broken))
        with pytest.raises(Exception, match="Labels MUST"):
            fit_candidate(some, FEATURES, "forest", CFG)
    with pytest.raises(Exception, match="must not be NaN or infinite"):
        fit_candidate(rows.withColumn("a", F.when(F.col("b") < 4, F.col("a")).otherwise(math.inf)), FEATURES, "forest", CFG)


@pytest.mark.parametrize("most", [300, 31, 3])
def test_thresholds_are_those_of_spark(spark, most):
    rng = np.random.default_rng(2)
    x = np.round(rng.gamma(2, 2, 400), 1)
    y = (rng.random(400) < 0.4).astype(int)
    weights = np.where(y == 1, 1.25, 0.8)
    values, place = np.unique(x, return_inverse=True)
    found = thresholds(values, np.bincount(place, weights), most)
    df = spark.createDataFrame([(float(v), int(t), float(w)) for v, t, w in zip(x, y, weights)], "x double, target int, w double")
    from pyspark.ml.feature import VectorAssembler

    tree = RandomForestClassifier(
        numTrees=300, maxDepth=3, maxBins=most + 1, labelCol="target", weightCol="w", featuresCol="v", minInstancesPerNode=1
    ).fit(VectorAssembler(inputCols=["x"], outputCol="v").transform(df))
    used = trees.node_table(tree).where("left >= 0").select("threshold").distinct().collect()
    used = {r.threshold for r in used}
    assert used and all(np.abs(found - t).min() < 1e-9 for t in used) and len(found) <= most
    assert len(used) > len(found) / 3


def brute(bins, label, times, grow, subset):
    """Best gain over the given features, from the definition."""
    def gini(mask):
        w = [times[mask & (label == c)].sum() * grow.weights[c] for c in (0, 1)]
        return 1 - sum((v / sum(w)) ** 2 for v in w), sum(w)

    whole, weight = gini(np.ones(len(label), bool))
    best = 0.0
    for f in subset:
        for b in range(len(grow.cuts[f])):
            left = bins[:, f] <= b
            if min(times[left].sum(), times[~left].sum()) >= grow.min_rows:
                (gl, wl), (gr, wr) = gini(left), gini(~left)
                best = max(best, whole - wl / weight * gl - wr / weight * gr)
    return best


def test_a_tree_against_its_definition():
    rng = np.random.default_rng(8)
    x = np.stack([rng.normal(size=500), rng.integers(0, 4, 500), np.ones(500)], 1)
    label = (rng.random(500) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(np.uint8)
    cuts = [thresholds(*forest._distinct(x[:, f], np.ones(500)), 20) for f in range(3)]
    bins = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1).astype(np.uint8)
    grow = Growth(cuts, (0.9, 1.2), 6, 10, 3, 4)
    tree = grow_tree(bins, label, 0, grow)
    times = np.random.default_rng([4, 0]).poisson(1.0, 500)
    reach = {0: np.ones(500, bool)}
    for node in range(len(tree.left)):
        mine = reach[node]
        assert tree.counts[node].tolist() == [times[mine & (label == c)].sum() for c in (0, 1)]
        if tree.left[node] >= 0:
            assert tree.gain[node] == pytest.approx(brute(bins[mine], label[mine], times[mine], grow, range(3)), abs=1e-12)
            goes = x[:, tree.feature[node]] <= tree.threshold[node]
            reach[tree.left[node]], reach[tree.right[node]] = mine & goes, mine & ~goes
            below = tree.counts[[tree.left[node], tree.right[node]]] * grow.weights
            assert tree.counts[[tree.left[node], tree.right[node]]].sum(axis=1).min() >= 10
            # Leaves that predict the same class are one.
            both = tree.left[[tree.left[node], tree.right[node]]] < 0
            assert not both.all() or (below[0, 1] > below[0, 0]) != (below[1, 1] > below[1, 0])
    assert len(tree.left) > 5
    other, again = grow_tree(bins, label, 1, grow), grow_tree(bins, label, 0, grow)
    assert all((a == b).all() for a, b in zip(tree, again)) and len(other.left) > 1
    # One class, or too few rows, is one leaf.
    for few in (slice(0, 500), slice(0, 12)):
        alone = grow_tree(bins[few], np.zeros(len(label[few]), np.uint8), 0, grow)
        assert alone.left.tolist() == [-1]


def test_rows_that_a_region_does_not_tell_apart_are_one():
    """Rows that larger subtrees do not tell apart are worked out once, with the same values."""
    rng = np.random.default_rng(11)
    x = np.hstack([rng.normal(size=(6000, 6)), rng.random((6000, 4)) < 0.3]).astype(float)
    nodes = 0
    while nodes < 100:  # some trees have no more than a root
        base, packed, predicted, nodes = deep_tree(rng, x, 10)
    asked, chunk = [], trees._TreeValues._add_chunk

    def counted(self, root, key, *rest):
        asked.append(len(key))
        return chunk(self, root, key, *rest)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(trees._TreeValues, "_add_chunk", counted)
        found = shapley([packed], x)
        # Before, each small subtree looked up every row.
        assert len(asked) > 10 and sum(asked) < 0.6 * len(asked) * len(x)
        for bits, most in ((18, 0), (6, 1 << 24)):
            patch.setattr(trees, "REGION_BITS", bits)
            patch.setattr(trees, "MOST_TABLE", most)
            assert np.allclose(shapley([packed], x), found, atol=1e-12)
    assert np.allclose(base + found.sum(axis=1), predicted, atol=1e-12)
    assert np.allclose(shapley([packed], x[::2]), found[::2], atol=1e-12)


def test_batches_are_worked_on_together(monkeypatch):
    """As many batches as a size allows; before, each was worked on alone."""
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(4000, 6)), rng.random((4000, 4)) < 0.3]).astype(float)
    _, packed, _, _ = deep_tree(rng, x, 10)
    sizes, plain = [], trees._values

    def counted(edges, cuts, places):
        sizes.append(len(places[0]))
        return plain(edges, cuts, places)

    monkeypatch.setattr(trees, "_values", counted)
    monkeypatch.setattr(trees, "MAX_ROW_BYTES", 1500 * 10 * 8)
    batches = [pa.array(x[a:b].tolist(), pa.list_(pa.float64())) for a, b in ((0, 1000), (0, 0), (1000, 2500), (2500, 4000), (0, 7))]
    found = list(trees._shared_values([packed, []], iter(batches)))
    assert sizes == [2500, 1500, 7] and sorted(map(len, found)) == sorted(map(len, batches))
    values = [row for own in found for row in own.to_pylist()]
    assert np.allclose(values, shapley([packed], x[[*range(4000), *range(7)]]), atol=1e-12)
    assert list(trees._shared_values([packed], iter([]))) == []
    (none,) = trees._shared_values([[]], iter(batches[:1]))
    assert np.array_equal(none.to_pylist(), np.zeros((1000, 10)))


def test_as_many_files_for_each_core(spark, monkeypatch):
    monkeypatch.setattr("loanlens.session.MOST_ROWS", 1000)
    cores = spark.sparkContext.defaultParallelism
    rows = spread(cut_lineage(spark.range(1000 * cores + 1).select(F.col("id").cast("string").alias("i")).coalesce(1)))
    assert rows.rdd.getNumPartitions() == 2 * cores and rows.count() == rows.distinct().count() == 1000 * cores + 1
