import itertools
import json
import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens import TrainedModel, evaluate, evaluate_model, explain_portfolio, score_portfolio, train
from loanlens.config import MODEL_FEATURES, TARGET, Config, TrainingProfile
from loanlens.operators.candidates import ClassCounts, candidates
from loanlens.operators.importance import compute_shap
from loanlens.operators.scoring import score_requests
from loanlens.operators.trees import base_value, node_table, packed_trees, shapley, tree_levels
from loanlens.plans import training
from loanlens.plans.training import best_model, cv_summary, fit_candidate, fold_counts, prepare_xy
from loanlens.session import cut_lineage
from loanlens.streaming import read_request_stream, read_requests, score_requests_stream

CFG = Config(cv_folds=2, profile=TrainingProfile(forest_trees=6, boosting_rounds=4, max_bins=16))


@pytest.fixture(scope="module")
def labelled(spark):
    """Loans whose risk grows with early arrears and falls with the survey score."""
    rng = random.Random(11)
    rows = []
    for i in range(900):
        dpd, nps = rng.uniform(0, 60), rng.choice([None, *range(11)])
        age = rng.choice([None, "18-25", "36-45", "55+"])
        risk = 1 / (1 + math.exp(-(-2.5 + 0.08 * dpd - 0.1 * (nps or 5) + (age == "18-25"))))
        rows.append((str(i), dpd, None if nps is None else float(nps), rng.uniform(0, 1e5), age, "150K+", int(rng.random() < risk)))
    schema = "LOAN_ID string, early_max_dpd double, nps_score double, loan_amount double, age_band string, income_band string, target int"
    return cut_lineage(spark.createDataFrame(rows, schema).repartition(3))


@pytest.fixture(scope="module")
def rows(labelled):
    prepared, features, medians = prepare_xy(labelled)
    return cut_lineage(prepared), features, medians


def test_model_input(rows):
    df, features, medians = rows
    assert features == [f for f in MODEL_FEATURES if f in ("early_max_dpd", "nps_score", "loan_amount") or "band_" in f]
    assert df.filter(" OR ".join(f"`{f}` IS NULL" for f in features)).count() == 0
    assert medians["nps_score"] == 5.0
    with pytest.raises(ValueError):
        prepare_xy(df.select("LOAN_ID", TARGET))


def newton(x, y, weight, penalty):
    """Minimise the weighted log loss plus penalty / 2 |w|^2, intercept free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    scale = np.abs(x1).max(axis=0)
    x1 = x1 / scale
    ridge = np.diag(np.append(np.full(x.shape[1], penalty), 0.0) / scale**2)
    w = np.zeros(x1.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ w))
        gradient = x1.T @ (weight * (p - y)) + ridge @ w
        hessian = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + ridge
        w -= np.linalg.solve(hessian, gradient)
    return w / scale


def test_logistic_coefficients(rows):
    df, _, _ = rows
    features = ["early_max_dpd", "nps_score", "age_band_18-25"]
    model = fit_candidate(df, features, "logistic", CFG)
    data = df.select(*[F.col(f"`{f}`") for f in features], TARGET).toPandas().to_numpy(dtype=float)
    x, y = data[:, :-1], data[:, -1]
    weight = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (1 - y).sum())
    expected = newton(x, y, weight, penalty=1 / 0.01)
    assert np.allclose(model.classifier.coefficients.toArray(), expected[:-1], atol=1e-5)
    assert model.classifier.intercept == pytest.approx(expected[-1], abs=1e-4)


def test_candidates():
    counts = ClassCounts(good=30, bad=10)
    known = candidates(Config())
    assert list(known) == ["logistic", "forest", "boosted_a", "boosted_b"]
    assert known["boosted_a"].weights(counts) == (1.0, 15.0)
    assert known["forest"].weights(counts) == (pytest.approx(2 / 3), 2.0)
    assert known["logistic"].build(counts).getRegParam() == pytest.approx(100 / 40)
    full = candidates(Config())
    assert full["forest"].build(counts).getNumTrees() == 500
    assert full["boosted_b"].build(counts).getMaxIter() == 1000
    assert full["boosted_b"].build(counts).getMaxDepth() == 8


@pytest.fixture(scope="module")
def trained(labelled, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    return train(labelled, CFG, model_path=path), path


def test_training(labelled, trained):
    result, _ = trained
    assert result.cv.count() == 8
    summary = {r.model: r.mean_auc for r in cv_summary(result.cv).collect()}
    assert all(auc > 0.6 for auc in summary.values())
    assert result.model.name == best_model(result.cv, CFG) == max(summary, key=summary.get)
    assert 160 < result.test.count() < 200
    metrics = evaluate(result.model.add_probability(result.test)).first()
    assert metrics.roc_auc > 0.6
    # The split depends on the loans only, so the held-out rows are found again.
    again = evaluate_model(result.model, labelled, CFG).first()
    assert (again.roc_auc, again.n_test) == (metrics.roc_auc, metrics.n_test)


def test_only_the_held_out_loans_are_evaluated(labelled, trained):
    """Another seed, share or table would put trained loans among the held-out ones."""
    model = trained[0].model
    for cfg in (CFG.with_(seed=7), CFG.with_(test_size=0.3)):
        with pytest.raises(ValueError, match="held out"):
            evaluate_model(model, labelled, cfg)
    with pytest.raises(ValueError, match="held out"):
        evaluate_model(model, labelled.where("LOAN_ID <> '5'"), CFG)
    with pytest.raises(ValueError, match="held out"):
        evaluate_model(replace(model, trained_on=None), labelled, CFG)
    with pytest.raises(ValueError, match="features"):
        evaluate_model(model, labelled.drop("loan_amount"), CFG)


def test_training_goes_on_after_a_lost_driver(labelled, tmp_path, monkeypatch):
    """The first run stops after two fits; the second fits only the rest, the third nothing."""
    cfg = CFG.with_(candidates=("logistic", "forest"), profile=replace(CFG.profile, fold_parallelism=1))
    fitted = []
    build = candidates

    def counted(stop_after):
        def known(config):
            def wrap(candidate):
                def make(counts):
                    if len(fitted) == stop_after:
                        raise KeyboardInterrupt
                    fitted.append(candidate.name)
                    return candidate.build(counts)

                return replace(candidate, build=make)

            return {name: wrap(c) for name, c in build(config).items()}

        return known

    root = str(tmp_path / "ledger")
    monkeypatch.setattr(training, "candidates", counted(2))
    with pytest.raises(KeyboardInterrupt):
        train(labelled, cfg, ledger_root=root)
    assert fitted == ["logistic", "logistic"]
    fitted.clear()
    monkeypatch.setattr(training, "candidates", counted(99))
    result = train(labelled, cfg, ledger_root=root)
    assert fitted == ["forest", "forest", result.model.name]  # both folds, then the refit
    fitted.clear()
    again = train(labelled, cfg, ledger_root=root)
    assert fitted == [] and again.model.name == result.model.name
    assert sorted(map(tuple, again.cv.collect())) == sorted(map(tuple, result.cv.collect()))
    assert again.model.trained_on == result.model.trained_on
    # A curve's area depends on the order of its sums in the last bits.
    whole = {r[:2]: r.auc for r in train(labelled, cfg).cv.collect()}
    assert whole == pytest.approx({r[:2]: r.auc for r in result.cv.collect()}, abs=1e-9)
    fitted.clear()
    train(labelled.where("LOAN_ID <> '3'"), cfg, ledger_root=root)
    assert len(fitted) == 5  # other rows, another ledger


def test_saved_model_scores_alike(spark, labelled, trained):
    result, path = trained
    loaded = TrainedModel.load(spark, path)
    assert loaded.features == result.features and loaded.name == result.model.name
    before, after = (score_portfolio(m, labelled) for m in (result.model, loaded))
    assert before.columns == ["LOAN_ID", "pd", "score", "risk_band"]
    assert before.exceptAll(after).count() == 0 and after.count() == 900
    with pytest.raises(FileNotFoundError):
        TrainedModel.load(spark, path + "-none")


def test_importances_and_explanations(labelled, trained):
    model = trained[0].model
    ranked = [r.importance for r in model.importances(5).collect()]
    assert len(ranked) == 5 and ranked == sorted(ranked, reverse=True)
    assert compute_shap(model, labelled, n_samples=200).first().feature == "early_max_dpd"
    row = explain_portfolio(model, labelled).first()
    assert len(row.positive_drivers) <= 4 and row.pd_pct.endswith("%")


def test_scaled_logistic_is_explained_in_raw_units(rows):
    df, features, _ = rows
    model = fit_candidate(df, features, "logistic", CFG, scale=True)
    out = model.add_attributions(model.add_probability(df)).select("p", "attributions").toPandas()
    margin = np.log(out.p / (1 - out.p))
    rest = margin - np.vstack(out.attributions).sum(axis=1)
    assert np.ptp(rest) < 1e-6


@pytest.mark.parametrize("scale", [False, True])
@pytest.mark.parametrize("name", ["forest", "boosted_a"])
def test_tree_attributions_sum_to_the_margin(rows, name, scale):
    df, features, _ = rows
    model = fit_candidate(df, features, name, CFG, scale=scale)
    out = model.add_attributions(model.add_probability(df)).select("p", "attributions").toPandas()
    total = base_value(packed_trees(model.classifier)) + np.vstack(out.attributions).sum(axis=1)
    p = out.p.to_numpy()
    assert np.allclose(total, p if name == "forest" else np.log(p / (1 - p)), atol=1e-9)


def expectation(nodes, at, x, known):
    """Mean of a tree when only the ``known`` features of ``x`` are given."""
    node = nodes[at]
    if node.left < 0:
        return node.value
    if node.feature in known:
        child = node.left if x[node.feature] <= node.threshold else node.right
        return expectation(nodes, child, x, known)
    return sum(
        nodes[c].weight / node.weight * expectation(nodes, c, x, known) for c in (node.left, node.right)
    )


def test_tree_attributions_against_all_subsets(rows):
    df, _, _ = rows
    features = ["early_max_dpd", "nps_score", "loan_amount", "age_band_18-25"]
    model = fit_candidate(df, features, "forest", CFG)
    trees = {}
    for r in node_table(model.classifier).collect():
        trees.setdefault(r.tree, {})[r.id] = r
    sample = model.add_attributions(df.orderBy("LOAN_ID").limit(5)).collect()
    m = len(features)
    for row in sample:
        x = [row[f] for f in features]
        for j in range(m):
            expected = 0.0
            others = [i for i in range(m) if i != j]
            for k in range(m):
                for subset in itertools.combinations(others, k):
                    weight = 1 / (m * math.comb(m - 1, k))
                    for nodes in trees.values():
                        with_j = expectation(nodes, 0, x, {*subset, j})
                        expected += weight * (with_j - expectation(nodes, 0, x, set(subset)))
            assert row.attributions[j] == pytest.approx(expected / len(trees), abs=1e-10)


def test_paths_that_meet_a_feature_again_and_empty_nodes():
    """A chain on two features, a node without training rows, a tree of one leaf."""
    import pyarrow as pa

    from loanlens.operators.trees import _EDGE

    nodes = [  # id, left, right, feature, threshold, value, weight
        (0, 1, 2, 0, 5.0, 0.0, 10.0), (1, 3, 4, 1, 2.0, 0.0, 6.0), (2, -1, -1, -1, 0.0, 3.0, 4.0),
        (3, 5, 6, 0, 1.0, 0.0, 6.0), (4, 7, 8, 0, 3.0, 0.0, 0.0), (5, -1, -1, -1, 0.0, -2.0, 2.0),
        (6, -1, -1, -1, 0.0, 7.0, 4.0), (7, -1, -1, -1, 0.0, 11.0, 0.0), (8, -1, -1, -1, 0.0, 13.0, 0.0),
    ]
    names = ["id", "left", "right", "feature", "threshold", "value", "weight"]
    table = pa.table({n: list(c) for n, c in zip(names, zip(*nodes))})
    base, levels = tree_levels(table, 0.5)
    plain = {n[0]: type("Node", (), dict(zip(names, n))) for n in nodes}

    def mean(at, x, known):
        node = plain[at]
        if node.left < 0:
            return node.value / 2
        if node.feature in known:
            return mean(node.left if x[node.feature] <= node.threshold else node.right, x, known)
        weights = [plain[c].weight / node.weight if node.weight else 0.0 for c in (node.left, node.right)]
        return sum(w * mean(c, x, known) for w, c in zip(weights, (node.left, node.right)))

    assert base == pytest.approx(mean(0, None, ()))
    packed = [np.rec.fromarrays(level, dtype=_EDGE).tobytes() for level in levels]
    x = np.array([[a, b] for a in (0.0, 1.0, 2.0, 4.0, 5.0, 9.0) for b in (1.0, 2.0, 3.0)])
    for row, got in zip(x, shapley([packed, [], packed], x)):
        both, first, second, none = (mean(0, row, k) for k in ((0, 1), (0,), (1,), ()))
        assert got == pytest.approx([both - second + first - none, both - first + second - none], abs=1e-12)
    leaf = table.slice(2, 1).set_column(0, "id", pa.array([0]))
    assert tree_levels(leaf, 2.0) == (6.0, [])


def deep_tree(rng, x, depth):
    """A random tree as packed edges: splits at values of the rows that reach them."""
    import pyarrow as pa

    from loanlens.operators.trees import _EDGE

    nodes = []

    def grow(rows, left_over):
        place = len(nodes)
        nodes.append(None)
        feature = int(rng.integers(x.shape[1]))
        cut = float(rng.choice(x[rows, feature]))
        goes_left = x[rows, feature] <= cut
        if left_over and 5 <= goes_left.sum() <= len(rows) - 5:
            below = grow(rows[goes_left], left_over - 1), grow(rows[~goes_left], left_over - 1)
            nodes[place] = (place, *below, feature, cut, 0.0, float(len(rows)))
        else:
            nodes[place] = (place, -1, -1, -1, 0.0, float(rng.random()), float(len(rows)))
        return place

    grow(np.arange(len(x)), depth)
    names = ["id", "left", "right", "feature", "threshold", "value", "weight"]
    base, levels = tree_levels(pa.table({n: list(c) for n, c in zip(names, zip(*nodes))}), 1.0)

    def predicted(row):
        node = nodes[0]
        while node[1] >= 0:
            node = nodes[node[1] if row[node[3]] <= node[4] else node[2]]
        return node[5]

    packed = [np.rec.fromarrays(level, dtype=_EDGE).tobytes() for level in levels]
    return base, packed, np.array([predicted(row) for row in x]), len(nodes)


@pytest.mark.parametrize("bits", [16, 2])
def test_rows_that_meet_the_same_conditions_are_worked_out_once(monkeypatch, bits):
    """Values are computed per combination of conditions; a row by row pass over all edges took
    ten times as long. With and without the table that numbers combinations."""
    from loanlens.operators import trees

    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(4000, 6)), rng.random((4000, 4)) < 0.3]).astype(float)
    base, packed, predicted, nodes = deep_tree(rng, x, 10)
    numbered, combine = [], trees._combinations

    def counted(key, n):
        found = combine(key, n)
        numbered.append(len(found.codes))
        return found

    monkeypatch.setattr(trees, "_combinations", counted)
    monkeypatch.setattr(trees, "TABLE_BITS", bits)
    found = shapley([packed], x)
    assert np.allclose(base + found.sum(axis=1), predicted, atol=1e-12)
    assert nodes > 60 and 1 < len(numbered) < nodes / 4
    assert sum(numbered) < len(numbered) * len(x) / 8
    for place in (0, 17, 3999):
        assert np.allclose(shapley([packed], x[[place]]), found[place], atol=1e-12)


def test_packed_trees_are_made_once(spark, rows, monkeypatch):
    from loanlens.operators import trees
    from loanlens.plans import catalog

    df, features, _ = rows
    model = fit_candidate(df, features, "forest", CFG)
    made, table = [], trees.node_table
    monkeypatch.setattr(catalog, "_forest", lambda *_: (model, df))
    monkeypatch.setattr(trees, "node_table", lambda m: made.append(m) or table(m))
    found = catalog.ml_tree_additive(spark, "", CFG)
    assert found.where("additive").count() == found.count() == 900
    assert len(made) == 1


@pytest.mark.parametrize("name", ["forest", "boosted_a"])
def test_large_ensembles_are_written_in_pieces(spark, rows, monkeypatch, name):
    """Spark sends the trees of one written model to one task; a large forest filled the driver."""
    from loanlens.operators import trees

    df, features, _ = rows
    model = fit_candidate(df, features, name, CFG).classifier
    whole = node_table(model)
    monkeypatch.setattr(trees, "MAX_WRITE_NODES", 20)
    pieces = node_table(model)
    assert len(pieces.inputFiles()) > 2 > len(whole.inputFiles())
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, whole.collect()))


def test_large_ensembles_take_several_passes(rows, monkeypatch):
    df, features, _ = rows
    model = fit_candidate(df, features, "boosted_a", CFG)
    sample = df.orderBy("LOAN_ID").limit(20)
    whole = [r.attributions for r in model.add_attributions(sample).orderBy("LOAN_ID").collect()]
    monkeypatch.setattr("loanlens.operators.trees.MAX_PASS_BYTES", 4000)
    pieces = [r.attributions for r in model.add_attributions(sample).orderBy("LOAN_ID").collect()]
    assert np.allclose(whole, pieces)


def test_request_stream(spark, trained, tmp_path):
    """Two files in, one of them with broken lines; each request is answered once."""
    model = trained[0].model
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [{"loan_id": f"r{i}", "early_max_dpd": i, "nps_score": i % 11, "age_years": 30} for i in range(20)]
    (inbox / "a.json").write_text("\n".join(json.dumps(line) for line in lines[:10]))
    bad = ['{"loan_id": "bad", "early_max_dpd": "soon"}', "{broken"]
    (inbox / "b.json").write_text("\n".join([json.dumps(line) for line in lines[10:]] + bad))
    out = str(tmp_path / "out")
    stream = score_requests_stream(
        read_request_stream(spark, str(inbox), max_files=1), model, out, str(tmp_path / "state"), explain=True
    )
    stream.awaitTermination()
    answers = spark.read.parquet(out)
    assert answers.count() == 22 and answers.select("batch").distinct().count() == 2
    errors = answers.filter("risk_band = 'Error'")
    assert errors.count() == 2 and errors.filter("credit_score = 0 AND pd_score = 0").count() == 2
    batch = score_requests(read_requests(spark, str(inbox)), model, explain=True)
    assert batch.exceptAll(answers.drop("batch")).count() == 0
    # A restart finds nothing new to do.
    again = score_requests_stream(read_request_stream(spark, str(inbox)), model, out, str(tmp_path / "state"))
    again.awaitTermination()
    assert spark.read.parquet(out).count() == 22


def test_folds_are_weighted_by_their_own_classes(spark):
    """The penalty and weights of a balanced candidate follow the rows it is fitted on."""
    rows = spark.createDataFrame([(f, y) for f in range(3) for y in [0] * 4 + [1] * (f + 1)], "fold int, target int")
    assert fold_counts(rows) == {0: ClassCounts(8, 5), 1: ClassCounts(8, 4), 2: ClassCounts(8, 3)}
    known = candidates(Config())
    assert [c.balanced for c in known.values()] == [True, True, False, False]
    assert known["logistic"].build(ClassCounts(8, 2)).getRegParam() == pytest.approx(10.0)
