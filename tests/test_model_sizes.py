"""Sizes of the models that the registered queries fit."""

import pytest
from pyspark.sql import functions as F

from loanlens.config import MODEL_FEATURES, TrainingProfile
from loanlens.operators.candidates import candidates
from loanlens.plans import catalog
from loanlens.session import cut_lineage, spread
from loanlens.sources.tables import VIEW_CONFIG

TINY = VIEW_CONFIG.with_(
    cv_folds=2, profile=TrainingProfile(forest_trees=4, boosting_rounds=2, max_bins=16)
)


class Stop(Exception):
    pass


@pytest.mark.parametrize("name, step", [("train_score", "train"), ("ml_tree_attrib", "fit_candidate")])
def test_queries_fit_the_default_profile(spark, sf, monkeypatch, name, step):
    """Stops before the fit: whole models take too long for a test."""
    used = []

    def stop(*args):
        used.extend(a for a in args if hasattr(a, "profile"))
        raise Stop

    monkeypatch.setattr(catalog, step, stop)
    with pytest.raises(Stop):
        getattr(catalog, name)(spark, sf)
    (cfg,) = used
    assert cfg.profile == TrainingProfile()
    assert cfg.candidates == ("logistic", "forest", "boosted_a", "boosted_b") and cfg.cv_folds == 5
    built = {k: c.build(None) for k, c in candidates(cfg).items() if k != "logistic"}
    assert built["forest"].getNumTrees() == 500 and built["forest"].getMaxBins() == 256
    assert built["boosted_a"].getMaxIter() == built["boosted_b"].getMaxIter() == 1000


def test_queries_take_a_small_profile(spark, sf):
    scored = catalog.train_score(spark, sf, TINY)
    assert scored.filter("pd BETWEEN 0 AND 1 AND score BETWEEN 300 AND 850").count() == scored.count() > 0
    assert catalog.QUERIES["ml_tree_attrib"](spark, sf, TINY).count() == len(MODEL_FEATURES)


def test_forests_use_all_cores(spark, monkeypatch):
    """Thousands of loans are a file of a few bytes each; one task read all of them."""
    names = ["LOAN_ID", "early_max_dpd", "loan_amount", "target"]
    few = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")),
        (F.col("id") % 61).cast("double"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 997).cast("double")),
        (F.col("id") % 61 > 40).cast("int"),
    ).toDF(*names)
    monkeypatch.setattr(catalog, "_labelled", lambda *_: few.coalesce(1))
    model, rows = catalog._forest(spark, "", TINY)
    assert rows.rdd.getNumPartitions() >= 2
    sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
    # Missing and repeated keys, here a third of all, don't meet in one task.
    assert sum(sizes) == 6000 and max(sizes) < 4500
    assert model.add_probability(rows).where("p BETWEEN 0 AND 1").count() == 6000


def test_spread_keeps_every_row(spark):
    one = cut_lineage(spark.range(9000).select((F.col("id") % 4000).alias("a.b `c`")).coalesce(1))
    dealt = spread(one)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.columns == one.columns
    assert dealt.exceptAll(one).count() == one.exceptAll(dealt).count() == 0
    assert spread(one.limit(10)).rdd.getNumPartitions() == 1
