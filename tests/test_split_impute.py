import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.operators.impute import exact_medians, fill, median_values, ordered_images, value_of
from loanlens.operators.split import (
    assign_folds,
    class_weights,
    mark_test,
    seeded_sample,
    stratified_split,
)


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(20000).select(
        F.col("id").cast("string").alias("LOAN_ID"), (F.col("id") % 10 < 3).cast("int").alias("target")
    )


def test_split_is_stratified_disjoint_and_whole(labelled):
    train, test = stratified_split(labelled, 0.2)
    assert train.count() + test.count() == 20000
    assert train.join(test, "LOAN_ID").count() == 0
    counts = {r["target"]: r["count"] for r in test.groupBy("target").count().collect()}
    assert counts[0] == pytest.approx(2800, abs=2) and counts[1] == pytest.approx(1200, abs=2)


def test_split_does_not_depend_on_partitioning(labelled):
    one = mark_test(labelled.coalesce(1))
    many = mark_test(labelled.repartition(13))
    assert one.exceptAll(many).count() == 0
    other = mark_test(labelled, seed=7)
    assert one.exceptAll(other).count() > 1000


def test_folds(labelled):
    folds = assign_folds(labelled, 5)
    for r in folds.groupBy("fold", "target").count().collect():
        assert r["count"] == pytest.approx(2800 if r["target"] == 0 else 1200, abs=3)
    # Folds are independent of the split.
    inside = mark_test(labelled).join(folds, ["LOAN_ID", "target"]).filter("is_test = 1")
    shares = [r["count"] / 4000 for r in inside.groupBy("fold").count().collect()]
    assert len(shares) == 5 and all(abs(s - 0.2) < 0.03 for s in shares)


def test_sample(labelled):
    assert seeded_sample(labelled, 100).exceptAll(seeded_sample(labelled.repartition(5), 100)).count() == 0


def test_weights(spark, labelled):
    row = class_weights(labelled).first()
    assert (row.n_good, row.n_bad) == (14000, 6000)
    assert row.weight_good * 14000 == pytest.approx(row.weight_bad * 6000)
    assert row.pos_weight == pytest.approx(14 / 6)
    good_only = class_weights(spark.createDataFrame([(0,), (0,)], "target int")).first()
    assert (good_only.pos_weight, good_only.weight_bad) == (2.0, None)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 11, 1000, 4001])
def test_medians_against_brute_force(spark, n):
    rng = random.Random(n)
    columns = {
        "even": [rng.random() for _ in range(n)],
        "skewed": [rng.paretovariate(0.3) for _ in range(n)],
        "few": [float(rng.randrange(3)) for _ in range(n)],
        "gaps": [rng.gauss(0, 1) if rng.random() < 0.5 else None for _ in range(n)],
        "hot": [7.0 if rng.random() < 0.4 else rng.uniform(0, 20) for _ in range(n)],
        "none": [None] * n,
    }
    schema = ", ".join(f"{c} double" for c in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(3)
    got = {r.feature: r.median for r in exact_medians(df, list(columns)).collect()}
    for name, values in columns.items():
        present = [v for v in values if v is not None]
        assert got[name] == (statistics.median(present) if present else None), name


def test_ordered_images():
    values = np.array([-np.inf, -1e300, -1.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, np.inf, np.nan])
    images = ordered_images(values)
    assert (np.diff(images.astype(object)) > 0).all()
    assert [value_of(v) for v in images[:-1]] == list(values[:-1]) and math.isnan(value_of(images[-1]))
    assert len(set(ordered_images(np.array([0.0, -0.0])).tolist())) == 1


def test_medians_of_many_rows_and_columns(spark):
    """65 columns; two thirds of one may be equal, one has infinities and NaN, one is negative."""
    value = F.hash("id").cast("double")
    df = spark.range(50001).select(
        value.alias("x"),
        F.when(F.col("id") % 3 == 0, value).otherwise(0.0).alias("hot"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(-0.0).alias("two"),
        F.when(F.col("id") % 5 != 0, F.exp(value / 1e8)).alias("gaps"),
        (-F.abs(value) - 1).alias("negative"),
        F.when(F.col("id") % 5 < 3, F.lit(float("nan"))).otherwise(value).alias("nan"),
        F.when(F.col("id") % 5 < 2, F.lit(float("inf"))).otherwise(value).alias("inf"),
        *[(value + i).alias(f"c{i}") for i in range(58)],
    )
    rows = df.toPandas()
    got = median_values(df, df.columns)
    for name in got:
        assert got[name] == statistics.median(rows[name].dropna()), name
    assert median_values(df.limit(0), ["x"]) == {"x": 0.0}
    assert median_values(df, []) == {}


def test_fill(spark):
    df = spark.createDataFrame([(None, "a"), (2.0, "b")], "x double, k string")
    out = {r.k: (r.x, r.y) for r in fill(df, {"x": 1.0, "y": 3.0}).collect()}
    assert out == {"a": (1.0, 3.0), "b": (2.0, 3.0)}
    assert median_values(df.select(F.lit(None).cast("double").alias("e")), ["e"]) == {"e": 0.0}
