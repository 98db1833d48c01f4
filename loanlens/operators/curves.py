"""Cumulative curves of a scored, labelled table, and what follows from them.

Rows are first counted per distinct probability, so ties are one point and the
raw rows never enter a window. What is accumulated is split into ranges (see
:func:`curve`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.config import TARGET
from loanlens.session import cut_lineage


def count_by_probability(
    scored: DataFrame, p: str = "p", label: str = TARGET, places: int | None = None
) -> DataFrame:
    """``(p, n, bad, good)`` per distinct probability; rows without p or label are left out."""
    value = F.col(p) if places is None else F.bround(F.col(p), places)
    bad = F.sum(F.col(label).cast("long"))
    return (
        scored.where(F.col(p).isNotNull() & F.col(label).isNotNull())
        .groupBy(value.alias("p"))
        .agg(F.count(F.lit(1)).alias("n"), bad.alias("bad"))
        .withColumn("good", F.col("n") - F.col("bad"))
    )


def curve(
    scored: DataFrame,
    p: str = "p",
    label: str = TARGET,
    places: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per distinct probability with counts, running totals and totals.

    Rows without a probability or a label are no points and count in no total. With
    ``places`` the probabilities are rounded first.

    The points are cut into ranges of probabilities, as many as their size asks for (or
    ``ranges``), and written once. Totals per range, few rows, give the start of every
    range, and each range is accumulated on its own.
    """
    points = count_by_probability(scored, p, label, places)
    ranged = points.repartitionByRange("p") if ranges is None else points.repartitionByRange(ranges, "p")
    # Range partitions are numbered in the order of their probabilities.
    ranged = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    above = W.orderBy(F.col("part").desc()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    none = F.lit(0).cast("long")
    starts = (
        ranged.groupBy("part")
        .agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
        .select(
            "part",
            F.coalesce(F.sum("b").over(above), none).alias("bad_above"),
            F.coalesce(F.sum("g").over(above), none).alias("good_above"),
            F.sum("b").over(everything).alias("n_bad"),
            F.sum("g").over(everything).alias("n_good"),
        )
    )
    down = (
        W.partitionBy("part")
        .orderBy(F.col("p").desc())
        .rowsBetween(W.unboundedPreceding, 0)
    )
    # One row per range.
    return (
        ranged.join(F.broadcast(starts), "part")
        .withColumns(
            {
                "cum_bad": F.sum("bad").over(down) + F.col("bad_above"),
                "cum_good": F.sum("good").over(down) + F.col("good_above"),
            }
        )
        .drop("part", "bad_above", "good_above")
    )


# --- Expressions over one point of a curve -----------------------------------


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def _tpr() -> Column:
    return _share("cum_bad", "n_bad")


def _fpr() -> Column:
    return _share("cum_good", "n_good")


def _precision() -> Column:
    found = F.col("cum_bad").cast("double")
    return found / (F.col("cum_bad") + F.col("cum_good"))


def ks_aggregate() -> Column:
    """Largest distance of the two cumulative shares; 0 if a class is empty."""
    return F.coalesce(F.max(F.abs(_tpr() - _fpr())), F.lit(0.0))


def auc_aggregate() -> Column:
    """Area under the ROC curve, ties counted half; NULL if a class is empty."""
    area = F.sum(F.col("good") * (F.col("cum_bad") - F.col("bad") / 2))
    both = F.max("n_bad").cast("double") * F.max("n_good").cast("double")
    return F.try_divide(area.cast("double"), both)


def average_precision_aggregate() -> Column:
    """Sum of precision times the step in recall; 0 without a bad loan."""
    return F.coalesce(F.sum(_share("bad", "n_bad") * _precision()), F.lit(0.0))


def best_point_aggregate() -> Column:
    """The point with the largest tpr - fpr (the highest one on ties).

    A struct of p and the running totals; NULL when no point gains anything.
    """
    gain = F.round(_tpr() - _fpr(), 12)
    point = F.struct("p", "cum_bad", "cum_good")
    key = F.when(gain > 0, F.struct(gain.alias("gain"), F.col("p").alias("at")))
    return F.max_by(F.when(gain > 0, point), key)


# --- Curves as tables --------------------------------------------------------


def roc_curve(points: DataFrame) -> DataFrame:
    """``(threshold, fpr, tpr)``; the starting point has no threshold."""
    start = points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    body = points.select(F.col("p").alias("threshold"), _fpr().alias("fpr"), _tpr().alias("tpr"))
    return start.unionByName(body)


def pr_curve(points: DataFrame) -> DataFrame:
    """``(threshold, recall, precision)``; the end point has no threshold."""
    end = points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"),
    )
    body = points.select(
        F.col("p").alias("threshold"), _tpr().alias("recall"), _precision().alias("precision")
    )
    return end.unionByName(body)


def ks_curve(points: DataFrame) -> DataFrame:
    """Population share and cumulative shares of both classes, per probability."""
    reached = F.col("cum_bad") + F.col("cum_good")
    total = F.col("n_bad") + F.col("n_good")
    return points.select(
        "p",
        F.try_divide((reached - 1).cast("double"), (total - 1).cast("double")).alias("population"),
        _tpr().alias("cum_bad_share"),
        _fpr().alias("cum_good_share"),
    )


def _one(points: DataFrame, value: Column, name: str) -> DataFrame:
    return points.agg(value.alias(name))


def ks_statistic(points: DataFrame) -> DataFrame:
    return _one(points, ks_aggregate(), "ks_stat")


def roc_auc(points: DataFrame) -> DataFrame:
    return _one(points, auc_aggregate(), "roc_auc")


def average_precision(points: DataFrame) -> DataFrame:
    return _one(points, average_precision_aggregate(), "pr_auc")


def optimal_threshold(points: DataFrame) -> DataFrame:
    return _one(points, best_point_aggregate().getField("p"), "threshold")
