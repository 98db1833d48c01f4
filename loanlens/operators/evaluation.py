"""Credit-risk metrics of a scored, labelled table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.config import TARGET
from loanlens.functions.values import half_even
from loanlens.operators.curves import (
    auc_aggregate,
    average_precision_aggregate,
    best_point_aggregate,
    curve,
    ks_aggregate,
)
from loanlens.session import cut_lineage

CALIBRATION_BINS = 10
HISTOGRAM_BINS = 40


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _or_zero(2 * precision * recall, precision + recall)


def _at_best_threshold(points: DataFrame) -> DataFrame:
    """One row: curve statistics and the confusion counts at the best threshold."""
    best = F.col("best")
    tp = F.coalesce(best["cum_bad"], F.lit(0))
    fp = F.coalesce(best["cum_good"], F.lit(0))
    return points.agg(
        auc_aggregate().alias("auc"),
        average_precision_aggregate().alias("ap"),
        ks_aggregate().alias("ks"),
        best_point_aggregate().alias("best"),
        F.coalesce(F.max("n_bad"), F.lit(0)).alias("n_bad"),
        F.coalesce(F.max("n_good"), F.lit(0)).alias("n_good"),
    ).select(
        "auc",
        "ap",
        "ks",
        best["p"].alias("threshold"),
        (F.col("n_good") - fp).alias("tn"),
        fp.alias("fp"),
        (F.col("n_bad") - tp).alias("fn"),
        tp.alias("tp"),
    )


def confusion(points: DataFrame) -> DataFrame:
    """``tn, fp, fn, tp`` at the best threshold, from the curve alone."""
    return _at_best_threshold(points).select("tn", "fp", "fn", "tp")


def confusion_at(
    scored: DataFrame, threshold: float, p: str = "p", label: str = TARGET
) -> DataFrame:
    """``tn, fp, fn, tp`` at a given threshold (predicted bad from it upwards)."""
    hit, bad = F.col(p) >= threshold, F.col(label) == 1
    return scored.agg(
        F.count_if(~hit & ~bad).alias("tn"),
        F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & bad).alias("fn"),
        F.count_if(hit & bad).alias("tp"),
    )


def metrics(points: DataFrame, model: str = "Best Model") -> DataFrame:
    """The metrics record as one row, figures to four decimals."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _or_zero(tp, tp + fp), _or_zero(tp, tp + fn)
    total = tp + fp + fn + tn
    return _at_best_threshold(points).select(
        F.lit(model).alias("model"),
        half_even(F.col("auc"), 4).alias("roc_auc"),
        half_even(F.col("ap"), 4).alias("pr_auc"),
        half_even(F.col("ks"), 4).alias("ks_stat"),
        half_even(precision, 4).alias("precision"),
        half_even(recall, 4).alias("recall"),
        half_even(_f1(precision, recall), 4).alias("f1"),
        half_even(F.col("threshold"), 4).alias("threshold"),
        total.alias("n_test"),
        half_even(F.try_divide((tp + fn).cast("double"), total.cast("double")), 4).alias(
            "bad_rate"
        ),
    )


def evaluate(
    scored: DataFrame,
    p: str = "p",
    label: str = TARGET,
    model: str = "Best Model",
    places: int | None = None,
) -> DataFrame:
    """Metrics of a scored table; see :func:`curve` for ``places``."""
    return metrics(curve(scored, p, label, places), model)


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class and on average, from a confusion row."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    good_p, good_r = _or_zero(tn, tn + fn), _or_zero(tn, tn + fp)
    bad_p, bad_r = _or_zero(tp, tp + fp), _or_zero(tp, tp + fn)
    good = (good_p, good_r, _f1(good_p, good_r), tn + fp)
    bad = (bad_p, bad_r, _f1(bad_p, bad_r), tp + fn)
    total = tp + fp + fn + tn
    none = F.lit(None).cast("double")
    accuracy = (none, none, _or_zero(tp + tn, total), total)
    macro = (*[(g + b) / 2 for g, b in zip(good[:3], bad[:3])], total)
    weighted = (
        *[_or_zero(g * good[3] + b * bad[3], total) for g, b in zip(good[:3], bad[:3])],
        total,
    )
    rows = {
        "Good": good,
        "Bad": bad,
        "accuracy": accuracy,
        "macro avg": macro,
        "weighted avg": weighted,
    }
    names = ("precision", "recall", "f1", "support")
    lines = [
        F.struct(F.lit(label).alias("label"), *[v.alias(n) for n, v in zip(names, values)])
        for label, values in rows.items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def calibration(
    scored: DataFrame, p: str = "p", label: str = TARGET, bins: int = CALIBRATION_BINS
) -> DataFrame:
    """Mean probability and share of bad loans per right-closed bin; empty bins are left out.

    Rows without a probability or a label are left out too.
    """
    scored = scored.where(F.col(p).isNotNull() & F.col(label).isNotNull())
    inner = [i / bins for i in range(1, bins)]
    number = F.lit(1)
    for edge in inner:
        number = number + (F.col(p) > edge).cast("int")
    return scored.groupBy(number.alias("bin")).agg(
        F.avg(p).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("bad_share"),
        F.count(F.lit(1)).alias("n"),
    )


def pd_histogram(
    scored: DataFrame, p: str = "p", label: str = TARGET, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Counts per class in equal bins over that class's own range, last bin closed.

    A class with a single value gets a range of one around it, as usual for
    histograms.
    """
    # Rows are counted per value first; what is read twice is small and written.
    known = scored.where(F.col(p).isNotNull() & F.col(label).isNotNull())
    rows = cut_lineage(
        known.groupBy(F.col(label).cast("int").alias("label"), F.col(p).alias("p")).agg(
            F.count(F.lit(1)).alias("n")
        )
    )
    ranges = rows.groupBy("label").agg(F.min("p").alias("low"), F.max("p").alias("high"))
    flat = F.col("low") == F.col("high")
    ranges = ranges.select(
        "label",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    # One row per class: the broadcast is bounded by the number of labels.
    placed = rows.join(F.broadcast(ranges), "label")
    position = F.floor((F.col("p") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    number = F.least(position + 1, F.lit(bins)).cast("int")
    width = (F.col("high") - F.col("low")) / bins
    return (
        placed.groupBy("label", number.alias("bin"), "low", "high")
        .agg(F.sum("n").alias("n"))
        .select(
            "label",
            "bin",
            (F.col("low") + (F.col("bin") - 1) * width).alias("bin_low"),
            (F.col("low") + F.col("bin") * width).alias("bin_high"),
            "n",
        )
    )
