"""Default labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, TARGET, Config
from loanlens.operators.snapshots import is_dated, label_aggregate, measured


def define_target(
    credit: DataFrame,
    definition: str | None = None,
    cfg: Config | None = None,
    *,
    label_snapshots: tuple[str, ...] | None = None,
) -> DataFrame:
    """``[LOAN_ID, target]`` by each loan's last known status and days past due.

    ``label_snapshots`` limits the dates a label may come from, which keeps loans
    seen only early from being labelled by their feature period.
    """
    cfg = cfg or Config()
    if label_snapshots is not None:
        credit = credit.filter(is_dated(credit, label_snapshots))
    rows = measured(credit, None)
    return rows.groupBy(LOAN_ID).agg(label_aggregate(definition or cfg.target_definition))


def merge_target(features: DataFrame, target: DataFrame) -> DataFrame:
    """Features of the loans that have a label."""
    return features.join(target, LOAN_ID, "inner")


def dropped_loans(features: DataFrame, target: DataFrame) -> DataFrame:
    """Loans that :func:`merge_target` leaves out."""
    return features.select(LOAN_ID).join(target, LOAN_ID, "left_anti")


def label_summary(labelled: DataFrame) -> DataFrame:
    """One row: loans, bad loans, good loans and the bad rate."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum(TARGET).cast("long").alias("n_bad"),
        F.sum(1 - F.col(TARGET)).cast("long").alias("n_good"),
        F.avg(TARGET).alias("bad_rate"),
    )
