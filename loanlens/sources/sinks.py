"""Writers. Each replaces its target, so a retried job leaves one whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import SNAPSHOT_DATE


def write_scores(scores: DataFrame, path: str, fmt: str = "csv") -> None:
    """Portfolio scores as a folder of CSV (with header) or Parquet files."""
    writer = scores.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_snapshots(credit: DataFrame, path: str) -> None:
    """Snapshots as Parquet by date, so that date filters skip whole folders.

    A source file holds one date, so every task writes few files and no shuffle
    is needed.
    """
    day = F.col(SNAPSHOT_DATE).cast("date")
    credit.withColumn(SNAPSHOT_DATE, day).write.mode("overwrite").partitionBy(
        SNAPSHOT_DATE
    ).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A one-row metrics table as (metric, value) lines in JSON."""
    names = metrics.columns
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("string").alias("value"))
            for n in names
        ]
    )
    metrics.select(F.inline(pairs)).coalesce(1).write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """The class report (five rows) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
