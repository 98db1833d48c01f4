"""Credit snapshots: one file per date, stacked into a long table."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, SNAPSHOT_DATE, SNAPSHOT_FILES
from loanlens.functions.naming import clean_headers, loan_id_column, normalise_loan_id
from loanlens.functions.values import col, text_to_number
from loanlens.sources.files import read_table

log = logging.getLogger(__name__)


def union_snapshots(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_snapshots(
    spark: SparkSession,
    files: Iterable[tuple[str, str]] = SNAPSHOT_FILES,
    base_dir: str | None = None,
) -> DataFrame:
    """Stack the snapshot files, each stamped with its date.

    Values stay text: the operators parse what they read, because the label has
    to tell an unreadable value from a missing one. A file that is not there is
    skipped with a warning; if all are missing, it is an error. The loan id is
    settled per file, so files may spell its header differently; rows of a file
    without one are dropped like any row without an id.
    """
    frames, found = [], False
    for name, date in files:
        path = f"{base_dir.rstrip('/')}/{name}" if base_dir else name
        frame = read_table(spark, path)
        if frame is None:
            log.warning("snapshot file not found, skipped: %s", path)
            continue
        found = True
        if loan_id_column(clean_headers(frame).columns) is None:
            log.warning("snapshot file without a loan-id column, skipped: %s", path)
            continue
        stamp = F.lit(date).cast("timestamp_ntz")
        frames.append(normalise_loan_id(frame).withColumn(SNAPSHOT_DATE, stamp))
    if not found:
        raise FileNotFoundError(f"none of the snapshot files exists under {base_dir}")
    if not frames:
        raise KeyError("no snapshot file has a loan-id column")
    return union_snapshots(frames)


def infer_numeric(df: DataFrame, keep: Iterable[str] = (LOAN_ID, SNAPSHOT_DATE)) -> DataFrame:
    """Turn text columns into DOUBLE where every present value is a number.

    One aggregation over all columns finds the misfits; its single row is all
    that reaches the driver.
    """
    kept = set(keep)
    texts = [n for n, kind in df.dtypes if kind == "string" and n not in kept]
    if not texts:
        return df
    misfit = [
        F.max(col(n).isNotNull() & text_to_number(col(n)).isNull()).alias(f"m{i}")
        for i, n in enumerate(texts)
    ]
    found = df.agg(*misfit).first()
    clean = {n for i, n in enumerate(texts) if not found[f"m{i}"]}
    return df.select(
        [text_to_number(col(n)).alias(n) if n in clean else col(n) for n in df.columns]
    )
