"""Per-loan aggregation of the credit snapshots.

Everything a loan needs from its snapshots - early behaviour, trend, origination
prices, last date and label - comes out of one ``groupBy(LOAN_ID)``. The trend is
an ordinary sum as well (see :func:`trend_aggregate`), so no window, no sort and
no second shuffle is involved, and a loan with very many rows is combined on the
map side like any other.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.config import (
    ARREARS_STATUS,
    BAD_STATUSES,
    DPD,
    HARD_DEFINITIONS,
    LOAN_ID,
    SNAPSHOT_DATE,
    SOFT_THRESHOLDS,
    STATUS_L2,
    TARGET,
    TARGET_DEFINITIONS,
    TOTAL_DUE,
    TOTAL_PAID,
    Config,
)
from loanlens.functions.values import (
    clamp,
    col,
    half_even,
    number_or,
    ratio,
    time_key,
    wall_clock,
)
from loanlens.operators.first_last import first_known_per_loan

log = logging.getLogger(__name__)

# Snapshot columns with prices at origination, and their names as features.
ORIGINATION = {
    "Loan Price": "loan_price",
    "Cash Price": "cash_price",
    "Loan Term": "loan_term",
}

EARLY_FEATURES = (
    "early_max_dpd",
    "early_avg_dpd",
    "early_dpd_std",
    "early_had_arrears",
    "early_avg_collection_rate",
    "early_min_collection_rate",
    "early_std_collection_rate",
    "n_snapshots_early",
    "early_dpd_trend",
)


# --- Row-level expressions ---------------------------------------------------


def collection_rate(df: DataFrame) -> Column:
    """Share of the amount due that was paid, within 0..1; NULL when nothing is due."""
    return clamp(ratio(number_or(df, TOTAL_PAID), number_or(df, TOTAL_DUE)), 0, 1)


def arrears_flag(df: DataFrame) -> Column:
    """1 for an arrears status in any case, without trimming; otherwise 0."""
    if ARREARS_STATUS not in df.columns:
        return F.lit(0)
    hit = F.lower(col(ARREARS_STATUS).cast("string")) == "arrears"
    return F.coalesce(hit, F.lit(False)).cast("int")


def snapshot_moment(df: DataFrame) -> Column:
    return wall_clock(col(SNAPSHOT_DATE))


def is_dated(df: DataFrame, dates: Sequence[str]) -> Column:
    """Whether a snapshot has one of the dates.

    A DATE column is compared as it is, so that the filter reaches the scan.
    """
    if isinstance(df.schema[SNAPSHOT_DATE].dataType, T.DateType):
        return col(SNAPSHOT_DATE).isin(*[F.lit(d).cast("date") for d in dates])
    return snapshot_moment(df).isin(*[F.lit(d).cast("timestamp_ntz") for d in dates])


def measured(credit: DataFrame, early_dates: Sequence[str] | None) -> DataFrame:
    """Snapshot rows reduced to typed measures.

    ``early_dates=None`` marks every row as early.
    """
    moment = snapshot_moment(credit)
    early = F.lit(True)
    if early_dates is not None:
        early = F.coalesce(is_dated(credit, early_dates), F.lit(False))
    has_dpd, has_status = DPD in credit.columns, STATUS_L2 in credit.columns
    status = col(STATUS_L2).cast("string") if has_status else F.lit(None).cast("string")
    origination = [
        col(source).alias(name) for source, name in ORIGINATION.items() if source in credit.columns
    ]
    return credit.select(
        col(LOAN_ID),
        moment.alias("moment"),
        early.alias("early"),
        number_or(credit, DPD).alias("dpd"),
        (col(DPD).isNotNull() if has_dpd else F.lit(False)).alias("dpd_given"),
        collection_rate(credit).alias("rate"),
        arrears_flag(credit).alias("arrears"),
        F.upper(status).isin(*BAD_STATUSES).alias("hard"),
        *origination,
    )


# --- Aggregates over measured rows -------------------------------------------


def trend_aggregate(early: Column, moment: Column, dpd: Column, dates: Sequence[str]) -> Column:
    """Least-squares slope of days past due on the position 0..n-1 in date order.

    With n_d rows summing to s_d on date d, the rows of that date hold the next
    n_d positions, whose mean is known from the counts alone. So per-date counts
    and sums give the slope exactly, and both are plain conditional sums. Rows of
    one loan that share a date share their mean position, which makes the result
    independent of the row order.
    """
    y = F.coalesce(dpd, F.lit(0.0))
    before = F.lit(0.0)
    moments, sums = [], []
    for date in sorted(dates):
        here = early & (moment == F.lit(date).cast("timestamp_ntz"))
        n = F.count_if(here).cast("double")
        s = F.coalesce(F.sum(F.when(here, y)), F.lit(0.0))
        moments.append((before + (n - 1) / 2) * s)
        sums.append(s)
        before = before + n
    return slope(before, reduce(add, moments), reduce(add, sums))


def slope(n: Column, sum_xy: Column, sum_y: Column) -> Column:
    """Slope over positions 0..n-1 from its sums; 0 for fewer than two rows."""
    spread = n * (n * n - 1)
    value = F.try_divide(12 * (sum_xy - (n - 1) / 2 * sum_y), spread)
    return half_even(F.when(n < 2, F.lit(0.0)).otherwise(value), 3)


def early_aggregates() -> list[Column]:
    """Early-behaviour features other than the trend."""
    early = F.col("early")
    dpd = F.when(early, F.col("dpd"))
    rate = F.when(early, F.col("rate"))
    zero = F.lit(0.0)
    return [
        F.coalesce(F.max(dpd), zero).alias("early_max_dpd"),
        half_even(F.coalesce(F.avg(dpd), zero), 1).alias("early_avg_dpd"),
        half_even(F.coalesce(F.stddev_samp(dpd), zero), 2).alias("early_dpd_std"),
        F.coalesce(F.max(F.when(early, F.col("arrears"))), F.lit(0)).alias("early_had_arrears"),
        half_even(F.avg(rate), 3).alias("early_avg_collection_rate"),
        half_even(F.min(rate), 3).alias("early_min_collection_rate"),
        half_even(F.coalesce(F.stddev_samp(rate), zero), 3).alias("early_std_collection_rate"),
        F.count(F.when(early, F.col("moment"))).alias("n_snapshots_early"),
    ]


def label_aggregate(definition: str) -> Column:
    """0/1 label from the last status and the last days-past-due a loan shows.

    The two may come from different dates. Each is found with one LONG maximum of
    (time, flag) packed together; of rows on the same date the worse one counts.
    An unreadable last days-past-due counts as 0.
    """
    if definition not in TARGET_DEFINITIONS:
        raise ValueError(f"unknown target definition {definition!r}")
    key = F.coalesce(time_key(F.col("moment")), F.lit(_LAST_MOMENT))
    bad = []
    if definition in HARD_DEFINITIONS:
        bad.append(_last_flag(key, F.col("hard"), F.col("hard").isNotNull()))
    if definition in SOFT_THRESHOLDS:
        late = F.coalesce(F.col("dpd"), F.lit(0.0)) > SOFT_THRESHOLDS[definition]
        bad.append(_last_flag(key, late, F.col("dpd_given")))
    return F.when(reduce(lambda a, b: a | b, bad), 1).otherwise(0).alias(TARGET)


# A missing date sorts after every real one.
_LAST_MOMENT = 4_000_000_000_000_000_000


def _last_flag(key: Column, flag: Column, present: Column) -> Column:
    packed = F.max(F.when(present, key * 2 + flag.cast("long")))
    return F.coalesce(F.pmod(packed, F.lit(2)) == 1, F.lit(False))


# --- Operators ---------------------------------------------------------------


@dataclass(frozen=True)
class EarlyDates:
    """Dates that count as early; None means that every snapshot does."""

    dates: tuple[str, ...] | None


def early_dates(credit: DataFrame, cfg: Config) -> EarlyDates:
    """The configured early dates, or every date if the data has none of them."""
    if not cfg.early_fallback:
        return EarlyDates(cfg.early_snapshots)
    found = credit.filter(is_dated(credit, cfg.early_snapshots))
    if found.select(SNAPSHOT_DATE).isEmpty():
        log.error("no early snapshot in the data; every snapshot is used")
        return EarlyDates(None)
    return EarlyDates(cfg.early_snapshots)


def trend_by_date(rows: DataFrame) -> DataFrame:
    """Trend per loan for any number of dates, from per-date counts and sums.

    Rows are first summed per loan and date, with map-side combining, so the window
    over a loan holds one row per snapshot date, however many rows the loan has.
    """
    per_date = (
        rows.filter("early")
        .groupBy(LOAN_ID, "moment")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(F.coalesce("dpd", F.lit(0.0))).alias("s"),
        )
    )
    earlier = W.partitionBy(LOAN_ID).orderBy(F.col("moment").asc_nulls_last())
    before = F.sum("n").over(earlier) - F.col("n")
    return (
        per_date.withColumn("sxy", (before + (F.col("n") - 1) / 2) * F.col("s"))
        .groupBy(LOAN_ID)
        .agg(slope(F.sum("n"), F.sum("sxy"), F.sum("s")).alias("early_dpd_trend"))
    )


def loan_aggregate(
    credit: DataFrame, early: EarlyDates, definition: str | None = None
) -> DataFrame:
    """One row per loan: early features, origination, last date and, if asked, label.

    Loans without an early row are left out; rows without a loan id are one loan. The
    trend is part of the aggregate where the dates are configured, and else comes from
    sums per date, whose number only the data knows. Prices at origination, if the snapshots
    have any, come from an aggregate of their own, reduced per date first.
    """
    rows = measured(credit, early.dates)
    aggregates = early_aggregates()
    if early.dates:
        trend = trend_aggregate(F.col("early"), F.col("moment"), F.col("dpd"), early.dates)
        aggregates.append(trend.alias("early_dpd_trend"))
    aggregates += [
        F.max("moment").alias("last_snapshot"),
        F.max("early").alias("seen_early"),
    ]
    if definition is not None:
        aggregates.append(label_aggregate(definition))
    loans = rows.groupBy(LOAN_ID).agg(*aggregates).filter("seen_early").drop("seen_early")
    if early.dates is None:
        trend = trend_by_date(rows).withColumnRenamed(LOAN_ID, "_trend_loan")
        same = col(LOAN_ID).eqNullSafe(F.col("_trend_loan"))
        loans = loans.join(trend, same, "left").drop("_trend_loan")
    elif not early.dates:
        loans = loans.withColumn("early_dpd_trend", F.lit(0.0))
    prices = [name for name in ORIGINATION.values() if name in rows.columns]
    if prices:
        known = first_known_per_loan(rows, prices, "moment").withColumnRenamed(LOAN_ID, "_priced_loan")
        loans = loans.join(known, col(LOAN_ID).eqNullSafe(F.col("_priced_loan")), "left").drop("_priced_loan")
    return loans


def compute_snapshot_features(credit: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Early features and origination prices, one row per loan."""
    cfg = cfg or Config()
    return loan_aggregate(credit, early_dates(credit, cfg)).drop("last_snapshot")


def early_features(credit: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Early features only; the date filter then reaches the scan."""
    cfg = cfg or Config()
    early = early_dates(credit, cfg)
    if early.dates is not None:
        credit = credit.filter(is_dated(credit, early.dates))
    kept = [c for c in credit.columns if c not in ORIGINATION]
    return loan_aggregate(credit.select([col(c) for c in kept]), early).select(
        LOAN_ID, *EARLY_FEATURES
    )
