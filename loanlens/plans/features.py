"""The feature matrix: one row per loan, with or without its label.

Shape of the plan: one shuffle of the snapshots on the loan id, one of each
borrower table, and joins of tables that are already partitioned by loan id. The
borrower tables meet one row per loan instead of every snapshot; their values do
not vary by snapshot, and the age is taken at the loan's last snapshot.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, Config
from loanlens.functions.values import col
from loanlens.operators.borrowers import (
    add_age_features,
    add_gender_features,
    add_income_features,
    add_loan_features,
    add_nps_features,
    add_sales_features,
)
from loanlens.operators.snapshots import (
    ORIGINATION,
    early_dates,
    loan_aggregate,
    snapshot_moment,
)


def _origination(loans: DataFrame, sales: DataFrame | None) -> DataFrame:
    if sales is None:
        return loans
    priced = add_sales_features(loans, sales)
    renamed = {src: name for src, name in ORIGINATION.items() if src in priced.columns}
    return priced.drop(*renamed.values(), "Sale Date").withColumnsRenamed(renamed)


def _assemble(
    credit: DataFrame,
    demographics: Mapping[str, DataFrame],
    nps: DataFrame | None,
    cfg: Config,
    definition: str | None,
) -> DataFrame:
    drop = [c for c in ORIGINATION if c in credit.columns] if "sales" in demographics else []
    kept = credit.select([col(c) for c in credit.columns if c not in drop])
    loans = loan_aggregate(kept, early_dates(kept, cfg), definition)
    loans = _origination(loans, demographics.get("sales"))
    loans = add_loan_features(loans)
    loans = add_age_features(loans, demographics.get("dob"), date="last_snapshot")
    loans = add_income_features(loans, demographics.get("income"))
    loans = add_gender_features(loans, demographics.get("gender"))
    return add_nps_features(loans.drop("last_snapshot"), nps)


def build_feature_matrix(
    credit: DataFrame,
    demographics: Mapping[str, DataFrame] | None = None,
    nps: DataFrame | None = None,
    cfg: Config | None = None,
) -> DataFrame:
    """One row of features for every loan with an early snapshot."""
    return _assemble(credit, demographics or {}, nps, cfg or Config(), None)


def build_labelled_matrix(
    credit: DataFrame,
    demographics: Mapping[str, DataFrame] | None = None,
    nps: DataFrame | None = None,
    cfg: Config | None = None,
) -> DataFrame:
    """Features and label out of the same pass over the snapshots.

    Gives what merging :func:`build_feature_matrix` with the label table gives,
    with one scan and one shuffle of the snapshots instead of two.
    """
    cfg = cfg or Config()
    return _assemble(credit, demographics or {}, nps, cfg, cfg.target_definition)


def last_demographics(
    credit: DataFrame, demographics: Mapping[str, DataFrame]
) -> DataFrame:
    """Last known demographic values of every loan, early snapshot or not."""
    loans = credit.groupBy(LOAN_ID).agg(F.max(snapshot_moment(credit)).alias("last_snapshot"))
    loans = add_age_features(loans, demographics.get("dob"), date="last_snapshot")
    loans = add_income_features(loans, demographics.get("income"))
    return add_gender_features(loans, demographics.get("gender")).drop("last_snapshot")
