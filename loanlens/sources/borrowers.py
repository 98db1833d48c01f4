"""Borrower tables (one per former workbook sheet) and the survey answers."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.naming import find_column, normalise_loan_id
from loanlens.functions.values import col, number, parse_date, yes_no
from loanlens.sources.files import INGEST_ORDER, read_table

log = logging.getLogger(__name__)

SURVEY_FLAGS = ("phone_locked", "payment_delay", "happy_device", "happy_service")


def sheet_role(name: str) -> str | None:
    """Which borrower table a sheet or file name stands for."""
    key = name.lower().replace(" ", "_")
    if "dob" in key or "date_of_birth" in key:
        return "dob"
    return next(
        (role for word, role in (("income", "income"), ("gender", "gender"), ("sale", "sales"))
         if word in key),
        None,
    )


def _drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all", subset=[c for c in df.columns if c != INGEST_ORDER])


def _dates(df: DataFrame, source: str | None, name: str) -> DataFrame:
    if source is None:
        return df
    return df.withColumn(name, parse_date(col(source).cast("string")))


def _numbers(df: DataFrame, sources: Mapping[str, str | None]) -> DataFrame:
    parsed = {name: number(df, src) for name, src in sources.items() if src}
    return df.withColumns(parsed) if parsed else df


def shape_dob(df: DataFrame) -> DataFrame:
    source = find_column(df.columns, "birth") or find_column(df.columns, "dob")
    return _dates(df, source, "date_of_birth")


def shape_income(df: DataFrame) -> DataFrame:
    return _numbers(
        df,
        {
            "Received": find_column(df.columns, "receiv"),
            "Duration": find_column(df.columns, "duration"),
        },
    )


def shape_gender(df: DataFrame) -> DataFrame:
    source = find_column(df.columns, "gender")
    if source is None or source == "Gender":
        return df
    return df.withColumnRenamed(source, "Gender")


def shape_sales(df: DataFrame) -> DataFrame:
    df = _dates(df, find_column(df.columns, "date"), "Sale Date")
    prices = ("Cash Price", "Loan Price", "Loan Term")
    return _numbers(df, {name: find_column(df.columns, *name.split()) for name in prices})


def shape_nps(df: DataFrame) -> DataFrame:
    score = find_column(df.columns, "nps", "score") or find_column(df.columns, "score")
    flags = {name: find_column(df.columns, *name.split("_")) for name in SURVEY_FLAGS}
    group = find_column(df.columns, "promoter") or find_column(df.columns, "detractor")
    shaped = {name: yes_no(col(src).cast("string")) for name, src in flags.items() if src}
    if score:
        shaped["nps_score"] = number(df, score)
    if group:
        shaped["nps_category"] = F.trim(col(group).cast("string"))
    return df.withColumns(shaped) if shaped else df


_SHAPES = {
    "dob": shape_dob,
    "income": shape_income,
    "gender": shape_gender,
    "sales": shape_sales,
}


def load_demographics(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Borrower tables by role from ``{sheet name: path}``.

    A sheet without a loan id, or whose name fits no role, is left out.
    """
    tables: dict[str, DataFrame] = {}
    for sheet, path in paths.items():
        df = read_table(spark, path, ingest_order=True)
        if df is None:
            raise FileNotFoundError(f"borrower table {sheet!r} not found: {path}")
        try:
            df = _drop_blank_rows(normalise_loan_id(df))
        except KeyError:
            log.warning("sheet %r has no loan-id column, skipped", sheet)
            continue
        role = sheet_role(sheet)
        if role is not None:
            tables[role] = _SHAPES[role](df)
    return tables


def load_nps(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Survey answers, or None when there is no survey."""
    df = read_table(spark, path, ingest_order=True) if path else None
    if df is None:
        log.warning("survey table not found: %s", path)
        return None
    return shape_nps(_drop_blank_rows(normalise_loan_id(df)))
