"""Borrower features: age, income, gender, sale and survey.

Each of the ``add_`` operators left-joins the first row per loan of its table.
They work on any frame with a loan id: on snapshots, or - as the feature matrix
does - on one row per loan, where the joins move far fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, SNAPSHOT_DATE, UNKNOWN_BAND
from loanlens.functions.bands import age_band, income_band
from loanlens.functions.values import col, half_even, male_flag, number, ratio, wall_clock
from loanlens.operators.first_last import first_per_loan


def _missing() -> Column:
    return F.lit(None).cast("double")


def age_years(born: Column, moment: Column) -> Column:
    return half_even(F.datediff(moment, born) / F.lit(365.25).cast("double"), 1)


def add_age_features(
    df: DataFrame, dob: DataFrame | None, date: str = SNAPSHOT_DATE
) -> DataFrame:
    """``age_years`` at ``date`` and its band."""
    if dob is None or "date_of_birth" not in dob.columns:
        return df.withColumns({"age_years": _missing(), "age_band": F.lit(UNKNOWN_BAND)})
    born = first_per_loan(dob, ["date_of_birth"])
    age = age_years(wall_clock(col("date_of_birth")), wall_clock(col(date)))
    return (
        df.join(born, LOAN_ID, "left")
        .withColumn("age_years", age)
        .withColumn("age_band", age_band(F.col("age_years")))
        .drop("date_of_birth")
    )


def add_income_features(df: DataFrame, income: DataFrame | None) -> DataFrame:
    """``avg_monthly_income`` (received over duration) and its band."""
    if income is None:
        return df.withColumns(
            {"avg_monthly_income": _missing(), "income_band": F.lit(UNKNOWN_BAND)}
        )
    first = first_per_loan(income, ["Received", "Duration"])
    monthly = half_even(ratio(number(first, "Received"), number(first, "Duration")))
    first = first.select(LOAN_ID, monthly.alias("avg_monthly_income"))
    return df.join(first, LOAN_ID, "left").withColumn(
        "income_band", income_band(F.col("avg_monthly_income"))
    )


def add_gender_features(df: DataFrame, gender: DataFrame | None) -> DataFrame:
    """``is_male``: 1, 0, or NULL for anything else."""
    if gender is None:
        return df.withColumn("is_male", _missing())
    # The flag before the first row: a number stays on the hash path.
    flagged = gender.withColumn("is_male", male_flag(col("Gender")))
    return df.join(first_per_loan(flagged, ["is_male"]), LOAN_ID, "left")


SALES_COLUMNS = ("Sale Date", "Cash Price", "Loan Price", "Loan Term")


def add_sales_features(df: DataFrame, sales: DataFrame | None) -> DataFrame:
    """Sale date, prices and term of the loan; they replace columns of the same name."""
    if sales is None:
        return df
    present = [name for name in SALES_COLUMNS if name in sales.columns]
    return df.drop(*present).join(first_per_loan(sales, present), LOAN_ID, "left")


NPS_COLUMNS = (
    "nps_score",
    "phone_locked",
    "payment_delay",
    "happy_device",
    "happy_service",
    "nps_category",
)


def add_nps_features(features: DataFrame, nps: DataFrame | None) -> DataFrame:
    """Survey answers; a loan without a score counts as neither promoter nor detractor."""
    if nps is None:
        absent = ("nps_score", "is_promoter", "is_detractor", "phone_locked", "payment_delay")
        return features.withColumns({name: _missing() for name in absent})
    present = [name for name in NPS_COLUMNS if name in nps.columns]
    joined = features.join(first_per_loan(nps, present), LOAN_ID, "left")
    if "nps_score" not in present:
        return joined.withColumns({"is_promoter": _missing(), "is_detractor": _missing()})
    score = F.col("nps_score")
    return joined.withColumns(
        {
            "is_promoter": F.when(score >= 9, 1.0).otherwise(0.0),
            "is_detractor": F.when(score <= 6, 1.0).otherwise(0.0),
        }
    )


AMOUNT_COLUMNS = ("loan_price", "LOAN_AMOUNT", "LOAN_PRICE")


def add_loan_features(features: DataFrame) -> DataFrame:
    """Loan amount, markup over the cash price and term, from origination prices."""
    source = next((name for name in AMOUNT_COLUMNS if name in features.columns), None)
    amount = number(features, source) if source else _missing()
    markup = term = _missing()
    if source and "cash_price" in features.columns:
        cash = number(features, "cash_price")
        markup = half_even(ratio(amount - cash, cash), 3)
    if "loan_term" in features.columns:
        term = number(features, "loan_term")
    return features.withColumns(
        {"loan_amount": amount, "markup_ratio": markup, "loan_term_months": term}
    )
