"""Column builders: every function returns a Spark Column or plain metadata."""

from loanlens.functions.bands import (
    age_band,
    income_band,
    pd_to_score,
    percent_text,
    reason_text,
    risk_band,
)
from loanlens.functions.naming import clean_headers, find_column, normalise_loan_id
from loanlens.functions.values import (
    half_even,
    number,
    number_or,
    parse_date,
    ratio,
    text_to_number,
    wall_clock,
    yes_no,
)

__all__ = [
    "age_band",
    "clean_headers",
    "find_column",
    "half_even",
    "income_band",
    "normalise_loan_id",
    "number",
    "number_or",
    "parse_date",
    "pd_to_score",
    "percent_text",
    "ratio",
    "reason_text",
    "risk_band",
    "text_to_number",
    "wall_clock",
    "yes_no",
]
