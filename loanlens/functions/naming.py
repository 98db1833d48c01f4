"""Header rules: these look at column names only and start no job."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID
from loanlens.functions.values import col

_UNNAMED = re.compile(r"_c\d+")


def _squash(name: str) -> str:
    return re.sub(r"[ _]", "", name.lower())


def find_column(names: Iterable[str], *keywords: str) -> str | None:
    """First name that holds every keyword, ignoring case, blanks and underscores."""
    wanted = [_squash(word) for word in keywords]
    return next((n for n in names if all(w in _squash(n) for w in wanted)), None)


def clean_headers(df: DataFrame) -> DataFrame:
    """Trim column names, drop unnamed columns, number repeated names."""
    positional = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    kept, used = [], set()
    for i, raw in enumerate(df.columns):
        name = raw.strip()
        if not name or _UNNAMED.fullmatch(name):
            continue
        unique, n = name, 1
        while unique in used:
            unique, n = f"{name}_{n}", n + 1
        used.add(unique)
        kept.append(F.col(f"_p{i}").alias(unique))
    return positional.select(kept)


def loan_id_column(names: Iterable[str]) -> str | None:
    """The loan-id header: the canonical name, else the first with loan and id in it."""
    names = list(names)
    if LOAN_ID in names:
        return LOAN_ID
    return next((n for n in names if "loan" in n.lower() and "id" in n.lower()), None)


def normalise_loan_id(df: DataFrame) -> DataFrame:
    """Clean headers, settle the loan-id column as trimmed text, drop rows without one."""
    df = clean_headers(df)
    found = loan_id_column(df.columns)
    if found is None:
        raise KeyError(f"no loan-id column among {df.columns[:10]}")
    if found != LOAN_ID:
        df = df.withColumnRenamed(found, LOAN_ID)
    df = df.withColumn(LOAN_ID, F.trim(col(LOAN_ID).cast("string")))
    return df.filter(col(LOAN_ID).isNotNull() & (col(LOAN_ID) != "nan"))
