"""Indicator columns and the choice of model features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LEAKING_COLUMNS, NUMERIC_FEATURES
from loanlens.functions.bands import age_indicators, income_indicators


def encode_categoricals(df: DataFrame) -> DataFrame:
    """Replace the two band columns by indicators of every configured label.

    The set of columns is fixed, so a scored table always fits the trained model.
    """
    extra = []
    if "age_band" in df.columns:
        extra += age_indicators(F.col("age_band"))
    if "income_band" in df.columns:
        extra += income_indicators(F.col("income_band"))
    return df.select("*", *extra).drop("age_band", "income_band")


def get_model_features(columns: Iterable[str]) -> list[str]:
    """Model features among ``columns``: numeric ones first, then the indicators."""
    columns = list(columns)
    numeric = [name for name in NUMERIC_FEATURES if name in columns]
    bands = [c for c in columns if c.startswith(("age_band_", "income_band_"))]
    return [name for name in numeric + bands if name not in LEAKING_COLUMNS]
