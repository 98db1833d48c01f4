"""A linear scorecard with given weights: the model that needs no training."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.values import half_even, number_or
from loanlens.operators.attribution import ATTRIBUTIONS, linear_attributions
from loanlens.operators.impute import fill


@dataclass(frozen=True)
class Scorecard:
    """Log-odds of default as intercept plus weighted features.

    ``medians`` replace missing features when a table is scored, ``background``
    holds the feature means that attributions are measured from; both default to 0.
    """

    intercept: float
    weights: Mapping[str, float]
    medians: Mapping[str, float] = field(default_factory=dict)
    background: Mapping[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def log_odds(self, df: DataFrame) -> Column:
        terms = [
            F.lit(float(w)) * F.coalesce(number_or(df, name), F.lit(0.0))
            for name, w in self.weights.items()
        ]
        return reduce(add, terms, F.lit(float(self.intercept)))

    def fixed_log_odds(self, df: DataFrame) -> Column:
        """Log-odds in millionths as a LONG, from weights and features in thousandths.

        Whole numbers add up alike in any order and engine, so loans tie exactly where
        they should. Features with more than three decimals are rounded half to even.
        """
        terms = [
            F.lit(round(w * 1000)) * half_even(F.coalesce(number_or(df, name), F.lit(0.0)) * 1000, 0).cast("long")
            for name, w in self.weights.items()
        ]
        return reduce(add, terms, F.lit(round(self.intercept * 1_000_000)).cast("long"))

    def add_fixed_probability(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Probability by the fixed log-odds, not rounded: equal where those are equal."""
        return df.withColumn(name, 1 / (1 + F.exp(-(self.fixed_log_odds(df) / F.lit(1e6)))))

    def impute(self, df: DataFrame) -> DataFrame:
        return fill(df, {name: self.medians.get(name, 0.0) for name in self.weights})

    def add_probability(self, df: DataFrame, name: str = "p") -> DataFrame:
        return df.withColumn(name, 1 / (1 + F.exp(-self.log_odds(df))))

    def add_attributions(self, df: DataFrame, name: str = ATTRIBUTIONS) -> DataFrame:
        means = {f: self.background.get(f, 0.0) for f in self.weights}
        return df.withColumn(name, linear_attributions(df, self.weights, means))

    def with_background(self, df: DataFrame) -> Scorecard:
        """The same scorecard with background means taken from ``df`` (one row)."""
        names = self.features
        row = df.agg(
            *[
                F.avg(F.coalesce(number_or(df, n), F.lit(0.0))).alias(f"m{i}")
                for i, n in enumerate(names)
            ]
        ).first()
        means = {n: row[f"m{i}"] or 0.0 for i, n in enumerate(names)}
        return Scorecard(self.intercept, self.weights, self.medians, means)
