"""Attributions and the explanations made from them.

An attribution is an array column in feature order. Ranking drivers happens inside
each row, so explaining a whole portfolio needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, REASON_CODES
from loanlens.functions.bands import percent_text, reason_text
from loanlens.functions.values import col, half_even, number

ATTRIBUTIONS = "attributions"
SIGNIFICANT = 0.001
TOP_DRIVERS = 4


def linear_attributions(
    df: DataFrame, weights: Mapping[str, float], background: Mapping[str, float]
) -> Column:
    """Weight times distance from the background mean, in log-odds, per feature."""
    parts = []
    for name, weight in weights.items():
        distance = F.coalesce(number(df, name), F.lit(0.0)) - F.lit(float(background[name]))
        parts.append(F.lit(float(weight)) * distance)
    return F.array(*parts)


def long_form(df: DataFrame, features: Sequence[str], attr: str = ATTRIBUTIONS) -> DataFrame:
    """``(LOAN_ID, feature, value)``, one row per loan and feature."""
    names = F.array(*[F.lit(f) for f in features])
    return df.select(LOAN_ID, F.posexplode(attr).alias("i", "value")).select(
        LOAN_ID, F.element_at(names, F.col("i") + 1).alias("feature"), "value"
    )


def global_importance(
    df: DataFrame,
    features: Sequence[str],
    attr: str = ATTRIBUTIONS,
    top: int | None = None,
) -> DataFrame:
    """Mean absolute attribution of all features, or of the ``top`` ones, largest first.

    One aggregate over all features at once; only its single row is reshaped.
    """
    means = df.agg(*[F.avg(F.abs(F.col(attr)[i])).alias(f"m{i}") for i in range(len(features))])
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(f"m{i}").alias("mean_abs_shap"),
                F.lit(i).alias("i"),
            )
            for i, name in enumerate(features)
        ]
    )
    ranked = means.select(F.inline(pairs)).orderBy(F.col("mean_abs_shap").desc(), "i").drop("i")
    return ranked if top is None else ranked.limit(top)


def _sorted_keys(values: Sequence[Column]) -> Column:
    """Values with their positions, lowest first; positions decide ties."""
    pairs = [F.struct(v.alias("v"), F.lit(i).alias("i")) for i, v in enumerate(values)]
    return F.sort_array(F.array(*pairs))


def _first_keys(keys: Column, n: int, available: int) -> Column:
    """The first ``n`` of the sorted keys.

    Taken one by one, so that the sorted array is referenced several times. It is
    then computed by generated code in a step of its own, not inside the slower
    evaluation of the array functions that follow.
    """
    return F.array(*[keys[k] for k in range(min(n, available))])


def add_reason_codes(
    df: DataFrame,
    features: Sequence[str],
    attr: str = ATTRIBUTIONS,
    n: int = TOP_DRIVERS,
    strict_sign: bool = False,
    name: str = "reason_codes",
) -> DataFrame:
    """Add the strongest drivers of each row as an array, helpful ones first.

    The ``n`` lowest attributions count as helping and the ``n`` highest as
    hurting, both strongest first; those near zero are dropped afterwards. With
    ``strict_sign`` a driver must also have the matching sign.
    """
    names = F.array(*[F.lit(f) for f in features])
    texts = F.array(*[F.lit(reason_text(f)) for f in features])
    values = [F.col(attr)[i] for i in range(len(features))]
    ranked = df.withColumns(
        {"_helping": _sorted_keys(values), "_hurting": _sorted_keys([-v for v in values])}
    )

    def strongest(keys: str, sign: int, direction: str) -> Column:
        kept = F.filter(
            _first_keys(F.col(keys), n, len(features)),
            lambda e: (e["v"] < -SIGNIFICANT) if strict_sign else (F.abs(e["v"]) > SIGNIFICANT),
        )
        return F.transform(
            kept,
            lambda e: F.struct(
                F.element_at(names, e["i"] + 1).alias("code"),
                F.element_at(texts, e["i"] + 1).alias("description"),
                F.lit(direction).alias("direction"),
                half_even(e["v"] * sign, 4).alias("shap"),
            ),
        )

    helping, hurting = strongest("_helping", 1, "positive"), strongest("_hurting", -1, "negative")
    return ranked.withColumn(name, F.concat(helping, hurting)).drop("_helping", "_hurting")


def driver_texts(codes: Column, direction: str) -> Column:
    mark = {"positive": "✓ ", "negative": "✗ "}[direction]
    chosen = F.filter(codes, lambda c: c["direction"] == direction)
    return F.transform(chosen, lambda c: F.concat(F.lit(mark), c["description"]))


def explain(
    scored: DataFrame,
    features: Sequence[str],
    attr: str = ATTRIBUTIONS,
    n: int = TOP_DRIVERS,
    strict_sign: bool = False,
) -> DataFrame:
    """Explanation per loan from ``pd_score, credit_score, risk_band`` and attributions."""
    return add_reason_codes(scored, features, attr, n, strict_sign).select(
        LOAN_ID,
        "credit_score",
        "risk_band",
        percent_text(F.col("pd_score")).alias("pd_pct"),
        driver_texts(F.col("reason_codes"), "positive").alias("positive_drivers"),
        driver_texts(F.col("reason_codes"), "negative").alias("negative_drivers"),
        "reason_codes",
    )


def fallback_reasons(features: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """Drivers by raw value and the fixed direction of each feature, without a model.

    ``(LOAN_ID, positive_drivers, negative_drivers)`` as arrays of
    ``(code, description, value)``, largest value first.
    """
    chosen = {
        direction: [
            (name, text)
            for name, (text, way) in REASON_CODES.items()
            if way == direction and name in features.columns
        ]
        for direction in ("positive", "negative")
    }

    def keys(direction: str) -> Column:
        values = [F.coalesce(-number(features, f), F.lit(0.0)) for f, _ in chosen[direction]]
        return _sorted_keys(values).alias(direction)

    def drivers(direction: str) -> Column:
        rows = chosen[direction]
        if not rows:
            return F.array().cast("array<struct<code:string,description:string,value:double>>")
        names = F.array(*[F.lit(name) for name, _ in rows])
        texts = F.array(*[F.lit(text) for _, text in rows])
        first = _first_keys(F.col(direction), n, len(rows))
        return F.transform(
            F.filter(first, lambda e: e["v"] < 0),
            lambda e: F.struct(
                F.element_at(names, e["i"] + 1).alias("code"),
                F.element_at(texts, e["i"] + 1).alias("description"),
                (-e["v"]).alias("value"),
            ),
        )

    ranked = features.select(col(LOAN_ID), *[keys(way) for way, rows in chosen.items() if rows])
    return ranked.select(LOAN_ID, *[drivers(way).alias(f"{way}_drivers") for way in chosen])
