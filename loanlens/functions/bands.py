"""Age and income bands and their indicator columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.config import AGE_BANDS, INCOME_BANDS, REASON_CODES, RISK_BANDS, Config


def age_band(age: Column) -> Column:
    """Right-closed age band; NULL outside every band."""
    band = F.lit(None).cast("string")
    for label, low, high in reversed(AGE_BANDS):
        band = F.when((age > low) & (age <= high), F.lit(label)).otherwise(band)
    return band


def income_band(income: Column) -> Column:
    """Left-closed income band; NULL when negative or missing."""
    band = F.lit(None).cast("string")
    for label, low, high in reversed(INCOME_BANDS):
        inside = income >= low
        if high != float("inf"):
            inside = inside & (income < high)
        band = F.when(inside, F.lit(label)).otherwise(band)
    return band


def indicators(band: Column, prefix: str, labels: list[str]) -> list[Column]:
    """One 0/1 INT column per configured label, whether or not it occurs."""
    return [
        F.when(band == label, 1).otherwise(0).cast("int").alias(f"{prefix}_{label}")
        for label in labels
    ]


def age_indicators(band: Column) -> list[Column]:
    return indicators(band, "age_band", [label for label, _, _ in AGE_BANDS])


def income_indicators(band: Column) -> list[Column]:
    return indicators(band, "income_band", [label for label, _, _ in INCOME_BANDS])


def pd_to_score(p: Column, cfg: Config | None = None) -> Column:
    """Score of a probability of default on the log-odds scale, as a bounded INT."""
    cfg = cfg or Config()
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    factor = F.lit(float(cfg.pdo)) / F.log(F.lit(2.0))
    offset = F.lit(float(cfg.base_score)) - factor * F.log(F.lit(float(cfg.base_odds)))
    raw = F.rint(offset - factor * F.log(safe / (F.lit(1.0) - safe)))
    low, high = F.lit(float(cfg.score_min)), F.lit(float(cfg.score_max))
    return F.when(p.isNotNull(), F.least(F.greatest(raw, low), high).cast("int"))


def risk_band(score: Column) -> Column:
    band = F.lit("Unknown")
    for label, low, high in reversed(RISK_BANDS):
        band = F.when(score.between(low, high), F.lit(label)).otherwise(band)
    return band


def percent_text(p: Column) -> Column:
    return F.format_string("%.2f%%", p * 100)


def reason_text(feature: str) -> str:
    """Reason text of a feature; its name in title case when it has none."""
    if feature in REASON_CODES:
        return REASON_CODES[feature][0]
    return feature.replace("_", " ").title()
