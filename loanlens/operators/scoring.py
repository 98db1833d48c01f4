"""From probabilities to scores and bands: portfolios, requests and summaries."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, NUMERIC_FEATURES, REQUEST_DEFAULTS, RISK_BANDS, Config
from loanlens.functions.bands import (
    age_band,
    income_band,
    pd_to_score,
    percent_text,
    risk_band,
)
from loanlens.functions.values import col, half_even, number_or, ratio
from loanlens.operators.attribution import (
    ATTRIBUTIONS,
    add_reason_codes,
    driver_texts,
    explain,
)
from loanlens.operators.encode import encode_categoricals
from loanlens.operators.impute import fill, median_values
from loanlens.session import cut_lineage


class RiskModel(Protocol):
    """What scoring needs of a model; scorecards and trained models both have it."""

    @property
    def features(self) -> list[str]: ...

    def impute(self, df: DataFrame) -> DataFrame: ...

    def add_probability(self, df: DataFrame, name: str = "p") -> DataFrame: ...

    def add_attributions(self, df: DataFrame, name: str = ATTRIBUTIONS) -> DataFrame: ...


def add_scores(df: DataFrame, p: str = "p", cfg: Config | None = None) -> DataFrame:
    """Add rounded probability, score and band; the score uses the unrounded one."""
    scored = df.withColumns(
        {"pd_score": half_even(F.col(p), 4), "credit_score": pd_to_score(F.col(p), cfg)}
    )
    return scored.withColumn("risk_band", risk_band(F.col("credit_score")))


def score_dataframe(model: RiskModel, df: DataFrame, cfg: Config | None = None) -> DataFrame:
    """``LOAN_ID, pd_score, credit_score, risk_band`` of complete feature rows."""
    scored = add_scores(model.add_probability(df, "p"), "p", cfg)
    return scored.select(LOAN_ID, "pd_score", "credit_score", "risk_band")


def score_portfolio(
    model: RiskModel,
    features: DataFrame,
    cfg: Config | None = None,
    *,
    refit_medians: bool = False,
) -> DataFrame:
    """``LOAN_ID, pd, score, risk_band`` of a feature matrix.

    Missing features get the medians kept with the model; ``refit_medians`` takes
    them from the scored table instead, which is then written to the checkpoint
    folder first because it is read several times.
    """
    encoded = encode_categoricals(features)
    if refit_medians:
        encoded = cut_lineage(encoded)
        names = [f for f in model.features if f in encoded.columns and f in NUMERIC_FEATURES]
        encoded = fill(encoded, median_values(encoded, names))
    scored = score_dataframe(model, model.impute(encoded), cfg)
    return scored.withColumnsRenamed({"pd_score": "pd", "credit_score": "score"})


def explain_portfolio(
    model: RiskModel,
    features: DataFrame,
    cfg: Config | None = None,
    n: int = 4,
    strict_sign: bool = False,
) -> DataFrame:
    """Score, band, drivers and reason codes of every loan."""
    complete = model.impute(encode_categoricals(features))
    scored = model.add_attributions(model.add_probability(complete, "p"))
    return explain(add_scores(scored, "p", cfg), model.features, ATTRIBUTIONS, n, strict_sign)


# --- Requests ----------------------------------------------------------------

# Request fields that only take whole numbers.
WHOLE_FIELDS = (
    "early_had_arrears",
    "is_male",
    "is_promoter",
    "is_detractor",
    "phone_locked",
    "payment_delay",
    "n_snapshots_early",
)


def request_features(requests: DataFrame) -> DataFrame:
    """Requests as complete feature rows, with ``failed`` for unusable ones.

    Fields left out get their default. A value that is not a number, or not whole
    where it has to be, makes the request fail.
    """
    given = [name for name in NUMERIC_FEATURES if name in requests.columns]
    loan = col("loan_id") if "loan_id" in requests.columns else F.lit(None)
    corrupt = F.lit(False)
    if "_corrupt_record" in requests.columns:
        corrupt = col("_corrupt_record").isNotNull()
    parsed = requests.select(
        loan.cast("string").alias("loan_id"),
        corrupt.alias("corrupt"),
        *[number_or(requests, name).alias(name) for name in given],
        *[col(name).isNotNull().alias(f"{name}?") for name in given],
    )
    failed = F.col("corrupt")
    for name in given:
        failed = failed | (col(f"{name}?") & col(name).isNull())
        if name in WHOLE_FIELDS:
            failed = failed | F.coalesce(col(name) != F.floor(name), F.lit(False))
    defaults = {name: F.lit(float(value)) for name, value in REQUEST_DEFAULTS.items()}
    values = [
        (F.coalesce(col(name), default) if name in given else default).alias(name)
        for name, default in defaults.items()
    ]
    rows = parsed.select("loan_id", failed.alias("failed"), *values)
    banded = rows.withColumns(
        {
            "age_band": age_band(F.col("age_years")),
            "income_band": income_band(F.col("avg_monthly_income")),
        }
    )
    return encode_categoricals(banded)


def score_requests(
    requests: DataFrame,
    model: RiskModel,
    cfg: Config | None = None,
    *,
    explain: bool = False,
    n: int = 4,
) -> DataFrame:
    """Score, band and percentage per request; optionally its drivers.

    A failed request gives zeros and the band ``Error``.
    """
    rows = request_features(requests)
    missing = [f for f in model.features if f not in rows.columns]
    rows = rows.withColumns({f: F.lit(0.0) for f in missing}) if missing else rows
    scored = add_scores(model.add_probability(rows, "p"), "p", cfg)
    if explain:
        scored = model.add_attributions(scored)
    ok = ~F.col("failed")
    out = [
        col("loan_id"),
        F.when(ok, F.col("pd_score")).otherwise(0.0).alias("pd_score"),
        F.when(ok, percent_text(F.col("p"))).otherwise("Error").alias("pd_pct"),
        F.when(ok, F.col("credit_score")).otherwise(0).alias("credit_score"),
        F.when(ok, F.col("risk_band")).otherwise("Error").alias("risk_band"),
    ]
    if explain:
        scored = add_reason_codes(scored, model.features, ATTRIBUTIONS, n, name="codes")
        for name, way in (("positive_drivers", "positive"), ("negative_drivers", "negative")):
            out.append(F.when(ok, driver_texts(F.col("codes"), way)).alias(name))
    return scored.select(*out)


# --- Summaries ---------------------------------------------------------------


def _names(scores: DataFrame) -> tuple[str, str]:
    """Names of the probability and score columns, renamed or not."""
    return ("pd", "score") if "score" in scores.columns else ("pd_score", "credit_score")


def band_summary(scores: DataFrame) -> DataFrame:
    """Loans, share (percent) and mean probability (percent) of the bands that occur.

    One aggregate with a count and a mean per band; its single row is reshaped.
    """
    p, _ = _names(scores)
    sums = []
    for i, (label, _, _) in enumerate(RISK_BANDS):
        here = F.col("risk_band") == label
        sums += [
            F.count_if(here).alias(f"n{i}"),
            F.avg(F.when(here, F.col(p))).alias(f"p{i}"),
        ]
    total = reduce(add, [F.col(f"n{i}") for i in range(len(RISK_BANDS))])
    lines = [
        F.struct(
            F.lit(label).alias("risk_band"),
            F.col(f"n{i}").alias("count"),
            half_even(F.col(f"p{i}") * 100, 2).alias("avg_pd"),
            half_even(ratio(F.col(f"n{i}"), total) * 100, 1).alias("pct"),
        )
        for i, (label, _, _) in enumerate(RISK_BANDS)
    ]
    occurring = F.filter(F.array(*lines), lambda line: line["count"] > 0)
    return scores.agg(*sums).select(F.inline(occurring))


def score_summary(scores: DataFrame) -> DataFrame:
    """All five bands with their score range, loans, share and mean probability."""
    p, score = _names(scores)
    sums = []
    for i, (_, low, high) in enumerate(RISK_BANDS):
        inside = F.col(score).between(low, high)
        sums += [
            F.count_if(inside).alias(f"n{i}"),
            F.avg(F.when(inside, F.col(p))).alias(f"p{i}"),
        ]
    totals = scores.agg(F.count(F.lit(1)).alias("total"), *sums)
    lines = [
        F.struct(
            F.lit(label).alias("risk_band"),
            F.lit(f"{low}–{high}").alias("score_range"),
            F.col(f"n{i}").alias("count"),
            F.coalesce(half_even(ratio(F.col(f"n{i}") * 100.0, F.col("total")), 1), F.lit(0.0)).alias(
                "pct"
            ),
            half_even(F.coalesce(F.col(f"p{i}"), F.lit(0.0)) * 100, 2).alias("avg_pd"),
        )
        for i, (label, low, high) in enumerate(RISK_BANDS)
    ]
    return totals.select(F.inline(F.array(*lines)))


def batch_summary(responses: DataFrame) -> DataFrame:
    """Total, mean score, mean probability and counts per band of scored requests."""
    bands = [label for label, _, _ in RISK_BANDS] + ["Unknown", "Error"]
    p, score = _names(responses)
    counts = [F.count_if(F.col("risk_band") == b).alias(f"n{i}") for i, b in enumerate(bands)]
    totals = responses.agg(
        F.count(F.lit(1)).alias("total"),
        F.avg(F.when(F.col(score) > 0, F.col(score))).alias("s"),
        F.avg(F.when(F.col(p) > 0, F.col(p))).alias("p"),
        *counts,
    )
    entries = F.array(
        *[F.struct(F.lit(b).alias("k"), F.col(f"n{i}").alias("v")) for i, b in enumerate(bands)]
    )
    return totals.select(
        "total",
        F.coalesce(half_even(F.col("s"), 1), F.lit(0.0)).alias("avg_score"),
        F.when(F.col("p").isNull(), "0%").otherwise(percent_text(F.col("p"))).alias("avg_pd_pct"),
        F.map_filter(F.map_from_entries(entries), lambda _, n: n > 0).alias("band_counts"),
    )


def score_profile(scores: DataFrame) -> DataFrame:
    """Loans, mean score and mean probability (percent) of a scoring run."""
    p, score = _names(scores)
    return scores.agg(
        F.count(F.lit(1)).alias("n_loans"),
        half_even(F.avg(score), 0).alias("avg_score"),
        half_even(F.avg(p) * 100, 2).alias("avg_pd_pct"),
    )
