"""Fixed vocabularies and the run configuration.

Nothing here reads the environment at import time: a :class:`Config` is built
once by the caller and handed to every operator that needs it.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Canonical column names of the credit snapshots.
LOAN_ID = "LOAN_ID"
SNAPSHOT_DATE = "SNAPSHOT_DATE"
DPD = "DAYS_PAST_DUE"
STATUS_L2 = "ACCOUNT_STATUS_L2"
ARREARS_STATUS = "BALANCE_DUE_STATUS"
TOTAL_PAID = "TOTAL_PAID"
TOTAL_DUE = "TOTAL_DUE_TODAY"
TARGET = "target"

# --- Fixed values: they define the results, so they are stated as they are. ---

SNAPSHOT_FILES = (
    ("Credit Data - 01-01-2025.csv", "2025-01-01"),
    ("Credit Data - 30-03-2025.csv", "2025-03-31"),
    ("Credit Data - 30-06-2025.csv", "2025-06-30"),
    ("Credit Data - 30-09-2025.csv", "2025-09-30"),
    ("Credit Data - 30-12-2025.csv", "2025-12-30"),
)
EARLY_SNAPSHOTS = ("2025-01-01", "2025-03-31", "2025-06-30")
LATE_SNAPSHOTS = ("2025-09-30", "2025-12-30")

BAD_STATUSES = ("FPD", "FMD")
# Days-past-due threshold of each soft definition; "combined" adds the hard rule.
SOFT_THRESHOLDS = {"par30": 30, "par60": 60, "par90": 90, "combined": 30}
HARD_DEFINITIONS = ("fpd_fmd", "combined")
TARGET_DEFINITIONS = ("fpd_fmd", "par30", "par60", "par90", "combined")

# (label, lower, upper); ages are right-closed (lower, upper].
AGE_BANDS = (
    ("18-25", 0, 25),
    ("26-35", 25, 35),
    ("36-45", 35, 45),
    ("46-55", 45, 55),
    ("55+", 55, 200),
)
# (label, lower, upper); incomes are left-closed [lower, upper).
INCOME_BANDS = (
    ("Below 5K", 0, 5_000),
    ("5K-10K", 5_000, 10_000),
    ("10K-20K", 10_000, 20_000),
    ("20K-30K", 20_000, 30_000),
    ("30K-50K", 30_000, 50_000),
    ("50K-100K", 50_000, 100_000),
    ("100K-150K", 100_000, 150_000),
    ("150K+", 150_000, float("inf")),
)
UNKNOWN_BAND = "Unknown"

# (label, lowest score, highest score), best first, both ends included.
RISK_BANDS = (
    ("Excellent", 800, 850),
    ("Good", 700, 799),
    ("Fair", 600, 699),
    ("Risky", 500, 599),
    ("High Risk", 300, 499),
)

NUMERIC_FEATURES = (
    "early_max_dpd",
    "early_avg_dpd",
    "early_dpd_std",
    "early_dpd_trend",
    "early_had_arrears",
    "early_avg_collection_rate",
    "early_min_collection_rate",
    "early_std_collection_rate",
    "loan_amount",
    "loan_term_months",
    "markup_ratio",
    "age_years",
    "avg_monthly_income",
    "is_male",
    "nps_score",
    "is_promoter",
    "is_detractor",
    "phone_locked",
    "payment_delay",
    "n_snapshots_early",
)
LEAKING_COLUMNS = (
    "ever_hard_default",
    "current_status_l2",
    "par90_ever",
    "par60_ever",
)

# Feature -> (text shown to the borrower, effect of a higher value).
REASON_CODES = {
    "early_max_dpd": ("High early delinquency detected", "negative"),
    "early_avg_dpd": ("Consistent early payment delays", "negative"),
    "early_dpd_std": ("Inconsistent early payment pattern", "negative"),
    "early_dpd_trend": ("Worsening payment trend over time", "negative"),
    "early_had_arrears": ("Account was in arrears early on", "negative"),
    "early_avg_collection_rate": ("Consistent early payment history", "positive"),
    "early_min_collection_rate": ("Reliable minimum payment rate", "positive"),
    "early_std_collection_rate": ("Irregular payment amounts", "negative"),
    "loan_amount": ("Adequate loan amount", "positive"),
    "loan_term_months": ("Manageable loan duration", "positive"),
    "markup_ratio": ("Higher interest cost margin", "negative"),
    "age_years": ("Established age (lower risk)", "positive"),
    "avg_monthly_income": ("Stable demonstrated income", "positive"),
    "is_male": ("Gender indicator", "neutral"),
    "nps_score": ("Customer satisfaction score", "positive"),
    "is_promoter": ("Highly satisfied customer", "positive"),
    "is_detractor": ("Dissatisfied customer indicator", "negative"),
    "phone_locked": ("Device locked for non-payment", "negative"),
    "payment_delay": ("History of payment delays", "negative"),
    "n_snapshots_early": ("Complete early payment record", "positive"),
    "age_band_18-25": ("Younger borrower age group", "negative"),
    "age_band_26-35": ("Young adult age group", "neutral"),
    "age_band_36-45": ("Mid-career age group", "positive"),
    "age_band_46-55": ("Established age group", "positive"),
    "age_band_55+": ("Senior age group", "positive"),
    "income_band_Below 5K": ("Very low income bracket", "negative"),
    "income_band_5K-10K": ("Low income bracket", "negative"),
    "income_band_10K-20K": ("Moderate income bracket", "neutral"),
    "income_band_20K-30K": ("Good income bracket", "positive"),
    "income_band_30K-50K": ("Strong income bracket", "positive"),
    "income_band_50K-100K": ("High income bracket", "positive"),
    "income_band_100K-150K": ("Very high income bracket", "positive"),
    "income_band_150K+": ("Top income bracket", "positive"),
}

# Value a scoring request gets for a field it leaves out.
REQUEST_DEFAULTS = {name: 0 for name in NUMERIC_FEATURES} | {"n_snapshots_early": 3}

# --- End of the fixed values. ---

AGE_BAND_COLUMNS = tuple(f"age_band_{label}" for label, _, _ in AGE_BANDS)
INCOME_BAND_COLUMNS = tuple(f"income_band_{label}" for label, _, _ in INCOME_BANDS)
MODEL_FEATURES = NUMERIC_FEATURES + AGE_BAND_COLUMNS + INCOME_BAND_COLUMNS


@dataclass(frozen=True)
class TrainingProfile:
    """Sizes of the candidate models; the defaults are those of production."""

    forest_trees: int = 500
    boosting_rounds: int = 1000
    logistic_iterations: int = 2000
    max_bins: int = 256
    fold_parallelism: int = 2


@dataclass(frozen=True)
class Config:
    early_snapshots: tuple[str, ...] = EARLY_SNAPSHOTS
    late_snapshots: tuple[str, ...] = LATE_SNAPSHOTS
    snapshot_files: tuple[tuple[str, str], ...] = SNAPSHOT_FILES
    target_definition: str = "combined"
    # Use every snapshot when not one early row exists (costs a look at the data).
    early_fallback: bool = True

    score_min: int = 300
    score_max: int = 850
    pdo: int = 20
    base_score: int = 600
    base_odds: float = 5.0

    seed: int = 42
    test_size: float = 0.20
    cv_folds: int = 5
    candidates: tuple[str, ...] = ("logistic", "forest", "boosted_a", "boosted_b")
    profile: TrainingProfile = field(default_factory=TrainingProfile)

    def __post_init__(self) -> None:
        if self.target_definition not in TARGET_DEFINITIONS:
            raise ValueError(
                f"unknown target definition {self.target_definition!r}; "
                f"choose one of {', '.join(TARGET_DEFINITIONS)}"
            )

    def with_(self, **changes) -> Config:
        return replace(self, **changes)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Config with the seven documented environment overrides applied."""
        env = os.environ if env is None else env
        readers = {
            "target_definition": ("TARGET_DEFINITION", str),
            "pdo": ("PDO", int),
            "base_score": ("BASE_SCORE", int),
            "base_odds": ("BASE_ODDS", float),
            "seed": ("RANDOM_STATE", int),
            "test_size": ("TEST_SIZE", float),
            "cv_folds": ("CV_FOLDS", int),
        }
        return cls(
            **{
                name: read(env[variable])
                for name, (variable, read) in readers.items()
                if variable in env
            }
        )
