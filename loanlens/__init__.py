"""Loan-risk analytics on Spark: features, labels, models, metrics, scores, reasons."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from loanlens.config import Config, TrainingProfile  # noqa: E402
from loanlens.operators.curves import curve, ks_curve, pr_curve, roc_curve  # noqa: E402
from loanlens.operators.evaluation import (  # noqa: E402
    calibration,
    class_report,
    confusion,
    evaluate,
    metrics,
    pd_histogram,
)
from loanlens.operators.attribution import fallback_reasons, global_importance, long_form  # noqa: E402
from loanlens.operators.importance import compute_shap  # noqa: E402
from loanlens.operators.model import TrainedModel  # noqa: E402
from loanlens.operators.scorecard import Scorecard  # noqa: E402
from loanlens.operators.scoring import (  # noqa: E402
    band_summary,
    batch_summary,
    explain_portfolio,
    score_dataframe,
    score_portfolio,
    score_requests,
    score_summary,
)
from loanlens.operators.split import assign_folds, stratified_split  # noqa: E402
from loanlens.operators.target import define_target, merge_target  # noqa: E402
from loanlens.plans.features import build_feature_matrix, build_labelled_matrix  # noqa: E402
from loanlens.plans.run import run_explain, run_full, run_score  # noqa: E402
from loanlens.plans.training import TrainResult, evaluate_model, train  # noqa: E402
from loanlens.sources.borrowers import load_demographics, load_nps  # noqa: E402
from loanlens.sources.load import SourceLayout, Sources, load_all  # noqa: E402
from loanlens.sources.snapshots import load_snapshots  # noqa: E402
from loanlens.streaming.requests import score_requests_stream  # noqa: E402

__all__ = [
    "Config",
    "Scorecard",
    "SourceLayout",
    "Sources",
    "TrainResult",
    "TrainedModel",
    "TrainingProfile",
    "assign_folds",
    "band_summary",
    "batch_summary",
    "build_feature_matrix",
    "build_labelled_matrix",
    "calibration",
    "class_report",
    "compute_shap",
    "confusion",
    "curve",
    "define_target",
    "evaluate",
    "evaluate_model",
    "explain_portfolio",
    "fallback_reasons",
    "global_importance",
    "ks_curve",
    "load_all",
    "load_demographics",
    "load_nps",
    "load_snapshots",
    "long_form",
    "merge_target",
    "metrics",
    "pd_histogram",
    "pr_curve",
    "roc_curve",
    "run_explain",
    "run_full",
    "run_score",
    "score_dataframe",
    "score_portfolio",
    "score_requests",
    "score_requests_stream",
    "score_summary",
    "stratified_split",
    "train",
]
