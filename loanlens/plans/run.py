"""The three jobs of a deployment: train, score, explain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, TARGET, Config
from loanlens.operators.curves import curve, ks_curve, pr_curve, roc_curve
from loanlens.operators.evaluation import (
    calibration,
    class_report,
    confusion,
    metrics,
    pd_histogram,
)
from loanlens.operators.importance import compute_shap
from loanlens.operators.model import TrainedModel
from loanlens.operators.scoring import band_summary, explain_portfolio, score_portfolio
from loanlens.operators.target import define_target, dropped_loans
from loanlens.plans.features import build_feature_matrix, build_labelled_matrix
from loanlens.plans.training import TrainResult, train
from loanlens.session import cut_lineage
from loanlens.sources.load import Sources
from loanlens.sources.sinks import write_metrics, write_report, write_scores


@dataclass(frozen=True)
class RunResult:
    training: TrainResult
    metrics: DataFrame
    report: DataFrame
    dropped: DataFrame
    importance: DataFrame
    attribution: DataFrame
    scores: DataFrame
    bands: DataFrame


def _matrix(sources: Sources, cfg: Config) -> DataFrame:
    return build_feature_matrix(sources.credit, sources.demographics, sources.nps, cfg)


def run_full(sources: Sources, out_dir: str, cfg: Config | None = None) -> RunResult:
    """Everything from raw sources to written model, metrics, curves and portfolio scores.

    ``out_dir`` gets model, metrics, report, the curves and tables of the evaluation,
    importances, the number of loans without a label, and portfolio_scores. Where
    ``spark.checkpoint.dir`` is set, finished fits are kept there, and a job that is started
    again goes on from them.
    """
    cfg = cfg or Config()
    shared = sources.credit.sparkSession.conf.get("spark.checkpoint.dir", None)
    matrix = build_labelled_matrix(sources.credit, sources.demographics, sources.nps, cfg)
    training = train(
        matrix, cfg, model_path=f"{out_dir}/model", ledger_root=shared and f"{shared.rstrip('/')}/ledger"
    )
    model, labelled = training.model, training.labelled
    scored = cut_lineage(model.add_probability(training.test).select(LOAN_ID, TARGET, "p"))
    points = cut_lineage(curve(scored))
    record = metrics(points, model.name)
    report = class_report(confusion(points))
    write_metrics(record, f"{out_dir}/metrics")
    write_report(report, f"{out_dir}/report")
    dropped = dropped_loans(labelled, define_target(sources.credit, cfg=cfg))
    dropped = cut_lineage(dropped.agg(F.count(F.lit(1)).alias("n_dropped")))
    tables = {
        "roc_curve": roc_curve(points),
        "pr_curve": pr_curve(points),
        "ks_curve": ks_curve(points),
        "calibration": calibration(scored),
        "pd_histogram": pd_histogram(scored),
        "importances": model.importances(None),
        "dropped_loans": dropped,
    }
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    # Every loan with features has a label, so the labelled matrix is the portfolio.
    scores = score_portfolio(model, labelled, cfg)
    write_scores(scores, f"{out_dir}/portfolio_scores")
    return RunResult(
        training=training,
        metrics=record,
        report=report,
        dropped=dropped,
        importance=model.importances(),
        attribution=compute_shap(model, labelled),
        scores=scores,
        bands=band_summary(scores),
    )


def run_score(
    spark: SparkSession, sources: Sources, model_path: str, out_dir: str, cfg: Config | None = None
) -> DataFrame:
    """Score the portfolio with a saved model and write the result."""
    cfg = cfg or Config()
    model = TrainedModel.load(spark, model_path)
    scores = score_portfolio(model, _matrix(sources, cfg), cfg)
    write_scores(scores, f"{out_dir}/portfolio_scores")
    return scores


def run_explain(
    spark: SparkSession, sources: Sources, model_path: str, cfg: Config | None = None
) -> DataFrame:
    """Explain every loan of the portfolio with a saved model."""
    cfg = cfg or Config()
    model = TrainedModel.load(spark, model_path)
    return explain_portfolio(model, _matrix(sources, cfg), cfg)
