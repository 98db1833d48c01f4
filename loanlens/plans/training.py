"""Training: split, cross-validate the candidates, refit the best, keep it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, NUMERIC_FEATURES, TARGET, Config
from loanlens.functions.values import col, number
from loanlens.operators.candidates import (
    FEATURE_VECTOR,
    WEIGHT,
    Candidate,
    ClassCounts,
    candidates,
)
from loanlens.operators.encode import encode_categoricals, get_model_features
from loanlens.operators.evaluation import evaluate
from loanlens.operators.forest import fit_forest, grows_alone
from loanlens.operators.impute import fill, median_values
from loanlens.operators.model import TrainedModel
from loanlens.operators.split import assign_folds, stratified_split
from loanlens.plans.ledger import Ledger, loans_checksum
from loanlens.session import cut_lineage, ensure_checkpoint_dir


@dataclass(frozen=True)
class TrainResult:
    """``labelled`` is the written copy of the input, ``test`` the held-out rows, complete."""

    model: TrainedModel
    labelled: DataFrame
    test: DataFrame
    features: list[str]
    cv: DataFrame


def prepare_xy(
    labelled: DataFrame, medians: dict[str, float] | None = None
) -> tuple[DataFrame, list[str], dict[str, float]]:
    """Loan id, complete DOUBLE features and the label; feature order; medians used.

    ``medians`` default to those of ``labelled`` itself.
    """
    encoded = encode_categoricals(labelled)
    features = get_model_features(encoded.columns)
    if not features:
        raise ValueError("no model features; build the feature matrix first")
    rows = encoded.select(
        col(LOAN_ID),
        *[number(encoded, f).alias(f) for f in features],
        col(TARGET).cast("int").alias(TARGET),
    )
    if medians is None:
        # Indicators are never missing.
        medians = median_values(rows, [f for f in features if f in NUMERIC_FEATURES])
    return fill(rows, medians).select(LOAN_ID, *map(col, features), TARGET), features, medians


def fold_counts(rows: DataFrame) -> dict[int, ClassCounts]:
    """Class counts of the rows outside of each fold."""
    found = {(r["fold"], r[TARGET]): r["count"] for r in rows.groupBy("fold", TARGET).count().collect()}
    whole = [sum(n for (_, y), n in found.items() if y == label) for label in (0, 1)]
    folds = {fold for fold, _ in found}
    return {
        f: ClassCounts(whole[0] - found.get((f, 0), 0), whole[1] - found.get((f, 1), 0)) for f in folds
    }


def class_counts(rows: DataFrame) -> ClassCounts:
    found = {r[TARGET]: r["count"] for r in rows.groupBy(TARGET).count().collect()}
    return ClassCounts(good=found.get(0, 0), bad=found.get(1, 0))


def _weighted(rows: DataFrame, candidate: Candidate, counts: ClassCounts) -> DataFrame:
    good, bad = candidate.weights(counts)
    return rows.withColumn(WEIGHT, F.when(F.col(TARGET) == 1, bad).otherwise(good))


def cross_validate_models(
    rows: DataFrame,
    features: list[str],
    cfg: Config,
    counts: ClassCounts | None = None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """ROC-AUC per candidate and fold: ``(model, fold, auc)``.

    ``rows`` are complete feature rows. They are assembled and written once; every
    fit reads that copy. A balanced candidate is weighted by the classes of the rows it
    is fitted on, a boosted one by those of all rows. Fits that ``ledger`` has are not
    repeated, and every other one is entered as it ends.
    """
    counts = counts or class_counts(rows)
    folded = assign_folds(rows, cfg.cv_folds, cfg.seed)
    vectors = VectorAssembler(inputCols=features, outputCol=FEATURE_VECTOR).transform(folded)
    vectors = cut_lineage(vectors.select("fold", TARGET, FEATURE_VECTOR))
    per_fold = fold_counts(vectors)
    evaluator = BinaryClassificationEvaluator(labelCol=TARGET, metricName="areaUnderROC", numBins=0)

    def run(task: tuple[Candidate, int]) -> tuple[str, int, float]:
        candidate, fold = task
        own = per_fold.get(fold, counts) if candidate.balanced else counts
        training = _weighted(vectors.filter(F.col("fold") != fold), candidate, own)
        fitted = candidate.build(own).fit(training)
        held_out = fitted.transform(vectors.filter(F.col("fold") == fold))
        auc = float(evaluator.evaluate(held_out))
        if ledger is not None:
            ledger.record(candidate.name, fold, auc)
        return candidate.name, fold, auc

    known = ledger.fits() if ledger is not None else {}
    wanted = list(product(candidates(cfg).values(), range(cfg.cv_folds)))
    tasks = [(candidate, fold) for candidate, fold in wanted if (candidate.name, fold) not in known]
    run_in_thread = inheritable_thread_target(rows.sparkSession)(run)
    with ThreadPoolExecutor(cfg.profile.fold_parallelism) as pool:
        fresh = {(name, fold): auc for name, fold, auc in pool.map(run_in_thread, tasks)}
    found = known | fresh
    results = [(c.name, fold, found[c.name, fold]) for c, fold in wanted]
    return rows.sparkSession.createDataFrame(results, "model string, fold int, auc double")


def cv_summary(cv: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fold results per candidate."""
    return cv.groupBy("model").agg(
        F.avg("auc").alias("mean_auc"), F.stddev_samp("auc").alias("std_auc")
    )


def best_model(cv: DataFrame, cfg: Config) -> str:
    """The candidate with the highest mean; the first one configured on ties."""
    means = {r["model"]: r["mean_auc"] for r in cv_summary(cv).collect()}
    return max(cfg.candidates, key=lambda name: means[name])


def fit_candidate(
    rows: DataFrame,
    features: list[str],
    name: str,
    cfg: Config,
    medians: dict[str, float] | None = None,
    scale: bool = False,
) -> TrainedModel:
    """Fit one candidate on complete feature rows; ``scale`` adds a scaler stage."""
    ensure_checkpoint_dir(rows.sparkSession)  # boosting cuts its lineage there
    counts = class_counts(rows)
    candidate = candidates(cfg)[name]
    stages = [VectorAssembler(inputCols=features, outputCol="raw" if scale else FEATURE_VECTOR)]
    if scale:
        stages.append(
            StandardScaler(inputCol="raw", outputCol=FEATURE_VECTOR, withMean=False)
        )
    stages.append(candidate.build(counts))
    weighted = _weighted(rows, candidate, counts)
    # A label that is neither good nor bad is left to Spark, which refuses it.
    usual = name == "forest" and min(counts.good, counts.bad) > 0 and counts.good + counts.bad == rows.count()
    if usual and grows_alone(stages[-1], counts.good + counts.bad, len(features)):
        before = Pipeline(stages=stages[:-1]).fit(weighted)
        forest = fit_forest(stages[-1], before.transform(weighted), candidate.weights(counts))
        fitted = PipelineModel([*before.stages, forest])
    else:
        fitted = Pipeline(stages=stages).fit(weighted)
    means = rows.agg(*[F.avg(col(f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    background = {f: float(means[f"m{i}"]) for i, f in enumerate(features)}
    return TrainedModel(name, fitted, features, medians or {}, background)


def train(
    labelled: DataFrame,
    cfg: Config | None = None,
    *,
    model_path: str | None = None,
    medians_of_all_rows: bool = False,
    ledger_root: str | None = None,
) -> TrainResult:
    """Split, cross-validate, refit the best candidate and, if asked, save it.

    Missing features get the medians of the training rows; ``medians_of_all_rows``
    takes them before the split. With ``ledger_root``, a folder in shared storage, a second
    call on the same rows and configuration goes on where the first one stopped.
    """
    cfg = cfg or Config()
    labelled = cut_lineage(labelled)
    medians = prepare_xy(labelled)[2] if medians_of_all_rows else None
    training, test = stratified_split(labelled, cfg.test_size, cfg.seed)
    rows, features, medians = prepare_xy(training, medians)
    rows = cut_lineage(rows)
    test_rows = prepare_xy(test, medians)[0]
    ledger = Ledger.of(ledger_root, rows, features, cfg) if ledger_root else None
    cv = cross_validate_models(rows, features, cfg, ledger=ledger)
    best = best_model(cv, cfg)

    def refit() -> TrainedModel:
        return replace(fit_candidate(rows, features, best, cfg, medians), trained_on=loans_checksum(rows))

    model = ledger.model(best, refit) if ledger else refit()
    if model_path is not None:
        model.save(model_path)
    return TrainResult(model, labelled, test_rows, features, cv)


def evaluate_model(
    model: TrainedModel, labelled: DataFrame, cfg: Config | None = None
) -> DataFrame:
    """Metrics of a saved model on the held-out loans.

    The split depends on the loan ids and the seed only, so these are the loans the model
    has not seen. That is proved: the loans on the other side of the split have to be those
    that the model was trained on, and the features its own. Anything else (other loans,
    seed or share, a model that :func:`train` has not made) raises ValueError.
    """
    cfg = cfg or Config()
    training, test = stratified_split(labelled, cfg.test_size, cfg.seed)
    if model.trained_on is None or loans_checksum(training) != model.trained_on:
        raise ValueError("the loans held out here are not those held out when the model was trained")
    rows, features, _ = prepare_xy(test, dict(model.medians))
    if features != model.features:
        raise ValueError("the features are not those of the model")
    return evaluate(model.add_probability(rows), model=model.name)
