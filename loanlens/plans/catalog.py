"""Named queries over the star-schema tables: one or more per operator.

Every query takes a session and the folder of the tables and returns a table
without arrays or maps. Doubles are rounded at the very end, half to even.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, NUMERIC_FEATURES, TARGET, TARGET_DEFINITIONS, Config
from loanlens.functions.bands import pd_to_score, risk_band
from loanlens.functions.naming import normalise_loan_id
from loanlens.functions.values import col, half_even, parse_date
from loanlens.operators import curves
from loanlens.operators.attribution import (
    ATTRIBUTIONS,
    add_reason_codes,
    fallback_reasons,
    global_importance,
    long_form,
)
from loanlens.operators.borrowers import (
    add_age_features,
    add_gender_features,
    add_income_features,
    add_loan_features,
    add_nps_features,
    add_sales_features,
)
from loanlens.operators.encode import encode_categoricals
from loanlens.operators.evaluation import (
    calibration,
    class_report,
    confusion,
    evaluate,
    metrics,
    pd_histogram,
)
from loanlens.operators.first_last import first_known_per_loan, first_per_loan
from loanlens.operators.impute import exact_medians
from loanlens.operators.importance import compute_shap
from loanlens.operators.model import TrainedModel
from loanlens.operators.scorecard import Scorecard
from loanlens.operators.scoring import (
    band_summary,
    batch_summary,
    explain_portfolio,
    score_dataframe,
    score_portfolio,
    score_profile,
    score_requests,
    score_summary,
)
from loanlens.operators.snapshots import (
    EarlyDates,
    arrears_flag,
    collection_rate,
    early_features,
    measured,
    trend_by_date,
)
from loanlens.operators.split import assign_folds, class_weights, mark_test
from loanlens.operators.target import define_target, dropped_loans, label_summary, merge_target
from loanlens.operators.trees import base_value, packed_trees
from loanlens.plans.features import (
    build_feature_matrix,
    build_labelled_matrix,
    last_demographics,
)
from loanlens.plans.training import fit_candidate, prepare_xy, train
from loanlens.session import checkpoint_folder, cut_lineage, spread
from loanlens.sources.borrowers import shape_nps
from loanlens.sources.snapshots import infer_numeric, union_snapshots
from loanlens.sources.tables import (
    VIEW_CONFIG,
    credit_view,
    loan_sources,
    nps_raw_view,
    request_view,
    sales_view,
    table,
)
from loanlens.streaming.requests import read_request_stream, score_requests_stream

Query = Callable[[SparkSession, str], DataFrame]

# A scorecard with fixed points, for queries that need a model but no training.
SCORECARD = Scorecard(
    intercept=-1.5,
    weights={
        "early_max_dpd": 0.03,
        "early_avg_dpd": 0.02,
        "early_had_arrears": 0.4,
        "early_avg_collection_rate": -1.0,
        "n_snapshots_early": -0.2,
        "early_dpd_trend": 0.05,
        "markup_ratio": 0.5,
        "loan_term_months": 0.02,
        "is_male": 0.1,
        "nps_score": -0.05,
        "age_band_18-25": 0.3,
        "income_band_Below 5K": 0.25,
    },
)

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__.lstrip("_")] = function
    return function


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: half_even(F.col(n), places) for n in names})


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    src = loan_sources(spark, sf)
    return build_labelled_matrix(src.credit, src.demographics, src.nps, VIEW_CONFIG)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    src = loan_sources(spark, sf)
    return build_feature_matrix(src.credit, src.demographics, src.nps, VIEW_CONFIG)


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    return encode_categoricals(_features(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Loan, label and scorecard probability.

    The probability comes from whole-number log-odds: the last bits of a sum of doubles, or
    of an exponential, differ by engine, but loans that tie in one tie in the other.
    """
    rows = SCORECARD.add_fixed_probability(encode_categoricals(_labelled(spark, sf)))
    return rows.select(LOAN_ID, TARGET, "p")


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return curves.curve(_scored(spark, sf))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return score_dataframe(SCORECARD, _encoded(spark, sf))


# --- Sources -----------------------------------------------------------------


@_query
def q_snapshot_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    base = [
        F.col("o_custkey").cast("string").alias(LOAN_ID),
        F.col("o_orderdate").alias("SNAPSHOT_DATE"),
        F.col("o_totalprice").alias("AMOUNT"),
    ]
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    older = orders.filter(F.col("o_orderdate") < cut)
    # Rows without a date belong to a snapshot too.
    newer = orders.filter(F.coalesce(F.col("o_orderdate") >= cut, F.lit(True)))
    return union_snapshots(
        [
            older.select(*base, F.col("o_orderpriority").alias("PRIORITY")),
            newer.select(*base, F.col("o_orderstatus").alias("STATUS")),
        ]
    )


@_query
def q_normalise_loan_id(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.concat(F.lit(" "), key.cast("string"), F.lit(" "))
    raw = F.when(key % 13 == 0, " nan").when(key % 11 != 0, text)
    rows = table(spark, sf, "customer").select(
        F.col("c_name").alias(" c_name "), raw.alias("Loan Id "), F.lit("x").alias(" ")
    )
    return normalise_loan_id(rows)


@_query
def q_infer_numeric(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey")
    rows = table(spark, sf, "orders").select(
        key.cast("string").alias(LOAN_ID),
        F.col("o_totalprice").cast("string").alias("AMOUNT"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.when(key % 7 == 0, "n/a").otherwise(key.cast("string")).alias("MIXED"),
        F.when(key % 5 != 0, F.concat(F.lit(" "), key.cast("string"))).alias("GAPS"),
    )
    return infer_numeric(rows)


@_query
def q_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    text = (
        F.when(key % 6 == 0, "bad")
        .when(key % 6 == 1, F.date_format(at, "dd-MM-yyyy"))
        .when(key % 6 == 2, F.date_format(at, "yyyy/M/d"))
        .when(key % 6 == 3, F.concat(F.date_format(at, "yyyy-MM-dd"), F.lit("T05:00:00+03:00")))
        .when(key % 6 == 4, F.date_format(at, "M/d/yyyy"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf, "orders").select(
        key.alias("o_orderkey"), parse_date(text).alias("parsed")
    )


@_query
def q_nps_flags(spark: SparkSession, sf: str) -> DataFrame:
    return shape_nps(nps_raw_view(spark, sf)).select(
        LOAN_ID, "nps_score", "phone_locked", "payment_delay", "happy_device", "nps_category"
    )


# --- Features ----------------------------------------------------------------


def _snapshot_keys(spark: SparkSession, sf: str) -> DataFrame:
    return credit_view(spark, sf).select(LOAN_ID, "SNAPSHOT_DATE")


@_query
def q_age_features(spark: SparkSession, sf: str) -> DataFrame:
    dob = loan_sources(spark, sf).demographics["dob"]
    return add_age_features(_snapshot_keys(spark, sf), dob)


@_query
def q_income_features(spark: SparkSession, sf: str) -> DataFrame:
    income = loan_sources(spark, sf).demographics["income"]
    return add_income_features(_snapshot_keys(spark, sf), income)


@_query
def q_gender_flag(spark: SparkSession, sf: str) -> DataFrame:
    gender = loan_sources(spark, sf).demographics["gender"]
    return add_gender_features(_snapshot_keys(spark, sf), gender)


@_query
def q_collection_rate(spark: SparkSession, sf: str) -> DataFrame:
    credit = credit_view(spark, sf)
    rate = half_even(collection_rate(credit), 6)
    return credit.select(LOAN_ID, "SNAPSHOT_DATE", rate.alias("collection_rate"))


@_query
def q_early_arrears(spark: SparkSession, sf: str) -> DataFrame:
    credit = credit_view(spark, sf)
    return credit.select(LOAN_ID, "SNAPSHOT_DATE", arrears_flag(credit).alias("arrears"))


@_query
def q_loan_features(spark: SparkSession, sf: str) -> DataFrame:
    loans = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias(LOAN_ID))
    priced = add_sales_features(loans, sales_view(spark, sf)).withColumnsRenamed(
        {"Loan Price": "loan_price", "Cash Price": "cash_price", "Loan Term": "loan_term"}
    )
    return add_loan_features(priced).select(
        LOAN_ID, "loan_amount", "markup_ratio", "loan_term_months"
    )


@_query
def q_origination(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    history = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias(LOAN_ID),
        F.col("o_orderdate").alias("SNAPSHOT_DATE"),
        F.when(key % 3 != 0, F.col("o_totalprice")).alias("loan_price"),
        F.when(key % 4 != 0, F.col("o_totalprice") / 2).alias("cash_price"),
        F.when(key % 5 != 0, 6 + key % 3 * 6).cast("double").alias("loan_term"),
    )
    return first_known_per_loan(history, ["loan_price", "cash_price", "loan_term"])


@_query
def q_nps_features(spark: SparkSession, sf: str) -> DataFrame:
    loans = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias(LOAN_ID))
    return add_nps_features(loans, shape_nps(nps_raw_view(spark, sf)))


@_query
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    src = loan_sources(spark, sf)
    bands = last_demographics(src.credit, src.demographics)
    return encode_categoricals(bands.select(LOAN_ID, "age_band", "income_band"))


@_query
def q_early_agg(spark: SparkSession, sf: str) -> DataFrame:
    return early_features(credit_view(spark, sf), VIEW_CONFIG)


@_query
def q_dpd_trend(spark: SparkSession, sf: str) -> DataFrame:
    rows = measured(credit_view(spark, sf), EarlyDates(None).dates)
    return trend_by_date(rows).withColumnRenamed("early_dpd_trend", "dpd_trend")


@_query
def q_first_per_loan(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["Sale Date", "Cash Price", "Loan Price", "Loan Term"]
    first = first_per_loan(sales_view(spark, sf), columns)
    return first.toDF(LOAN_ID, "sale_date", "cash_price", "loan_price", "loan_term")


@_query
def q_last_demographics(spark: SparkSession, sf: str) -> DataFrame:
    src = loan_sources(spark, sf)
    return last_demographics(src.credit, src.demographics)


@_query
def q_feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf)


@_query
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    credit = credit_view(spark, sf)
    # One row per loan first: distinct loans and rows come from the same sums.
    per_loan = credit.groupBy(LOAN_ID).agg(F.count(F.lit(1)).alias("n"))
    return per_loan.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_loans"),
        F.lit(len(credit.columns)).cast("long").alias("n_columns"),
    )


@_query
def q_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    # Read twice, so it is computed once before.
    return exact_medians(cut_lineage(_features(spark, sf).select(*NUMERIC_FEATURES)), NUMERIC_FEATURES)


# --- Labels and splits -------------------------------------------------------


def _target_query(definition: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return define_target(credit_view(spark, sf), definition)

    return run


for _definition in TARGET_DEFINITIONS:
    QUERIES[f"q_target_{_definition}"] = _target_query(_definition)


@_query
def q_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf)


@_query
def q_bad_rate(spark: SparkSession, sf: str) -> DataFrame:
    summary = label_summary(define_target(credit_view(spark, sf), cfg=VIEW_CONFIG))
    return _rounded(summary, 6, "bad_rate")


@_query
def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = class_weights(define_target(credit_view(spark, sf), cfg=VIEW_CONFIG))
    return _rounded(weights, 6, "pos_weight", "weight_good", "weight_bad")


@_query
def q_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return mark_test(define_target(credit_view(spark, sf), cfg=VIEW_CONFIG), 0.2, 42)


@_query
def q_folds(spark: SparkSession, sf: str) -> DataFrame:
    return assign_folds(define_target(credit_view(spark, sf), cfg=VIEW_CONFIG), 5, 42)


# --- Scores ------------------------------------------------------------------


@_query
def q_pd_to_score(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long")
    p = (cents % 10001) / 10000
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", p.alias("p"), pd_to_score(p).alias("credit_score")
    )


@_query
def q_risk_band(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.floor(F.col("o_totalprice") * 100 + 0.5).cast("long")
    score = (280 + cents % 600).cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", score.alias("score"), risk_band(score).alias("risk_band")
    )


@_query
def q_score_table(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf)


@_query
def q_score_portfolio(spark: SparkSession, sf: str) -> DataFrame:
    return score_portfolio(SCORECARD, _features(spark, sf), refit_medians=True)


@_query
def q_score_requests(spark: SparkSession, sf: str) -> DataFrame:
    return score_requests(request_view(_features(spark, sf)), SCORECARD)


@_query
def q_batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    responses = score_requests(request_view(_features(spark, sf)), SCORECARD)
    return batch_summary(responses).select(
        "total", "avg_score", "avg_pd_pct", F.explode("band_counts").alias("risk_band", "n")
    )


@_query
def q_band_summary(spark: SparkSession, sf: str) -> DataFrame:
    return band_summary(_scores(spark, sf))


@_query
def q_score_summary(spark: SparkSession, sf: str) -> DataFrame:
    return score_summary(_scores(spark, sf))


@_query
def q_score_profile(spark: SparkSession, sf: str) -> DataFrame:
    return score_profile(_scores(spark, sf))


# --- Metrics -----------------------------------------------------------------


@_query
def q_ks(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.ks_statistic(_points(spark, sf)), 6, "ks_stat")


@_query
def q_auc(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.roc_auc(_points(spark, sf)), 6, "roc_auc")


@_query
def q_average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.average_precision(_points(spark, sf)), 6, "pr_auc")


@_query
def q_youden(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.optimal_threshold(_points(spark, sf)), 9, "threshold")


@_query
def q_roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    found = _rounded(curves.roc_curve(_points(spark, sf)), 6, "fpr", "tpr")
    return _rounded(found, 9, "threshold")


@_query
def q_pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    found = _rounded(curves.pr_curve(_points(spark, sf)), 6, "recall", "precision")
    return _rounded(found, 9, "threshold")


@_query
def q_ks_curve(spark: SparkSession, sf: str) -> DataFrame:
    names = ("population", "cum_bad_share", "cum_good_share")
    return _rounded(_rounded(curves.ks_curve(_points(spark, sf)), 6, *names), 9, "p")


@_query
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return confusion(_points(spark, sf))


@_query
def q_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(_points(spark, sf), "scorecard")


@_query
def q_metrics_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of unrounded probabilities over all line items, range by range."""
    scored = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 200000).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias(TARGET),
    )
    return evaluate(scored, model="price")


@_query
def q_class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = class_report(confusion(_points(spark, sf)))
    return _rounded(report, 6, "precision", "recall", "f1")


@_query
def q_calibration(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(calibration(_scored(spark, sf)), 6, "mean_predicted", "bad_share")


@_query
def q_pd_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(pd_histogram(_scored(spark, sf)), 8, "bin_low", "bin_high")


# --- Explanations ------------------------------------------------------------


def _attributed(spark: SparkSession, sf: str) -> DataFrame:
    # Read for the means and again for the rows, so it is computed once before.
    encoded = _encoded(spark, sf)
    rows = cut_lineage(encoded.select(LOAN_ID, *map(col, SCORECARD.features)))
    return SCORECARD.with_background(rows).add_attributions(rows)


@_query
def q_linear_attrib(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(long_form(_attributed(spark, sf), SCORECARD.features), 6, "value")


@_query
def q_linear_attrib_global(spark: SparkSession, sf: str) -> DataFrame:
    found = global_importance(_attributed(spark, sf), SCORECARD.features)
    return _rounded(found, 6, "mean_abs_shap")


def _listed(df: DataFrame, entries: str, *fields: str) -> DataFrame:
    """One row per array entry with its place."""
    rows = df.select(LOAN_ID, F.posexplode(entries).alias("place", "e"))
    return rows.select(LOAN_ID, (F.col("place") + 1).alias("place"), *[f"e.{f}" for f in fields])


@_query
def q_reason_codes(spark: SparkSession, sf: str) -> DataFrame:
    reasoned = add_reason_codes(_attributed(spark, sf), SCORECARD.features)
    return _listed(reasoned, "reason_codes", "code", "description", "direction", "shap")


def _explained(df: DataFrame, key: str, *kept: str) -> DataFrame:
    """One row per driver of an explanation, or one without a driver, with its place."""

    def placed(way: str):
        drivers = F.coalesce(f"{way}_drivers", F.array().cast("array<string>"))
        return F.transform(
            drivers,
            lambda text, i: F.struct(
                F.lit(way).alias("direction"), (i + 1).alias("place"), text.alias("driver")
            ),
        )

    drivers = F.explode_outer(F.concat(placed("positive"), placed("negative")))
    rows = df.select(key, *kept, drivers.alias("d"))
    return rows.select(key, *kept, "d.direction", "d.place", "d.driver")


@_query
def q_explain_portfolio(spark: SparkSession, sf: str) -> DataFrame:
    """Score, band and drivers in words of every loan, measured from the mean loan."""
    features = cut_lineage(_features(spark, sf))
    model = SCORECARD.with_background(encode_categoricals(features))
    found = explain_portfolio(model, features)
    return _explained(found, LOAN_ID, "credit_score", "risk_band", "pd_pct")


@_query
def q_score_requests_explained(spark: SparkSession, sf: str) -> DataFrame:
    """Every request's answer with its drivers; failed ones have none."""
    found = score_requests(request_view(_features(spark, sf)), SCORECARD, explain=True)
    return _explained(found, "loan_id", "pd_score", "credit_score", "risk_band")


@_query
def q_early_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Early features where no snapshot has an early date: all snapshots count."""
    cfg = VIEW_CONFIG.with_(early_snapshots=("1900-01-01",), early_fallback=True)
    return early_features(credit_view(spark, sf), cfg)


@_query
def q_merge_target(spark: SparkSession, sf: str) -> DataFrame:
    """Features joined with labels of late snapshots only, and how many loans that drops."""
    features = _features(spark, sf).select(LOAN_ID, "early_max_dpd", "loan_amount")
    target = define_target(credit_view(spark, sf), "par30", label_snapshots=("2001-12-31",))
    dropped = dropped_loans(features, target).agg(F.count(F.lit(1)).alias("n_dropped"))
    return merge_target(features, target).withColumn("n_dropped", dropped.scalar())


@_query
def q_fallback_reasons(spark: SparkSession, sf: str) -> DataFrame:
    reasons = fallback_reasons(_encoded(spark, sf))
    both = F.array(
        *[
            F.struct(F.lit(way).alias("direction"), F.col(f"{way}_drivers").alias("drivers"))
            for way in ("positive", "negative")
        ]
    )
    per_direction = reasons.select(LOAN_ID, F.inline(both))
    rows = per_direction.select(LOAN_ID, "direction", F.posexplode("drivers").alias("place", "e"))
    place = (F.col("place") + 1).alias("place")
    return rows.select(LOAN_ID, "direction", place, "e.code", "e.description", "e.value")


# --- Models and streams ------------------------------------------------------


def train_score(spark: SparkSession, sf: str, cfg: Config = VIEW_CONFIG) -> DataFrame:
    """The whole training: split, folds of every candidate, refit of the best; all loans scored.

    Not registered: at production sizes it is 10,000 rounds of boosting (see the README).
    """
    result = train(_labelled(spark, sf), cfg)
    return score_portfolio(result.model, result.labelled, cfg)


def _forest(spark: SparkSession, sf: str, cfg: Config) -> tuple[TrainedModel, DataFrame]:
    """A forest fitted on all labelled loans, and their complete features."""
    rows, features, medians = prepare_xy(cut_lineage(_labelled(spark, sf)))
    rows = cut_lineage(spread(rows))
    return fit_candidate(rows, features, "forest", cfg, medians), rows


@_query
def ml_tree_attrib(spark: SparkSession, sf: str, cfg: Config = VIEW_CONFIG) -> DataFrame:
    """Global attribution of a forest over all labelled loans."""
    model, rows = _forest(spark, sf, cfg)
    return compute_shap(model, rows)


@_query
def ml_tree_additive(spark: SparkSession, sf: str, cfg: Config = VIEW_CONFIG) -> DataFrame:
    """Per loan, whether base value and attributions of a forest add up to its probability."""
    model, rows = _forest(spark, sf, cfg)
    trees = packed_trees(model.classifier)
    found = model.add_attributions(model.add_probability(rows), trees=trees)
    total = F.aggregate(ATTRIBUTIONS, F.lit(base_value(trees)), lambda a, v: a + v)
    return found.select(
        LOAN_ID,
        F.size(ATTRIBUTIONS).alias("n_features"),
        (F.abs(total - F.col("p")) < 1e-6).alias("additive"),
    )


@_query
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """All requests as JSON files, scored by the streaming job."""
    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    request_view(_features(spark, sf)).write.json(f"{folder}/in")
    stream = score_requests_stream(
        read_request_stream(spark, f"{folder}/in"), SCORECARD, f"{folder}/out", f"{folder}/state"
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")
