import pytest
from pyspark.sql import functions as F

from loanlens.config import AGE_BAND_COLUMNS, INCOME_BAND_COLUMNS, REASON_CODES, RISK_BANDS
from loanlens.operators.attribution import (
    add_reason_codes,
    explain,
    fallback_reasons,
    global_importance,
    long_form,
)
from loanlens.operators.scorecard import Scorecard
from loanlens.operators.scoring import (
    add_scores,
    band_summary,
    batch_summary,
    explain_portfolio,
    request_features,
    score_dataframe,
    score_portfolio,
    score_profile,
    score_requests,
    score_summary,
)

CARD = Scorecard(-1.0, {"early_max_dpd": 0.1, "nps_score": -0.2, "age_band_18-25": 0.5})


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("1", 0.0001, 819, "Excellent"), ("2", 0.3, 578, "Risky"), ("3", 0.9, 490, "High Risk"), ("4", 0.1, 490, "High Risk")]
    return spark.createDataFrame(rows, "LOAN_ID string, pd_score double, credit_score int, risk_band string")


def test_scored_rows(spark):
    df = spark.createDataFrame([("1", 20.0, None, 1)], "LOAN_ID string, early_max_dpd double, nps_score double, `age_band_18-25` int")
    row = score_dataframe(CARD, df).first()
    # Log-odds -1 + 2 + 0.5 = 1.5.
    assert (row.pd_score, row.credit_score, row.risk_band) == (0.8176, 510, "Risky")


def test_the_score_uses_the_unrounded_probability(spark):
    df = spark.createDataFrame([("1", 0.00004)], "LOAN_ID string, p double")
    row = add_scores(df).first()
    assert row.pd_score == 0.0 and row.credit_score == 846


def test_portfolio_medians(spark):
    rows = [("1", 10.0, "18-25"), ("2", None, None), ("3", 30.0, None)]
    df = spark.createDataFrame(rows, "LOAN_ID string, early_max_dpd double, age_band string")
    kept = Scorecard(0.0, {"early_max_dpd": 0.1}, medians={"early_max_dpd": 0.0})
    stored = {r.LOAN_ID: r.pd for r in score_portfolio(kept, df).collect()}
    refit = {r.LOAN_ID: r.pd for r in score_portfolio(kept, df, refit_medians=True).collect()}
    assert stored["2"] == 0.5 and refit["2"] == 0.8808 and stored["1"] == refit["1"]


def request_frame(spark, **fields):
    names = list(fields)
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(fields[n] for n in names)], schema)


def test_request_defaults_and_bands(spark):
    row = request_features(request_frame(spark, loan_id="r", age_years="25")).first()
    assert row["n_snapshots_early"] == 3 and row["early_max_dpd"] == 0 and not row["failed"]
    assert [row[c] for c in AGE_BAND_COLUMNS] == [1, 0, 0, 0, 0]
    # An income of 0, the default, belongs to the lowest band; an age of 0 to none.
    assert [row[c] for c in INCOME_BAND_COLUMNS][0] == 1
    ageless = request_features(request_frame(spark, loan_id="r")).first()
    assert sum(ageless[c] for c in AGE_BAND_COLUMNS) == 0


@pytest.mark.parametrize("field, value", [("early_max_dpd", "abc"), ("is_male", "0.5")])
def test_failed_requests(spark, field, value):
    row = score_requests(request_frame(spark, loan_id="r", **{field: value}), CARD, explain=True).first()
    assert (row.loan_id, row.pd_score, row.pd_pct, row.credit_score, row.risk_band) == (
        "r", 0.0, "Error", 0, "Error",
    )
    assert row.positive_drivers is None


def test_explained_requests(spark):
    row = score_requests(request_frame(spark, loan_id="r", early_max_dpd="20", nps_score="8"), CARD, explain=True).first()
    assert row.pd_pct == "35.43%" and row.pd_score == 0.3543
    assert row.positive_drivers[0] == "✓ Customer satisfaction score"
    assert row.negative_drivers[0] == "✗ High early delinquency detected"


def test_band_summary(scores):
    got = [tuple(r) for r in band_summary(scores).collect()]
    assert got == [("Excellent", 1, 0.01, 25.0), ("Risky", 1, 30.0, 25.0), ("High Risk", 2, 50.0, 50.0)]
    renamed = scores.withColumnsRenamed({"pd_score": "pd", "credit_score": "score"})
    assert [tuple(r) for r in band_summary(renamed).collect()] == got


def test_score_summary(scores):
    got = {r.risk_band: r for r in score_summary(scores).collect()}
    assert list(got) == [label for label, _, _ in RISK_BANDS]
    assert (got["Good"]["count"], got["Good"].pct, got["Good"].avg_pd) == (0, 0.0, 0.0)
    assert (got["High Risk"]["count"], got["High Risk"].score_range) == (2, "300–499")
    empty = score_summary(scores.limit(0)).collect()
    assert [r["count"] for r in empty] == [0] * 5 and empty[0].pct == 0


def test_batch_summary(spark, scores):
    failed = spark.createDataFrame([("5", 0.0, 0, "Error")], scores.schema)
    row = batch_summary(scores.union(failed)).first()
    assert (row.total, row.avg_score, row.avg_pd_pct) == (5, 594.2, "32.50%")
    assert row.band_counts == {"Excellent": 1, "Risky": 1, "High Risk": 2, "Error": 1}
    nothing = batch_summary(failed).first()
    assert (nothing.avg_score, nothing.avg_pd_pct) == (0.0, "0%")
    assert tuple(score_profile(scores).first()) == (4, 594.0, 32.5)


FEATURES = ["early_max_dpd", "nps_score", "new_one", "is_male", "loan_amount"]


def with_attributions(spark, *rows):
    return spark.createDataFrame(
        [(str(i), [float(v) for v in r]) for i, r in enumerate(rows)], "LOAN_ID string, attributions array<double>"
    )


def codes_of(df, **options):
    reasoned = add_reason_codes(df, FEATURES, **options)
    return [[(c.code, c.direction, c.shap) for c in r.reason_codes] for r in reasoned.collect()]


def test_drivers(spark):
    df = with_attributions(spark, [0.5, -0.25, 0.0005, 0.3, 0.1])
    assert codes_of(df, n=2) == [
        [("nps_score", "positive", -0.25), ("early_max_dpd", "negative", 0.5), ("is_male", "negative", 0.3)]
    ]
    # Without the sign rule a hurting feature may be listed as helping.
    assert ("loan_amount", "positive", 0.1) in codes_of(df, n=3)[0]
    assert codes_of(df, n=4, strict_sign=True)[0][0] == ("nps_score", "positive", -0.25)
    assert [c[1] for c in codes_of(df, n=4, strict_sign=True)[0]].count("positive") == 1


def test_equal_drivers_keep_the_feature_order(spark):
    df = with_attributions(spark, [0.2, 0.2, 0.2, 0.2, 0.2])
    names = [c[0] for c in codes_of(df, n=2)[0]]
    assert names == FEATURES[:2] * 2


def test_explanation(spark):
    df = with_attributions(spark, [0.5, -0.25, 0.0, 0.0, 0.0]).withColumns(
        {"pd_score": F.lit(0.0481), "credit_score": F.lit(640), "risk_band": F.lit("Fair")}
    )
    row = explain(df, FEATURES).first()
    assert (row.pd_pct, row.credit_score, row.risk_band) == ("4.81%", 640, "Fair")
    assert row.positive_drivers == ["✓ Customer satisfaction score"]
    assert row.negative_drivers == ["✗ High early delinquency detected"]
    assert row.reason_codes[0].shap == -0.25


def test_global_importance(spark):
    df = with_attributions(spark, [1.0, -3.0, 0, 0, 0], [-1.0, 1.0, 0, 0, 0])
    got = [tuple(r) for r in global_importance(df, FEATURES, top=2).collect()]
    assert got == [("nps_score", 2.0), ("early_max_dpd", 1.0)]
    assert long_form(df, FEATURES).count() == 10


def test_linear_attributions_sum_to_the_margin(spark):
    rows = [(str(i), float(i), float(i % 11), i % 2) for i in range(50)]
    df = spark.createDataFrame(rows, "LOAN_ID string, early_max_dpd double, nps_score double, `age_band_18-25` int")
    card = CARD.with_background(df)
    mean_margin = df.agg(F.avg(card.log_odds(df))).first()[0]
    total = F.aggregate("attributions", F.lit(0.0), lambda a, b: a + b)
    out = card.add_attributions(df.withColumn("m", card.log_odds(df))).select("m", total.alias("t"))
    assert all(r.m == pytest.approx(mean_margin + r.t) for r in out.collect())


def test_rule_based_reasons(spark):
    values = {"early_max_dpd": 5.0, "early_avg_dpd": 5.0, "early_dpd_std": -1.0, "loan_amount": 9.0,
              "is_male": 1.0, "nps_score": None, "age_years": 0.0, "n_snapshots_early": 3.0}
    schema = "LOAN_ID string, " + ", ".join(f"{n} double" for n in values)
    row = fallback_reasons(spark.createDataFrame([("1", *values.values())], schema)).first()
    assert [(d.code, d.value) for d in row.negative_drivers] == [("early_max_dpd", 5.0), ("early_avg_dpd", 5.0)]
    assert [d.code for d in row.positive_drivers] == ["loan_amount", "n_snapshots_early"]
    assert row.positive_drivers[0].description == REASON_CODES["loan_amount"][0]


def test_explaining_needs_no_shuffle(spark, tmp_path):
    df = spark.range(10).select(F.col("id").cast("string").alias("LOAN_ID"), F.col("id").cast("double").alias("early_max_dpd"))
    plan = explain_portfolio(CARD, df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
