import re

import pytest
from pyspark.sql import functions as F

from loanlens import build_feature_matrix, build_labelled_matrix, define_target, merge_target
from loanlens.config import MODEL_FEATURES
from loanlens.operators.borrowers import (
    add_age_features,
    add_gender_features,
    add_income_features,
    add_loan_features,
    add_nps_features,
    add_sales_features,
)
from loanlens.operators.encode import encode_categoricals, get_model_features
from tests.conftest import rows_by_loan

LOANS = ["A", "B", "D", "X"]


@pytest.fixture
def loans(spark):
    return spark.createDataFrame([(n, "2025-01-01") for n in LOANS], "LOAN_ID string, SNAPSHOT_DATE string")


@pytest.fixture(scope="session")
def demographics(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "dob": frame(
            [("A", "2000-01-01", 1), ("A", "1950-01-01", 2), ("B", None, 1)],
            "LOAN_ID string, date_of_birth string, _ingest_order int",
        ),
        "income": frame(
            [("A", 30000.0, 6.0, 1), ("B", -6.0, 6.0, 1), ("D", 9000.0, 0.0, 1), ("A", 1.0, 1.0, 2)],
            "LOAN_ID string, Received double, Duration double, _ingest_order int",
        ),
        "gender": frame(
            [("A", " Male ", 1), ("B", "F", 1), ("D", "other", 1), ("A", "F", 2)],
            "LOAN_ID string, Gender string, _ingest_order int",
        ),
        "sales": frame(
            [("A", 100.0, 150.0, 12.0, 1), ("B", 0.0, 10.0, 6.0, 1)],
            "LOAN_ID string, `Cash Price` double, `Loan Price` double, `Loan Term` double, _ingest_order int",
        ),
    }


@pytest.fixture(scope="session")
def nps(spark):
    return spark.createDataFrame(
        [("A", 9.0, 1.0, 1), ("A", 2.0, 0.0, 2), ("B", 6.0, None, 1), ("D", 8.0, 0.0, 1)],
        "LOAN_ID string, nps_score double, phone_locked double, _ingest_order int",
    )


def test_age(loans, demographics):
    got = rows_by_loan(add_age_features(loans, demographics["dob"]))
    assert (got["A"]["age_years"], got["A"]["age_band"]) == (25.0, "18-25")
    assert got["B"]["age_years"] is None and got["B"]["age_band"] is None
    assert got["X"]["age_band"] is None
    missing = rows_by_loan(add_age_features(loans, None))
    assert (missing["A"]["age_years"], missing["A"]["age_band"]) == (None, "Unknown")


def test_income(loans, demographics):
    got = rows_by_loan(add_income_features(loans, demographics["income"]))
    assert (got["A"]["avg_monthly_income"], got["A"]["income_band"]) == (5000.0, "5K-10K")
    assert (got["B"]["avg_monthly_income"], got["B"]["income_band"]) == (-1.0, None)
    assert got["D"]["avg_monthly_income"] is None
    assert rows_by_loan(add_income_features(loans, None))["A"]["income_band"] == "Unknown"


def test_gender(loans, demographics):
    got = rows_by_loan(add_gender_features(loans, demographics["gender"]))
    assert [got[n]["is_male"] for n in LOANS] == [1.0, 0.0, None, None]
    assert rows_by_loan(add_gender_features(loans, None))["A"]["is_male"] is None


def test_sales_replace_columns_of_the_snapshots(loans, demographics):
    own = loans.withColumn("Loan Price", F.lit(1.0))
    got = rows_by_loan(add_sales_features(own, demographics["sales"]))
    assert got["A"]["Loan Price"] == 150.0 and got["X"]["Loan Price"] is None
    assert add_sales_features(loans, None) is loans


def test_nps(loans, nps):
    got = rows_by_loan(add_nps_features(loans, nps))
    names = ("nps_score", "phone_locked", "is_promoter", "is_detractor")
    assert [tuple(got[n][c] for c in names) for n in LOANS] == [
        (9.0, 1.0, 1.0, 0.0),
        (6.0, None, 0.0, 1.0),
        (8.0, 0.0, 0.0, 0.0),
        (None, None, 0.0, 0.0),
    ]
    none = rows_by_loan(add_nps_features(loans, None))["A"]
    assert none["is_promoter"] is None and none["payment_delay"] is None
    unscored = rows_by_loan(add_nps_features(loans, nps.drop("nps_score")))["A"]
    assert unscored["is_promoter"] is None


def test_loan_features(spark):
    df = spark.createDataFrame(
        [("1", "150", "100", "12"), ("2", "10", "0", "x"), ("3", None, "5", None)],
        "LOAN_ID string, loan_price string, cash_price string, loan_term string",
    )
    got = rows_by_loan(add_loan_features(df))
    names = ("loan_amount", "markup_ratio", "loan_term_months")
    assert [tuple(got[k][n] for n in names) for k in "123"] == [
        (150.0, 0.5, 12.0), (10.0, None, None), (None, None, None),
    ]
    # Which column gives the amount is decided by its presence, not by its values.
    both = df.withColumn("LOAN_AMOUNT", F.lit(9.0))
    assert rows_by_loan(add_loan_features(both))["3"]["loan_amount"] is None
    upper = rows_by_loan(add_loan_features(both.drop("loan_price")))["3"]
    assert upper["loan_amount"] == 9.0
    bare = rows_by_loan(add_loan_features(df.select("LOAN_ID")))["1"]
    assert bare["loan_amount"] is None and bare["markup_ratio"] is None


def test_matrix(credit, demographics, nps):
    got = rows_by_loan(build_feature_matrix(credit, demographics, nps))
    assert set(got) == {"A", "B", "D"}
    a = got["A"]
    # The age is taken at the last snapshot, 2025-12-30.
    assert (a["age_years"], a["age_band"]) == (26.0, "26-35")
    assert (a["loan_price"], a["markup_ratio"], a["loan_term_months"]) == (150.0, 0.5, 12.0)
    assert (a["early_dpd_trend"], a["is_male"], a["is_promoter"]) == (10.0, 1.0, 1.0)


def test_matrix_without_any_borrower_table(credit):
    row = rows_by_loan(build_feature_matrix(credit))["A"]
    assert (row["age_band"], row["income_band"]) == ("Unknown", "Unknown")
    assert row["loan_amount"] is None and row["is_promoter"] is None


def test_origination_from_the_snapshots(spark, credit):
    price = F.when(F.col("SNAPSHOT_DATE") > "2025-01-01", F.month("SNAPSHOT_DATE").cast("string"))
    got = rows_by_loan(build_feature_matrix(credit.withColumn("Loan Price", price)))
    assert got["A"]["loan_amount"] == 3.0 and got["B"]["loan_amount"] == 6.0


def test_one_pass_equals_features_merged_with_labels(credit, demographics, nps):
    merged = merge_target(build_feature_matrix(credit, demographics, nps), define_target(credit))
    assert rows_by_loan(build_labelled_matrix(credit, demographics, nps)) == rows_by_loan(merged)


def test_matrix_shuffles_every_input_once(spark, credit, demographics, nps, tmp_path):
    tables = {}
    for name, df in {"credit": credit, "nps": nps, **demographics}.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nps_table = tables.pop("nps")
        matrix = build_labelled_matrix(tables.pop("credit"), tables, nps_table)
        plan = matrix._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Six tables; the survey's texts are fetched by loan and place, which takes three more.
    assert len(re.findall("Exchange hashpartitioning", plan)) == 9
    assert "Broadcast" not in plan and "Python" not in plan


def test_indicators(spark):
    df = spark.createDataFrame([("1", "55+", None), ("2", "Unknown", "150K+")], "LOAN_ID string, age_band string, income_band string")
    out = encode_categoricals(df)
    assert len(out.columns) == 14
    got = rows_by_loan(out)
    assert got["1"]["age_band_55+"] == 1 and sum(v for k, v in got["1"].items() if k != "LOAN_ID") == 1
    assert got["2"]["income_band_150K+"] == 1 and got["2"]["age_band_55+"] == 0


def test_choice_of_features(credit):
    columns = encode_categoricals(build_feature_matrix(credit)).columns
    assert get_model_features(columns) == list(MODEL_FEATURES)
    assert get_model_features(["par90_ever", "age_years", "x"]) == ["age_years"]
