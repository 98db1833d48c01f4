import pytest
from pyspark.sql import functions as F

from loanlens.config import Config
from loanlens.functions import (
    age_band,
    clean_headers,
    find_column,
    income_band,
    normalise_loan_id,
    number,
    number_or,
    parse_date,
    pd_to_score,
    percent_text,
    ratio,
    reason_text,
    risk_band,
    wall_clock,
    yes_no,
)
from loanlens.functions.naming import loan_id_column
from loanlens.functions.values import clamp, half_even, male_flag, time_key


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_number_of_text(spark):
    df = column(spark, [" 12 ", "1e3", "1,000", "nan", "12d", "3F", "", None, "-.5", "abc"])
    assert evaluate(df, number(df, "v")) == [
        12.0, 1000.0, None, None, None, None, None, None, -0.5, None,
    ]


def test_number_of_other_types(spark):
    df = column(spark, [1.5, float("nan"), None], "double")
    assert evaluate(df, number(df, "v")) == [1.5, None, None]
    df = column(spark, [True, False, None], "boolean")
    assert evaluate(df, number(df, "v")) == [1.0, 0.0, None]
    assert evaluate(df, number_or(df, "absent", 7)) == [7.0, 7.0, 7.0]


def test_ratio_and_clamp(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 0.0), (1, 3.0, 2.0), (2, None, 2.0), (3, -1.0, 2.0)], "i int, a double, b double"
    )
    rate = clamp(ratio(F.col("a"), F.col("b")), 0, 1)
    assert evaluate(df, rate) == [None, 1.0, None, 0.0]


def test_rounding_is_half_even(spark):
    df = column(spark, [0.25, 0.35, -0.25, 2.5], "double")
    assert evaluate(df, half_even(F.col("v"), 1)) == [0.2, 0.4, -0.2, 2.5]
    assert evaluate(df, half_even(F.col("v")))[-1] == 2.0


def test_dates(spark):
    df = column(
        spark,
        ["2025-01-01T05:00:00+03:00", "31/12/1990", "1990/2/3", "2-3-1990", "bad", None, "5/6/1990"],
    )
    got = [None if d is None else d.isoformat() for d in evaluate(df, parse_date(F.col("v")))]
    assert got == [
        "2025-01-01T05:00:00",
        "1990-12-31T00:00:00",
        "1990-02-03T00:00:00",
        "1990-03-02T00:00:00",
        None,
        None,
        "1990-05-06T00:00:00",
    ]


def test_time_key_orders_like_the_clock(spark):
    texts = ["1969-12-31 23:59:59.999999", "1970-01-01", "2025-01-01 00:00:00.000001", "2025-01-01"]
    df = column(spark, texts)
    assert evaluate(df, time_key(wall_clock(F.col("v")))) == [
        -1, 0, 1735689600000001, 1735689600000000,
    ]


def test_flags(spark):
    df = column(spark, [" Yes ", "TRUE", "1", "no", "False", "0", "x", None])
    assert evaluate(df, yes_no(F.col("v"))) == [1.0, 1.0, 1.0, 0.0, 0.0, 0.0, None, None]
    df = column(spark, [" Male ", "m", "F", "female", "other", None])
    assert evaluate(df, male_flag(F.col("v"))) == [1.0, 1.0, 0.0, 0.0, None, None]


def test_band_edges(spark):
    df = column(spark, [0.0, 0.1, 25.0, 25.1, 55.0, 200.0, 200.1, None], "double")
    assert evaluate(df, age_band(F.col("v"))) == [
        None, "18-25", "18-25", "26-35", "46-55", "55+", None, None,
    ]
    df = column(spark, [-1.0, 0.0, 4999.0, 5000.0, 149999.0, 150000.0, 1e12, None], "double")
    assert evaluate(df, income_band(F.col("v"))) == [
        None, "Below 5K", "Below 5K", "5K-10K", "100K-150K", "150K+", "150K+", None,
    ]


def test_scores(spark):
    values = [0.0, 0.0001, 0.01, 0.05, 0.3, 0.9, 1.0, None]
    df = column(spark, values, "double")
    assert evaluate(df, pd_to_score(F.col("v"))) == [850, 819, 686, 639, 578, 490, 300, None]
    doubled = pd_to_score(F.col("v"), Config(pdo=40, base_score=500, base_odds=1.0))
    assert evaluate(column(spark, [0.5], "double"), doubled) == [500]


def test_scores_never_rise_with_the_probability(spark):
    df = spark.range(1001).select(F.col("id").alias("i"), (F.col("id") / 1000).alias("v"))
    scores = evaluate(df, pd_to_score(F.col("v")))
    assert all(a >= b for a, b in zip(scores, scores[1:]))


def test_risk_bands(spark):
    df = column(spark, [850, 800, 799, 700, 699, 600, 500, 499, 300, 299, 851], "int")
    assert evaluate(df, risk_band(F.col("v"))) == [
        "Excellent", "Excellent", "Good", "Good", "Fair", "Fair", "Risky",
        "High Risk", "High Risk", "Unknown", "Unknown",
    ]


def test_texts(spark):
    df = column(spark, [0.04811, 1.0], "double")
    assert evaluate(df, percent_text(F.col("v"))) == ["4.81%", "100.00%"]
    assert reason_text("early_max_dpd") == "High early delinquency detected"
    assert reason_text("some_new_feature") == "Some New Feature"


def test_headers(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], [" Loan ID ", "a", " ", " a"])
    assert clean_headers(df).columns == ["Loan ID", "a", "a_1"]
    assert find_column(["x", "Cash_Price KES"], "cash", "price") == "Cash_Price KES"
    assert find_column(["x"], "cash") is None
    assert loan_id_column(["LOAN_PAID", "LOAN_ID"]) == "LOAN_ID"
    assert loan_id_column(["LOAN_PAID"]) == "LOAN_PAID"


def test_loan_ids(spark):
    df = spark.createDataFrame([(" 1 ",), ("nan",), (None,)], ["My loan Id"])
    assert [r.LOAN_ID for r in normalise_loan_id(df).collect()] == ["1"]
    with pytest.raises(KeyError):
        normalise_loan_id(spark.createDataFrame([(1,)], ["x"]))


def test_config():
    cfg = Config.from_env({"PDO": "40", "TARGET_DEFINITION": "par60", "TEST_SIZE": "0.3"})
    assert (cfg.pdo, cfg.target_definition, cfg.test_size, cfg.seed) == (40, "par60", 0.3, 42)
    with pytest.raises(ValueError):
        Config(target_definition="par45")
