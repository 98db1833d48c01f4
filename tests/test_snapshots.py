import random
import re
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loanlens.config import Config
from loanlens.operators.first_last import (
    first_known_per_loan,
    first_per_loan,
    last_known_per_loan,
)
from loanlens.operators.snapshots import (
    EarlyDates,
    compute_snapshot_features,
    early_features,
    loan_aggregate,
    measured,
    trend_by_date,
)
from loanlens.operators.target import define_target, dropped_loans, label_summary, merge_target
from loanlens.plans.catalog import QUERIES
from tests.conftest import rows_by_loan

EXPECTED = {
    "A": (20, 10.0, 10.0, 1, 0.917, 0.75, 0.144, 3, 10.0),
    "B": (0, 0.0, 0.0, 0, None, None, 0.0, 1, 0.0),
    "D": (35, 35.0, 0.0, 1, 0.25, 0.25, 0.0, 2, -35.0),
}
NAMES = (
    "early_max_dpd early_avg_dpd early_dpd_std early_had_arrears early_avg_collection_rate "
    "early_min_collection_rate early_std_collection_rate n_snapshots_early early_dpd_trend"
).split()


def values(df):
    return {loan: tuple(row[n] for n in NAMES) for loan, row in rows_by_loan(df).items()}


def test_early_features(credit):
    assert values(early_features(credit)) == EXPECTED
    assert values(compute_snapshot_features(credit)) == EXPECTED


def test_row_order_and_partitions_do_not_matter(credit):
    for n, seed in ((1, 1), (7, 2)):
        shuffled = credit.orderBy(F.rand(seed)).repartition(n)
        assert values(early_features(shuffled)) == EXPECTED


def test_columns_may_be_missing(credit):
    bare = credit.select("LOAN_ID", "SNAPSHOT_DATE")
    assert values(early_features(bare))["A"] == (0, 0.0, 0.0, 0, None, None, 0.0, 3, 0.0)


def test_every_snapshot_counts_without_early_ones(credit):
    late = Config(early_snapshots=("1990-01-01",))
    got = values(early_features(credit, late))
    assert got["A"][7:] == (4, 10.0) and got["C"][0] == 61
    none = Config(early_snapshots=("1990-01-01",), early_fallback=False)
    assert values(early_features(credit, none)) == {}


def test_time_zones_are_dropped(spark):
    df = spark.createDataFrame(
        [("Z", "2025-01-01T00:00:00+03:00", "4")],
        "LOAN_ID string, SNAPSHOT_DATE string, DAYS_PAST_DUE string",
    )
    assert values(early_features(df))["Z"][0] == 4


def brute_force(rows):
    """Early features of ``{loan: [(date position, dpd)]}`` with plain Python."""
    out = {}
    for loan, points in rows.items():
        points = sorted(points)
        ys = [y for _, y in points]
        n = len(ys)
        by_date = {}
        for position, (date, _) in enumerate(points):
            by_date.setdefault(date, []).append(position)
        xs = [statistics.mean(by_date[date]) for date, _ in points]
        mean = (n - 1) / 2
        spread = sum((i - mean) ** 2 for i in range(n))
        trend = sum((x - mean) * y for x, y in zip(xs, ys)) / spread if n > 1 else 0.0
        out[loan] = (
            max(ys),
            statistics.mean(ys),
            statistics.stdev(ys) if n > 1 else 0.0,
            n,
            trend,
        )
    return out


def test_hot_loan_and_repeated_dates_against_brute_force(spark):
    """A third of all rows belongs to one loan, with many rows per date."""
    rng = random.Random(5)
    dates = ("2025-01-01", "2025-03-31", "2025-06-30")
    rows, by_loan = [], {}
    for i in range(3000):
        loan = "hot" if i % 3 == 0 else str(rng.randrange(700))
        date, dpd = rng.choice(dates), float(rng.randrange(90))
        rows.append((loan, date, dpd))
        by_loan.setdefault(loan, []).append((date, dpd))
    df = spark.createDataFrame(rows, "LOAN_ID string, SNAPSHOT_DATE string, DAYS_PAST_DUE double")
    expected = brute_force(by_loan)
    got = rows_by_loan(early_features(df))
    assert set(got) == set(expected)
    trends = rows_by_loan(trend_by_date(measured(df, None)))
    for loan, (top, mean, deviation, n, trend) in expected.items():
        row = got[loan]
        assert row["early_max_dpd"] == top and row["n_snapshots_early"] == n
        assert row["early_avg_dpd"] == pytest.approx(mean, abs=0.051)
        assert row["early_dpd_std"] == pytest.approx(deviation, abs=0.0051)
        assert row["early_dpd_trend"] == pytest.approx(trend, abs=0.00051)
        assert trends[loan]["early_dpd_trend"] == row["early_dpd_trend"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_and_hash_aggregation_only(spark, credit, tmp_path):
    path = str(tmp_path / "credit")
    credit.write.parquet(path)
    stored = spark.read.parquet(path)
    both = loan_aggregate(stored, EarlyDates(Config().early_snapshots), "combined")
    plan = plan_of(both)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SortAggregate" not in plan and "Window" not in plan and "Python" not in plan
    assert "ReadSchema" in plan


def test_dates_reach_the_scan(spark, credit, tmp_path):
    path = str(tmp_path / "credit")
    dated = credit.withColumn("SNAPSHOT_DATE", F.col("SNAPSHOT_DATE").cast("date"))
    dated.write.parquet(path)
    plan = early_features(spark.read.parquet(path), Config(early_fallback=False))
    pushed = re.search(r"PushedFilters: \[[^]]*\]", plan_of(plan)).group(0)
    assert "SNAPSHOT_DATE" in pushed


LABELS = {
    "par30": {"A": 0, "B": 1, "C": 1, "D": 0},
    "par60": {"A": 0, "B": 0, "C": 1, "D": 0},
    "par90": {"A": 0, "B": 0, "C": 0, "D": 0},
    "fpd_fmd": {"A": 0, "B": 1, "C": 0, "D": 0},
    "combined": {"A": 0, "B": 1, "C": 1, "D": 0},
}


@pytest.mark.parametrize("definition", LABELS)
def test_labels(credit, definition):
    got = {loan: r["target"] for loan, r in rows_by_loan(define_target(credit, definition)).items()}
    assert got == LABELS[definition]


def test_label_options(spark, credit):
    with pytest.raises(ValueError):
        define_target(credit, "par45")
    late = define_target(credit, "par30", label_snapshots=("2025-12-30",))
    assert set(rows_by_loan(late)) == {"A", "B"}
    bare = credit.select("LOAN_ID", "SNAPSHOT_DATE")
    assert {r.target for r in define_target(bare).collect()} == {0}
    padded = spark.createDataFrame(
        [("P", "2025-01-01", " FPD")], "LOAN_ID string, SNAPSHOT_DATE string, ACCOUNT_STATUS_L2 string"
    )
    assert define_target(padded, "fpd_fmd").first().target == 0


def test_worse_of_two_rows_on_the_same_date(spark):
    rows = [("T", "2025-01-01", "FPD", 0.0), ("T", "2025-01-01", "Active", 40.0)]
    df = spark.createDataFrame(
        rows, "LOAN_ID string, SNAPSHOT_DATE string, ACCOUNT_STATUS_L2 string, DAYS_PAST_DUE double"
    )
    assert define_target(df, "fpd_fmd").first().target == 1
    assert define_target(df, "par30").first().target == 1


def test_merge_and_summary(credit):
    features, target = early_features(credit), define_target(credit)
    merged = merge_target(features, target)
    assert {r.LOAN_ID for r in merged.collect()} == {"A", "B", "D"}
    assert dropped_loans(features, target).count() == 0
    assert dropped_loans(target, features).first().LOAN_ID == "C"
    row = label_summary(target).first()
    assert (row.n_loans, row.n_bad, row.n_good, row.bad_rate) == (4, 2, 2, 0.5)


def test_first_and_last_known(spark):
    rows = [
        ("1", "2025-01-01", None, 5),
        ("1", "2025-02-01", "b", None),
        ("1", "2025-03-01", "c", None),
        ("2", "2025-01-01", None, None),
    ]
    df = spark.createDataFrame(rows, "LOAN_ID string, SNAPSHOT_DATE string, s string, n int")
    first, last = (rows_by_loan(f(df, ["s", "n"])) for f in (first_known_per_loan, last_known_per_loan))
    assert (first["1"]["s"], first["1"]["n"]) == ("b", 5)
    assert (last["1"]["s"], last["1"]["n"]) == ("c", 5)
    assert first["2"]["s"] is None and last["2"]["n"] is None


def test_first_row_keeps_its_gaps(spark):
    rows = [("1", 2, "x", 1), ("1", 1, None, 9), ("2", 1, "y", 3)]
    df = spark.createDataFrame(rows, "LOAN_ID string, place int, a string, b int")
    got = rows_by_loan(first_per_loan(df, ["a", "b"], ["place"]))
    assert (got["1"]["a"], got["1"]["b"]) == (None, 9)


@pytest.mark.parametrize("n", [64, 65, 200])
def test_any_number_of_dates_keeps_every_loan(spark, n):
    """Without an early date every snapshot counts; a missing loan id is a loan too."""
    start = datetime(2020, 1, 1)
    rows = [(loan, start + timedelta(days=i), str(i * k)) for i in range(n) for loan, k in (("a", 2), (None, 1))]
    credit = spark.createDataFrame(rows, "LOAN_ID string, SNAPSHOT_DATE timestamp_ntz, DAYS_PAST_DUE string")
    loans = loan_aggregate(credit, EarlyDates(None)).collect()
    assert {r.LOAN_ID: r.early_dpd_trend for r in loans} == {"a": 2.0, None: 1.0}


def test_hash_path_equals_the_sorted_one(spark):
    """First rows by place and known values by date, against plain Python; one loan holds a third."""
    rng = random.Random(4)
    rows = []
    for i in rng.sample(range(3000), 3000):
        loan = "hot" if i % 3 == 0 else None if i % 50 == 1 else str(i % 40)
        day = datetime(2025, 1, 1 + rng.randrange(9)) if rng.random() < 0.9 else None
        value = rng.choice([None, float(rng.randrange(5))])
        rows.append((loan, day, value, rng.choice([None, "a", "b"]), (day, i)))
    schema = ("LOAN_ID string, SNAPSHOT_DATE timestamp_ntz, n double, s string, "
              "_ingest_order struct<at: timestamp_ntz, place: bigint>")  # fmt: skip
    df = spark.createDataFrame(rows, schema).repartition(7)
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    early = datetime(1, 1, 1)
    first = {k: min(v, key=lambda r: (r[4][0] or early, r[4][1])) for k, v in groups.items()}
    got = first_per_loan(df, ["n", "s"]).collect()
    assert len(got) == len(groups) and {r.LOAN_ID: (r.n, r.s) for r in got} == {k: v[2:4] for k, v in first.items()}
    for known, sign in ((first_known_per_loan, 1), (last_known_per_loan, -1)):
        got = {r.LOAN_ID: (r.n, r.s) for r in known(df, ["n", "s"]).collect()}
        for loan, own in groups.items():
            for place, column in ((0, 2), (1, 3)):
                values = sorted(((r[1] or early, r[column]) for r in own if r[column] is not None))
                assert got[loan][place] == values[::sign][0][1]


def test_no_rows_are_sorted_for_first_rows(spark, sf):
    for name in ("q_first_per_loan", "q_origination", "q_labelled", "q_feature_matrix", "q_last_demographics"):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan, name


def test_first_row_needs_an_order(spark):
    df = spark.createDataFrame([("x", 1)], "LOAN_ID string, a int")
    with pytest.raises(ValueError):
        first_per_loan(df, ["a"])
