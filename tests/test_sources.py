import logging

import pytest

from loanlens.operators.first_last import first_per_loan
from loanlens.sources import (
    SourceLayout,
    infer_numeric,
    load_all,
    load_demographics,
    load_nps,
    load_snapshots,
    sheet_role,
    write_metrics,
    write_report,
    write_scores,
    write_snapshots,
)


def write(path, text, bom=False):
    path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


@pytest.fixture
def credit_dir(tmp_path):
    folder = tmp_path / "credit"
    folder.mkdir()
    write(folder / "one.csv", " Loan ID , DAYS_PAST_DUE,\n 1 ,5,\nnan,6,\n,7,\n", bom=True)
    write(folder / "two.csv", "LOAN_ID,DAYS_PAST_DUE,EXTRA\n1,x,e\n2,8,f\n")
    return str(folder)


FILES = [("one.csv", "2025-01-01"), ("two.csv", "2025-03-31"), ("gone.csv", "2025-06-30")]


def test_snapshots(spark, credit_dir, caplog):
    # The two files name the id differently; the first spelling is settled before stacking.
    files = [("two.csv", "2025-03-31"), ("gone.csv", "2025-06-30")]
    with caplog.at_level(logging.WARNING):
        df = load_snapshots(spark, files, credit_dir)
    assert "gone.csv" in caplog.text
    assert set(df.columns) == {"LOAN_ID", "DAYS_PAST_DUE", "EXTRA", "SNAPSHOT_DATE"}
    got = sorted((r.LOAN_ID, r.DAYS_PAST_DUE, str(r.SNAPSHOT_DATE)) for r in df.collect())
    assert got == [("1", "x", "2025-03-31 00:00:00"), ("2", "8", "2025-03-31 00:00:00")]
    one = load_snapshots(spark, FILES[:1], credit_dir)
    assert [(r.LOAN_ID, r.DAYS_PAST_DUE) for r in one.collect()] == [("1", "5")]
    with pytest.raises(FileNotFoundError):
        load_snapshots(spark, [("gone.csv", "2025-01-01")], credit_dir)


def test_snapshots_stack_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "LOAN_ID,X\n1,a\n")
    write(tmp_path / "b.csv", "Y,LOAN_ID\nb,2\n")
    df = load_snapshots(spark, [("a.csv", "2025-01-01"), ("b.csv", "2025-03-31")], str(tmp_path))
    assert sorted((r.LOAN_ID, r.X, r.Y) for r in df.collect()) == [("1", "a", None), ("2", None, "b")]


def test_ids_spelled_differently_per_file(spark, credit_dir):
    df = load_snapshots(spark, FILES, credit_dir)
    assert sorted(r.LOAN_ID for r in df.collect()) == ["1", "1", "2"]


def test_texts_for_missing_values(spark, tmp_path):
    write(tmp_path / "a.csv", "LOAN_ID,S\n1,NA\n2,n/a\n3,\n4,ok\nNULL,x\n5, NA\n")
    df = load_snapshots(spark, [("a.csv", "2025-01-01")], str(tmp_path))
    assert {r.LOAN_ID: r.S for r in df.collect()} == {"1": None, "2": None, "3": None, "4": "ok", "5": " NA"}


def test_sheet_roles():
    assert [sheet_role(n) for n in ("DOB", "Date of Birth", "Income Level", "Gender", "Sales", "x")] == [
        "dob", "dob", "income", "gender", "sales", None,
    ]


def test_demographics(spark, tmp_path):
    paths = {
        "DOB": write(tmp_path / "d.csv", "Loan Id,Customer Birth Day\n1,31/12/1990\n2,bad\n,\n"),
        "Income": write(tmp_path / "i.csv", "Loan Id,Amount Received,Loan Duration\n1,600,6\n2,x,0\n"),
        "Gender": write(tmp_path / "g.csv", "Loan Id,gender \n1,Male\n"),
        "Sales": write(
            tmp_path / "s.csv",
            "Loan Id,sale_date,cash_price,Loan_Price KES,loan term\n1,2024-05-06,10,15,6\n",
        ),
        "Notes": write(tmp_path / "n.csv", "text\nhello\n"),
    }
    tables = load_demographics(spark, paths)
    assert set(tables) == {"dob", "income", "gender", "sales"}
    born = {r.LOAN_ID: r.date_of_birth for r in tables["dob"].collect()}
    assert str(born["1"]) == "1990-12-31 00:00:00" and born["2"] is None
    income = {r.LOAN_ID: (r.Received, r.Duration) for r in tables["income"].collect()}
    assert income == {"1": (600.0, 6.0), "2": (None, 0.0)}
    assert tables["gender"].first().Gender == "Male"
    sale = tables["sales"].first()
    assert (sale["Cash Price"], sale["Loan Price"], sale["Loan Term"]) == (10.0, 15.0, 6.0)
    assert str(sale["Sale Date"]) == "2024-05-06 00:00:00"


def test_nps(spark, tmp_path):
    path = write(
        tmp_path / "nps.csv",
        "Loan ID,NPS Score,Phone Locked?,payment delay,Happy with device,Promoter/Detractor\n"
        "1,9, YES ,0,maybe, Promoter \n",
    )
    row = load_nps(spark, path).first()
    assert (row.nps_score, row.phone_locked, row.payment_delay, row.happy_device) == (
        9.0, 1.0, 0.0, None,
    )
    assert row.nps_category == "Promoter"
    assert load_nps(spark, str(tmp_path / "none.csv")) is None
    assert load_nps(spark, None) is None


def test_first_row_in_file_order_over_many_splits(spark, tmp_path):
    """One loan holds a third of the rows; its first line decides, however the file is split."""
    lines = ["Loan Id,Gender"]
    for i in range(6000):
        lines.append(f"{'hot' if i % 3 == 0 else i},{'g%05d' % (9999 - i)}")
    path = write(tmp_path / "gender.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        table = load_demographics(spark, {"Gender": path})["gender"]
        assert table.rdd.getNumPartitions() > 4
        first = first_per_loan(table, ["Gender"])
        got = {r.LOAN_ID: r.Gender for r in first.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["hot"] == "g09999"
    assert len(got) == 4001


def test_infer_numeric(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "a", None, "7"), ("2", " 2", "3", None, None)], "LOAN_ID string, n string, t string, e string, g string"
    )
    out = infer_numeric(df)
    assert dict(out.dtypes) == {
        "LOAN_ID": "string", "n": "double", "t": "string", "e": "double", "g": "double",
    }


def test_load_all(spark, tmp_path):
    write(tmp_path / "one.csv", "LOAN_ID,DAYS_PAST_DUE\n1,2\n")
    from loanlens.config import Config

    cfg = Config(snapshot_files=(("one.csv", "2025-01-01"),))
    src = load_all(spark, SourceLayout(credit_dir=str(tmp_path)), cfg)
    assert src.credit.count() == 1 and src.demographics == {} and src.nps is None


def test_written_snapshots_are_pruned_by_date(spark, credit, tmp_path):
    path = str(tmp_path / "snapshots")
    write_snapshots(credit, path)
    back = spark.read.parquet(path)
    assert back.count() == credit.count()
    from loanlens.operators.snapshots import early_features

    early = early_features(back)
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert {r.LOAN_ID for r in early.collect()} == {"A", "B", "D"}


def test_written_scores_and_metrics(spark, tmp_path):
    scores = spark.createDataFrame([("1", 0.1, 600, "Fair")], "LOAN_ID string, pd double, score int, risk_band string")
    write_scores(scores, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["LOAN_ID", "pd", "score", "risk_band"] and back.count() == 1
    write_scores(scores, str(tmp_path / "parquet"), "parquet")
    assert spark.read.parquet(str(tmp_path / "parquet")).first().score == 600
    write_report(scores, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 1
    write_metrics(scores.select("pd", "score"), str(tmp_path / "metrics"))
    lines = spark.read.json(str(tmp_path / "metrics")).collect()
    assert {(r.metric, r.value) for r in lines} == {("pd", "0.1"), ("score", "600")}
