import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanlens.session import local_session  # noqa: E402

SMALL_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "loanlens-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL_TABLES


@pytest.fixture(scope="session")
def credit(spark):
    """A few hand-made loans; early dates are the first three of the year."""
    rows = [
        ("A", "2025-01-01", "0", "Active", "Current", "100", "100"),
        ("A", "2025-03-31", "10", "Active", "Arrears", "150", "200"),
        ("A", "2025-06-30", "20", "Active", "Arrears", "500", "300"),
        ("A", "2025-12-30", "30", "Active", "Arrears", "0", "0"),
        ("B", "2025-06-30", None, "Active", None, "50", "0"),
        ("B", "2025-09-30", "45", "fpd", "Arrears", "0", "10"),
        ("B", "2025-12-30", None, None, "Current", "0", "10"),
        ("C", "2025-09-30", "61", "Active", "Arrears", "1", "2"),
        ("D", "2025-01-01", "35", "Active", " Arrears", "1", "4"),
        ("D", "2025-03-31", "x", "Active", "ARREARS", "1", "4"),
    ]
    names = "LOAN_ID SNAPSHOT_DATE DAYS_PAST_DUE ACCOUNT_STATUS_L2 BALANCE_DUE_STATUS TOTAL_PAID TOTAL_DUE_TODAY"
    schema = ", ".join(f"{n} string" for n in names.split())
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("SNAPSHOT_DATE", df.SNAPSHOT_DATE.cast("timestamp_ntz"))


def rows_by_loan(df):
    return {r["LOAN_ID"]: r.asDict() for r in df.collect()}
