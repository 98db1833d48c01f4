"""Loan-domain views over a star schema of customers, orders, line items, events.

A customer is a loan, a calendar year of orders is a snapshot. The views give the
engine realistic input where no loan data is at hand; every value is derived from
the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, NUMERIC_FEATURES, Config
from loanlens.functions.naming import normalise_loan_id
from loanlens.sources.borrowers import (
    shape_dob,
    shape_gender,
    shape_income,
    shape_nps,
    shape_sales,
)
from loanlens.sources.load import Sources

# Years 1995-1997 are early; the data runs to 2001.
VIEW_CONFIG = Config(
    early_snapshots=("1995-12-31", "1996-12-31", "1997-12-31"),
    late_snapshots=("1998-12-31", "1999-12-31", "2000-12-31", "2001-12-31"),
    early_fallback=False,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: Column) -> Column:
    """Whole cents: integer sums do not depend on the order of addition."""
    return F.floor(amount * 100 + 0.5).cast("long")


def credit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly snapshots per customer.

    Line items are summed per order before the join. The join then has at most
    one row per order on that side, whatever the spread of lines over orders, and
    it reuses the partitioning of the sums.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    price, open_line = F.col("l_extendedprice"), F.col("l_linestatus") == "O"
    paid = F.when(
        F.col("l_linestatus") == "F", price * (1 - F.col("l_discount"))
    ).otherwise(price / 2)
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.unix_date(F.col("l_shipdate").cast("date"))).alias("ship_days"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.count_if(open_line).alias("n_open"),
        F.sum(_cents(price)).alias("due"),
        F.sum(_cents(paid)).alias("paid"),
    )
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    yearly = joined.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("ship_days") - F.col("n") * day).alias("lag"),
        F.sum("n_returned").alias("n_returned"),
        F.sum("n_open").alias("n_open"),
        F.sum("due").alias("due"),
        F.sum("paid").alias("paid"),
    )
    n, returned = F.col("n"), F.col("n_returned")
    # Real sources have gaps and oddities; a number of loan and year spreads them.
    odd = F.col("o_custkey") + F.col("y")
    dpd = F.greatest(F.lit(0), F.abs("lag") % 91 - 30).cast("double").cast("string")
    status = (
        F.when(returned == n, F.when(odd % 2 == 0, "fpd").otherwise("FPD"))
        .when(returned * 3 > n * 2, "FMD")
        .otherwise("Active")
    )
    arrears = F.when(odd % 5 == 0, " Arrears").when(odd % 5 == 1, "ARREARS").otherwise("Arrears")
    balance = F.when(F.col("n_open") * 2 > n, arrears).otherwise("Current")
    paid = F.when(odd % 19 == 0, F.col("due") * 2).otherwise(F.col("paid"))
    due = F.when(odd % 17 == 0, F.lit(0)).otherwise(F.col("due"))
    return yearly.select(
        F.col("o_custkey").cast("string").alias(LOAN_ID),
        F.make_date("y", F.lit(12), F.lit(31)).cast("timestamp_ntz").alias("SNAPSHOT_DATE"),
        F.when(odd % 23 == 0, "n/a").when(odd % 11 != 0, dpd).alias("DAYS_PAST_DUE"),
        F.when(odd % 13 != 0, status).alias("ACCOUNT_STATUS_L2"),
        F.when(odd % 7 != 0, balance).alias("BALANCE_DUE_STATUS"),
        (paid / 100).alias("TOTAL_PAID"),
        (due / 100).alias("TOTAL_DUE_TODAY"),
    )


def _sheet(customer: DataFrame, header: str, text: Column, later: Column) -> DataFrame:
    """A borrower sheet as it comes: odd headers, text, and for every third loan a second
    row with another value, which must not count."""
    key = F.col("c_custkey")

    def rows(df: DataFrame, value: Column, place: Column) -> DataFrame:
        return df.select(
            F.concat(F.lit(" "), key.cast("string")).alias(" Loan Id "),
            value.alias(header),
            F.lit(None).cast("string").alias("Unnamed: 3"),
            F.struct(place.alias("n")).alias("_ingest_order"),
        )

    again = rows(customer.filter(key % 3 == 0), later, key + 10**12)
    return normalise_loan_id(rows(customer, text, key).unionByName(again))


def dob_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1930-01-01").cast("date"), (key * 97 % 20000).cast("int"))
    text = F.when(key % 17 != 0, F.date_format(born, "yyyy-MM-dd"))
    sheet = _sheet(table(spark, sf_dir, "customer"), " Date of Birth", text, F.lit("2001-01-01"))
    return shape_dob(sheet).select(LOAN_ID, "date_of_birth", "_ingest_order")


def income_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    received = (F.col("c_acctbal") * 10).cast("string")
    months = (F.col("c_nationkey") % 6).cast("string")
    both = F.struct(received.alias("amount"), months.alias("months"))
    later = F.struct(F.lit("7777").alias("amount"), F.lit("1").alias("months"))
    sheet = _sheet(customer, "values", both, later).select(
        LOAN_ID,
        F.col("values.amount").alias("Amount_Received"),
        F.col("values.months").alias("duration (months)"),
        "_ingest_order",
    )
    return shape_income(sheet).select(LOAN_ID, "Received", "Duration", "_ingest_order")


def gender_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", " Male ")
        .when(segment == "MACHINERY", "F")
        .when(segment == "AUTOMOBILE", "m")
        .when(segment == "HOUSEHOLD", "female")
        .otherwise("other")
    )
    sheet = _sheet(table(spark, sf_dir, "customer"), "customer gender", text, F.lit("M"))
    return shape_gender(sheet).select(LOAN_ID, "Gender", "_ingest_order")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a sale row as text; the first one of a customer counts."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    cash = price * (1 - (key % 4) * F.lit(0.1).cast("double"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(LOAN_ID),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_of_sale"),
        cash.cast("string").alias("cash_price"),
        price.cast("string").alias("LoanPrice"),
        (6 + (key % 3) * 6).cast("string").alias("loan term"),
        F.struct(F.col("o_orderdate").alias("at"), key.alias("n")).alias("_ingest_order"),
    )
    return shape_sales(rows).select(
        LOAN_ID, "Sale Date", "Cash Price", "Loan Price", "Loan Term", "_ingest_order"
    )


def nps_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey answers as text, one per event; the first one of a user counts."""
    kind, score = F.col("event_type"), F.floor("value") % 11
    group = (
        F.when(score >= 9, " Promoter ").when(score <= 6, "Detractor").otherwise(" Passive")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias(LOAN_ID),
        score.cast("string").alias("NPS Score"),
        F.when(kind == "error", "Yes").otherwise(" no ").alias("Phone Locked"),
        F.when(kind == "purchase", "TRUE")
        .when(kind == "view", "x")
        .otherwise("0")
        .alias("Payment Delay"),
        F.when(kind == "click", "1").when(kind == "error", "False").alias("Happy_Device"),
        group.alias("Promoter/Detractor"),
        F.struct(F.col("ts").alias("at"), F.col("event_id").alias("n")).alias("_ingest_order"),
    )


def request_view(features: DataFrame) -> DataFrame:
    """Scoring requests as text, made from feature rows.

    Requests of loans ending in 7 carry an amount that is no number.
    """
    names = [n for n in NUMERIC_FEATURES if n != "loan_amount"]
    broken = F.col(LOAN_ID).endswith("7")
    return features.select(
        F.col(LOAN_ID).alias("loan_id"),
        F.when(broken, "n/a")
        .otherwise(F.col("loan_amount").cast("string"))
        .alias("loan_amount"),
        *[F.col(n).cast("string").alias(n) for n in names],
    )


def loan_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        credit=credit_view(spark, sf_dir),
        demographics={
            "dob": dob_view(spark, sf_dir),
            "income": income_view(spark, sf_dir),
            "gender": gender_view(spark, sf_dir),
            "sales": sales_view(spark, sf_dir),
        },
        nps=shape_nps(nps_raw_view(spark, sf_dir)),
    )
