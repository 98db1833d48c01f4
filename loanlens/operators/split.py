"""Stratified splits that depend on the loan id and the seed only.

A loan's place is a hash of its id on a grid of a million cells. Per class, the
cells are counted and the split falls where the running share reaches the wanted
fraction. The rows themselves are never sorted, and re-partitioning or re-running
a job cannot move a loan to the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, TARGET
from loanlens.functions.values import col

GRID = 1_000_000


def hash_cell(loan: Column, seed: int) -> Column:
    """Cell 0..GRID-1 of a loan, from the first 32 bits of an MD5 of id and seed."""
    digest = F.md5(F.concat_ws("|", loan.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % GRID).cast("int")


def _ranked_cells(df: DataFrame, label: str, seed: int) -> DataFrame:
    """``(label, cell, before, total)``: loans of the class in lower cells, and in all."""
    cells = (
        df.groupBy(col(label).alias(label), hash_cell(col(LOAN_ID), seed).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most GRID rows per class.
    lower = W.partitionBy(label).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    return cells.select(
        label,
        "cell",
        F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"),
        F.sum("n").over(W.partitionBy(label)).alias("total"),
    )


def _cut_points(df: DataFrame, label: str, seed: int, fractions: list[float]) -> DataFrame:
    """Per class, the lowest cell at which each fraction of the loans is passed."""
    ranked = _ranked_cells(df, label, seed)
    return ranked.groupBy(label).agg(
        *[
            F.coalesce(
                F.min(F.when(F.col("before") >= F.col("total") * f, F.col("cell"))), F.lit(GRID)
            ).alias(f"cut{i}")
            for i, f in enumerate(fractions)
        ]
    )


def _with_cuts(df: DataFrame, label: str, seed: int, fractions: list[float]) -> DataFrame:
    cuts = _cut_points(df, label, seed, fractions).withColumnRenamed(label, "_class")
    # One row per class, so this broadcast is bounded by the number of labels.
    joined = df.join(F.broadcast(cuts), col(label) == F.col("_class")).drop("_class")
    return joined.withColumn("_cell", hash_cell(col(LOAN_ID), seed))


def mark_test(
    df: DataFrame, fraction: float = 0.2, seed: int = 42, label: str = TARGET
) -> DataFrame:
    """Add ``is_test`` (0/1), with the wanted fraction of every class."""
    marked = _with_cuts(df, label, seed, [fraction])
    test = F.when(F.col("_cell") < F.col("cut0"), 1).otherwise(0)
    return marked.withColumn("is_test", test).drop("cut0", "_cell")


def stratified_split(
    df: DataFrame, fraction: float = 0.2, seed: int = 42, label: str = TARGET
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    marked = mark_test(df, fraction, seed, label)
    return (
        marked.filter("is_test = 0").drop("is_test"),
        marked.filter("is_test = 1").drop("is_test"),
    )


def assign_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = TARGET) -> DataFrame:
    """Add ``fold`` 0..k-1, with equal shares of every class.

    Uses a hash of its own, so folds of training rows are independent of the split.
    """
    marked = _with_cuts(df, label, seed + 1, [i / k for i in range(1, k)])
    fold = F.lit(0)
    for i in range(k - 1):
        fold = fold + (F.col("_cell") >= F.col(f"cut{i}")).cast("int")
    return marked.withColumn("fold", fold).drop("_cell", *[f"cut{i}" for i in range(k - 1)])


def seeded_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` loans."""
    order = hash_cell(col(LOAN_ID), seed)
    return df.orderBy(order, col(LOAN_ID)).limit(n)


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: class counts, good-to-bad ratio, and the balanced weight of each class."""
    n_bad = F.count_if(F.col(label) == 1)
    n_good = F.count_if(F.col(label) == 0)
    total = (F.col("n_bad") + F.col("n_good")).cast("double")
    return df.agg(n_good.alias("n_good"), n_bad.alias("n_bad")).select(
        "n_good",
        "n_bad",
        (F.col("n_good") / F.greatest(F.col("n_bad"), F.lit(1))).alias("pos_weight"),
        F.try_divide(total, 2.0 * F.col("n_good")).alias("weight_good"),
        F.try_divide(total, 2.0 * F.col("n_bad")).alias("weight_bad"),
    )
