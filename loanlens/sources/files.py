"""Reading one tabular file or directory with every value kept as text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.values import col

# Position of a row in its source, for the rules that keep the first row in file
# order. Splits of a file are ordered by their byte offset; within one split the
# generated id grows with the rows.
INGEST_ORDER = "_ingest_order"

# Texts that stand for a missing value in the source files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_table(
    spark: SparkSession, path: str, *, ingest_order: bool = False
) -> DataFrame | None:
    """CSV (by suffix) or Parquet at ``path``; None when there is nothing there.

    CSV values are text, and the usual texts for a missing value become NULL.
    """
    try:
        if path.lower().rstrip("/").endswith((".csv", ".csv.gz", ".txt")):
            df = spark.read.option("header", True).option("inferSchema", False).csv(path)
            columns = [F.when(~col(n).isin(*MISSING), col(n)).alias(n) for n in df.columns]
        else:
            df = spark.read.parquet(path)
            columns = [col(n) for n in df.columns]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if not ingest_order:
        return df.select(columns)
    place = [
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    ]
    # Two numbers order the rows of one file, without its name in every row.
    if len(df.inputFiles()) > 1:
        place.insert(0, F.col("_metadata.file_path").alias("file"))
    position = F.struct(*place)
    return df.select(*columns, position.alias(INGEST_ORDER))
