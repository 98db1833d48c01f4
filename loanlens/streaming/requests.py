"""Scoring requests as they arrive in a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanlens.config import NUMERIC_FEATURES, Config
from loanlens.operators.scoring import RiskModel, score_requests

# Values are read as text: a wrong one spoils its request, not the batch.
REQUEST_SCHEMA = T.StructType(
    [T.StructField("loan_id", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in NUMERIC_FEATURES]
    + [T.StructField("_corrupt_record", T.StringType())]
)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests of a folder as a table."""
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def read_request_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Requests of a folder as a stream; ``max_files`` limits a micro-batch."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def score_requests_stream(
    requests: DataFrame,
    model: RiskModel,
    out_dir: str,
    checkpoint: str,
    cfg: Config | None = None,
    *,
    explain: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a request stream into Parquet, one folder per micro-batch.

    The scoring is stateless. A batch that is run again after a failure replaces
    its own folder, so every request is answered exactly once.
    """
    scored = score_requests(requests, model, cfg, explain=explain)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
