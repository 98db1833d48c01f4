"""What a training has finished, kept in shared storage so that a restart goes on from there."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.config import LOAN_ID, Config
from loanlens.functions.values import col
from loanlens.operators.model import TrainedModel

log = logging.getLogger(__name__)


def rows_checksum(df: DataFrame) -> str:
    """Number and checksum of the rows, whatever their order and partitions."""
    names = sorted(df.columns)
    total = F.sum(F.xxhash64(*map(col, names)).cast("decimal(38,0)"))
    count, checksum = df.agg(F.count(F.lit(1)), total).first()
    return f"{count}:{checksum or 0}"


def loans_checksum(df: DataFrame) -> str:
    """The same for the loan ids alone: which loans a table holds."""
    return rows_checksum(df.select(col(LOAN_ID)))


@dataclass(frozen=True)
class Ledger:
    """Folder of one training: its configuration, features and rows decide the name.

    Every finished fit is a folder of its own, written by one job, so a driver that is lost
    in between leaves whole entries only.
    """

    spark: SparkSession
    folder: str

    @classmethod
    def of(cls, root: str, rows: DataFrame, features: list[str], cfg: Config) -> Ledger:
        # What only changes how fast a training runs doesn't make it another one.
        settings = asdict(cfg)
        settings["profile"].pop("fold_parallelism", None)
        facts = json.dumps([settings, features, rows_checksum(rows)], sort_keys=True, default=str)
        key = hashlib.sha256(facts.encode()).hexdigest()[:32]
        return cls(rows.sparkSession, f"{root.rstrip('/')}/training-{key}")

    def fits(self) -> dict[tuple[str, int], float]:
        """ROC-AUC of every finished fit, by candidate and fold."""
        try:
            found = self.spark.read.schema("model string, fold int, auc double").json(f"{self.folder}/fits/*")
            return {(r["model"], r["fold"]): r["auc"] for r in found.collect()}
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise

    def record(self, model: str, fold: int, auc: float) -> None:
        row = self.spark.createDataFrame([(model, fold, auc)], "model string, fold int, auc double")
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/fits/{model}-{fold}")

    def model(self, name: str, fit: Callable[[], TrainedModel]) -> TrainedModel:
        """The refitted model ``name``, fitted and saved if that has not been done."""
        path = f"{self.folder}/model-{name}"
        try:
            found = TrainedModel.load(self.spark, path)
            log.info("model %s was fitted before", name)
            return found
        except FileNotFoundError:
            model = fit()
            # The facts are written last: without them the model counts as absent.
            model.save(path)
            return model
