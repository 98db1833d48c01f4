"""A trained model with everything scoring needs, and its storage."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.values import col
from loanlens.operators.attribution import ATTRIBUTIONS, linear_attributions
from loanlens.operators.impute import fill
from loanlens.operators.trees import add_tree_attributions


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with its feature order, medians and background means.

    ``trained_on`` is the number and checksum of the loans it was trained on.
    """

    name: str
    pipeline: PipelineModel
    features: list[str]
    medians: Mapping[str, float] = field(default_factory=dict)
    background: Mapping[str, float] = field(default_factory=dict)
    trained_on: str | None = None

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    def impute(self, df: DataFrame) -> DataFrame:
        return fill(df, {name: self.medians.get(name, 0.0) for name in self.features})

    def add_probability(self, df: DataFrame, name: str = "p") -> DataFrame:
        out = self.pipeline.transform(df)
        added = [c for c in out.columns if c not in df.columns]
        probability = vector_to_array(F.col("probability"))[1]
        return out.withColumn(name, probability).drop(*[c for c in added if c != name])

    def add_attributions(
        self, df: DataFrame, name: str = ATTRIBUTIONS, trees: DataFrame | None = None
    ) -> DataFrame:
        """Attribution per feature: log-odds, or probability for a forest.

        ``trees`` are the classifier's packed trees, for a caller who has them already.
        """
        if isinstance(self.classifier, LogisticRegressionModel):
            weights = dict(zip(self.features, self._raw_coefficients()))
            means = {f: self.background.get(f, 0.0) for f in self.features}
            return df.withColumn(name, linear_attributions(df, weights, means))
        return add_tree_attributions(df, self.classifier, self.features, name, self._scales(), trees)

    def _scales(self) -> list[float]:
        """What each feature is divided by before it reaches the classifier."""
        scales = [1.0] * len(self.features)
        for stage in self.pipeline.stages[1:-1]:
            scales = [a * s if s else 0.0 for a, s in zip(scales, stage.std.toArray())]
        return scales

    def _raw_coefficients(self) -> list[float]:
        """Coefficients in units of the raw features, also behind a scaler."""
        weights = [float(c) for c in self.classifier.coefficients.toArray()]
        for stage in self.pipeline.stages[1:-1]:
            weights = [w / s if s else 0.0 for w, s in zip(weights, stage.std.toArray())]
        return weights

    def importances(self, top: int | None = 20) -> DataFrame:
        """Largest feature importances (absolute coefficients for a linear model)."""
        spark = SparkSession.getActiveSession()
        if isinstance(self.classifier, LogisticRegressionModel):
            values = [abs(float(c)) for c in self.classifier.coefficients.toArray()]
        else:
            values = [float(v) for v in self.classifier.featureImportances.toArray()]
        rows = list(zip(self.features, values, range(len(values))))
        table = spark.createDataFrame(rows, "feature string, importance double, i int")
        ranked = table.orderBy(F.col("importance").desc(), "i").drop("i")
        return ranked if top is None else ranked.limit(top)

    # --- Storage: the pipeline, and one JSON row next to it. ---

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        facts = {
            "name": self.name,
            "features": self.features,
            "medians": dict(self.medians),
            "background": dict(self.background),
            "trained_on": self.trained_on,
        }
        spark = SparkSession.getActiveSession()
        row = spark.createDataFrame([(json.dumps(facts),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        try:
            text = spark.read.text(f"{path}/facts").select(col("value")).first()[0]
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(f"no trained model at {path}") from error
            raise
        facts = json.loads(text)
        return cls(pipeline=PipelineModel.load(f"{path}/pipeline"), **facts)
