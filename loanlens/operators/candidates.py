"""Candidate classifiers: settings and row weights."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)

from loanlens.config import TARGET, Config

FEATURE_VECTOR = "features"
WEIGHT = "weight"
# Bad loans count this many times their share for the boosted candidates.
BOOSTED_BAD_FACTOR = 5
INVERSE_REGULARISATION = 0.01


@dataclass(frozen=True)
class ClassCounts:
    good: int
    bad: int

    @property
    def balanced(self) -> tuple[float, float]:
        """Weights of a good and a bad row that give both classes the same sum."""
        total = self.good + self.bad
        return total / (2 * max(self.good, 1)), total / (2 * max(self.bad, 1))

    @property
    def boosted(self) -> tuple[float, float]:
        return 1.0, BOOSTED_BAD_FACTOR * self.good / max(self.bad, 1)


@dataclass(frozen=True)
class Candidate:
    name: str
    weights: Callable[[ClassCounts], tuple[float, float]]
    build: Callable[[ClassCounts], Estimator]
    balanced: bool = True


def candidates(cfg: Config) -> dict[str, Candidate]:
    """The candidates named in the configuration, in its order."""
    size = cfg.profile
    shared = {"featuresCol": FEATURE_VECTOR, "labelCol": TARGET, "weightCol": WEIGHT}

    def logistic(counts: ClassCounts) -> Estimator:
        # Balanced weights sum to the number of rows, which scales the penalty.
        rows = max(counts.good + counts.bad, 1)
        return LogisticRegression(
            regParam=1 / (INVERSE_REGULARISATION * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=size.logistic_iterations,
            tol=1e-7,
            **shared,
        )

    def forest(_: ClassCounts) -> Estimator:
        return RandomForestClassifier(
            numTrees=size.forest_trees,
            maxDepth=12,
            minInstancesPerNode=10,
            featureSubsetStrategy="sqrt",
            maxBins=size.max_bins,
            seed=cfg.seed,
            **shared,
        )

    def boosted(depth: int) -> Callable[[ClassCounts], Estimator]:
        def build(_: ClassCounts) -> Estimator:
            return GBTClassifier(
                maxIter=size.boosting_rounds,
                maxDepth=depth,
                stepSize=0.03,
                subsamplingRate=0.8,
                featureSubsetStrategy="0.8",
                maxBins=size.max_bins,
                checkpointInterval=10,
                seed=cfg.seed,
                **shared,
            )

        return build

    known = {
        "logistic": Candidate("logistic", lambda c: c.balanced, logistic),
        "forest": Candidate("forest", lambda c: c.balanced, forest),
        "boosted_a": Candidate("boosted_a", lambda c: c.boosted, boosted(6), False),
        "boosted_b": Candidate("boosted_b", lambda c: c.boosted, boosted(8), False),
    }
    return {name: known[name] for name in cfg.candidates}
