"""Global attribution of a model over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanlens.operators.attribution import ATTRIBUTIONS, global_importance
from loanlens.operators.encode import encode_categoricals
from loanlens.operators.scoring import RiskModel
from loanlens.operators.split import seeded_sample


def compute_shap(
    model: RiskModel,
    data: DataFrame,
    n_samples: int | None = None,
    top: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``(feature, mean_abs_shap)`` of all features, largest first.

    All loans count unless ``n_samples`` asks for a sample; ``top`` keeps the first rows.
    """
    if n_samples is not None:
        data = seeded_sample(data, n_samples, seed)
    complete = model.impute(encode_categoricals(data))
    return global_importance(model.add_attributions(complete), model.features, ATTRIBUTIONS, top)
