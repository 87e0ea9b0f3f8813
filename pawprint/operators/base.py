"""Small shared pieces for the ``pyspark.ml`` stages of this package."""

from __future__ import annotations

from pyspark.ml.param import Params
from pyspark.sql import DataFrame


def fit_transform(estimator, df: DataFrame) -> DataFrame:
    """Fit on ``df`` then transform the same rows (the scikit-learn shortcut)."""
    return estimator.fit(df).transform(df)


class NotFittedError(RuntimeError):
    pass


def require_fitted(stage: Params, *names: str) -> None:
    for n in names:
        if not stage.isDefined(stage.getParam(n)):
            raise NotFittedError(
                f"{type(stage).__name__} instance is not fitted. Call 'fit' before 'transform'.")
