"""Record cleaner: drop ids, fill text columns, impute sex and age, log-age.

Fit learns two statistics in ONE aggregation job over the training rows:
the mode of the sex column (nulls ignored, ties -> lowest value) and the
exact median of the parsed age in days. Transform is a single projection.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pawprint.functions.text import UNKNOWN, age_in_days
from pawprint.operators.base import require_fitted

# Fixed column names and fill values (equal to the reference's).
SEX_COL = "SexuponOutcome"
AGE_COL = "AgeuponOutcome"
LOG_AGE_COL = "log_age_in_days"
FILL_UNKNOWN_COLS = ("Name", "Breed", "Color")
DEFAULT_AGE_MEDIAN = 0.0


class _CleanerParams(Params):
    columnsToRemove = Param(Params._dummy(), "columnsToRemove", "id columns to drop",
                            typeConverter=TypeConverters.toListString)

    def getColumnsToRemove(self) -> list[str]:
        return self.getOrDefault(self.columnsToRemove)


class DataCleaner(Estimator, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columnsToRemove: list[str] | None = None):
        super().__init__()
        self._setDefault(columnsToRemove=["AnimalID"])
        if columnsToRemove is not None:
            self._set(columnsToRemove=list(columnsToRemove))

    @staticmethod
    def statistics(df: DataFrame) -> DataFrame:
        """One-row table (sex_mode, age_median) learned from ``df``: one job."""
        aggs = []
        if SEX_COL in df.columns:
            aggs.append(F.coalesce(F.mode(F.col(SEX_COL), True), F.lit(UNKNOWN)).alias("sex_mode"))
        else:
            aggs.append(F.lit(UNKNOWN).alias("sex_mode"))
        if AGE_COL in df.columns:
            aggs.append(F.coalesce(F.median(age_in_days(AGE_COL)), F.lit(DEFAULT_AGE_MEDIAN))
                        .alias("age_median"))
        else:
            aggs.append(F.lit(DEFAULT_AGE_MEDIAN).cast("double").alias("age_median"))
        return df.agg(*aggs)

    def _fit(self, df: DataFrame) -> "DataCleanerModel":
        row = self.statistics(df).first()
        model = DataCleanerModel(columnsToRemove=self.getColumnsToRemove(),
                                 sexMode=row["sex_mode"], ageMedian=float(row["age_median"]))
        return self._copyValues(model)


class DataCleanerModel(Model, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    sexMode = Param(Params._dummy(), "sexMode", "training mode of the sex column",
                    typeConverter=TypeConverters.toString)
    ageMedian = Param(Params._dummy(), "ageMedian", "training median age in days",
                      typeConverter=TypeConverters.toFloat)

    def __init__(self, columnsToRemove: list[str] | None = None, sexMode: str | None = None,
                 ageMedian: float | None = None):
        super().__init__()
        self._setDefault(columnsToRemove=["AnimalID"])
        if columnsToRemove is not None:
            self._set(columnsToRemove=list(columnsToRemove))
        if sexMode is not None:
            self._set(sexMode=sexMode)
        if ageMedian is not None:
            self._set(ageMedian=float(ageMedian))
        self.observation: Observation | None = None

    def imputation_columns(self, df: DataFrame) -> list:
        """Null counts of the imputed inputs, as aggregate expressions."""
        out = []
        if SEX_COL in df.columns:
            out.append(F.count_if(F.col(SEX_COL).isNull()).alias("n_missing_sex"))
        if AGE_COL in df.columns:
            out.append(F.count_if(age_in_days(AGE_COL).isNull()).alias("n_missing_age"))
        return out

    def transform_observed(self, df: DataFrame) -> DataFrame:
        """``transform`` plus imputation counts that ride along the caller's
        next action (no extra job); read them with ``imputation_counts()``.

        Kept separate from ``transform`` so model plans (cached, cogrouped)
        stay pure projections.
        """
        metrics = self.imputation_columns(df)
        if metrics:
            self.observation = Observation(f"imputation_{uuid.uuid4().hex[:8]}")
            df = df.observe(self.observation, *metrics)
        return self.transform(df)

    def _transform(self, df: DataFrame) -> DataFrame:
        require_fitted(self, "sexMode", "ageMedian")
        drop = set(self.getColumnsToRemove())
        cols = []
        for c in df.columns:
            if c in drop:
                continue
            if c in FILL_UNKNOWN_COLS:
                cols.append(F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c))
            elif c == SEX_COL:
                cols.append(F.coalesce(F.col(c), F.lit(self.getOrDefault(self.sexMode))).alias(c))
            elif c == AGE_COL:
                continue
            else:
                cols.append(F.col(c))
        if AGE_COL in df.columns:
            days = F.coalesce(age_in_days(AGE_COL), F.lit(self.getOrDefault(self.ageMedian)))
            cols.append(F.log1p(days).alias(LOG_AGE_COL))
        return df.select(*cols)

    def imputation_counts(self) -> dict:
        """Counts gathered by the last transformed plan once an action ran on it."""
        return dict(self.observation.get) if self.observation is not None else {}
