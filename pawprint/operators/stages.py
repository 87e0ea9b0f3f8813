"""Feature stages as ``pyspark.ml`` transformers / estimators.

Each stage is one projection of built-in expressions; a stage whose input
column is absent returns the table unchanged.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.functions import temporal as tf
from pawprint.functions import text as tx
from pawprint.operators.base import NotFittedError
from pawprint.operators.rare import RareCategoriesGrouper, RareCategoriesModel

# Fixed output names (equal to the reference's).
TEMPORAL_OUT = ("Hour_sin", "Hour_cos", "Wday_sin", "Wday_cos", "IsWeekend", "DoY_sin", "DoY_cos")


def _col_param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toString)


def temporal_columns(ts) -> dict:
    """Cyclic hour/weekday/day-of-year features and the weekend flag."""
    h_sin, h_cos = tf.cyclic(F.hour(ts), 24)
    wd = tf.weekday(ts)
    w_sin, w_cos = tf.cyclic(wd, 7)
    d_sin, d_cos = tf.cyclic(F.dayofyear(ts), tf.DAYS_PER_YEAR)
    return {"Hour_sin": h_sin, "Hour_cos": h_cos, "Wday_sin": w_sin, "Wday_cos": w_cos,
            "IsWeekend": (wd >= 5).cast("double"), "DoY_sin": d_sin, "DoY_cos": d_cos}


class TemporalFeaturesExtractor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    datetimeCol = _col_param("datetimeCol", "timestamp or timestamp text column")
    onError = _col_param("onError", "'raise' or 'null' for unparseable text")

    def __init__(self, datetimeCol: str = "DateTime", onError: str = "raise"):
        super().__init__()
        self._setDefault(datetimeCol="DateTime", onError="raise")
        self._set(datetimeCol=datetimeCol, onError=onError)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.datetimeCol)
        if c not in df.columns:
            return df
        ts = tf.parse_datetime(c, self.getOrDefault(self.onError))
        return df.withColumns(temporal_columns(ts)).drop(c)


class SexFeaturesExtractor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    sexCol = _col_param("sexCol", "sex-upon-outcome text column")

    def __init__(self, sexCol: str = "SexuponOutcome"):
        super().__init__()
        self._setDefault(sexCol="SexuponOutcome")
        self._set(sexCol=sexCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.sexCol)
        if c not in df.columns:
            return df
        return df.withColumn("Reproductive_Status", tx.reproductive_status(c)).drop(c)


class NameFeaturesExtractor(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    nameCol = _col_param("nameCol", "name text column")

    def __init__(self, nameCol: str = "Name"):
        super().__init__()
        self._setDefault(nameCol="Name")
        self._set(nameCol=nameCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.nameCol)
        if c not in df.columns:
            return df
        return df.withColumn("has_name", tx.has_name(c)).drop(c)


def primary_values(df: DataFrame) -> DataFrame:
    """Replace ``Breed`` / ``Color`` by their primary values where present."""
    exprs = {}
    if "Breed" in df.columns:
        exprs["Breed"] = tx.primary_breed("Breed")
    if "Color" in df.columns:
        exprs["Color"] = tx.primary_color("Color")
    return df.withColumns(exprs) if exprs else df


class CategoricalFeaturesEngineer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``is_mix`` from the raw breed, primary breed/colour, rare grouping.

    Rare grouping applies to every configured column that is present (the
    reference groups only when ``Color`` is present; see README).
    """
    inputCols = Param(Params._dummy(), "inputCols", "columns to group",
                      typeConverter=TypeConverters.toListString)
    maxOtherRatio = Param(Params._dummy(), "maxOtherRatio", "largest share left to Other",
                          typeConverter=TypeConverters.toFloat)

    def __init__(self, inputCols: list[str] | None = None, maxOtherRatio: float = 0.15):
        super().__init__()
        self._setDefault(inputCols=["Breed", "Color"], maxOtherRatio=0.15)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(maxOtherRatio=float(maxOtherRatio))

    def _fit(self, df: DataFrame) -> "CategoricalFeaturesModel":
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        grouper = RareCategoriesGrouper(inputCols=cols,
                                        maxOtherRatio=self.getOrDefault(self.maxOtherRatio))
        model = CategoricalFeaturesModel(grouper.fit(primary_values(df.select(*cols))))
        return self._copyValues(model)


class CategoricalFeaturesModel(Model):
    def __init__(self, grouper: RareCategoriesModel | None = None):
        super().__init__()
        self.grouper = grouper

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.grouper is None:
            raise NotFittedError("CategoricalFeaturesEngineer instance is not fitted. "
                                 "Call 'fit' before 'transform'.")
        return self.grouper.transform(self._primary(df))

    def _primary(self, df: DataFrame) -> DataFrame:
        if "Breed" in df.columns:
            df = df.withColumn("is_mix", tx.is_mix("Breed"))
        return primary_values(df)

    def transform_observed(self, df: DataFrame) -> DataFrame:
        """``transform``; the shares of ``Other`` are observed by the grouper."""
        if self.grouper is None:
            raise NotFittedError("CategoricalFeaturesEngineer instance is not fitted. "
                                 "Call 'fit' before 'transform'.")
        return self.grouper.transform_observed(self._primary(df))

    def write(self) -> MLWriter:
        return self.grouper.write()

    def save(self, path: str) -> None:
        self.grouper.save(path)

    @classmethod
    def load(cls, path: str) -> "CategoricalFeaturesModel":
        return cls(RareCategoriesModel.load(path))

    @classmethod
    def read(cls) -> MLReader:
        raise NotImplementedError("use CategoricalFeaturesModel.load")
