"""Rare-category grouping: keep the most frequent categories, others -> ``Other``.

Fit rule (per column, nulls not counted): order categories by count
descending, then category ascending; keep a category while the share of all
rows ranked strictly before it is below ``1 - max_other_ratio`` (the category
that crosses the line is kept).

Scale design: all columns are fitted in one pass (``unpivot`` -> one
``groupBy(column, category)``). The running share is NOT a window over every
distinct category of a column (one task per column, unbounded for long
tails). Instead categories are grouped into count *levels*
``(column, n) -> k categories``; the running mass over levels is a window
over at most ~sqrt(2*rows) levels per column. A level is then wholly kept,
wholly dropped, or -- for exactly one level per column -- split by ranking
its categories by name, which is the only place a per-category sort runs.
"""

from __future__ import annotations

import json
import logging
import uuid
import warnings

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsWritable, DefaultParamsReader,
                             DefaultParamsWriter, MLReader, MLWriter)
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pawprint.functions.text import OTHER
from pawprint.operators.base import NotFittedError
from pawprint.operators.ranks import exact_rank
from pawprint.session import cut_lineage

log = logging.getLogger(__name__)

# Kept lists up to this many categories are applied as an in-expression
# (``isin``); longer ones are applied with a join against the state table.
INLINE_LIMIT = 20_000


def category_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column, category, n) over all columns in one aggregation, nulls excluded."""
    by = list(by or [])
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
        for c in columns])).alias("kv")).select(*by, "kv.column", "kv.category")
    return (long.filter(F.col("category").isNotNull())
            .groupBy(*by, "column", "category").agg(F.count(F.lit(1)).alias("n")))


def frequent_categories(counts: DataFrame, max_other_ratio: float,
                        by: list[str] | None = None) -> DataFrame:
    """Kept categories ``(by..., column, category, n)`` from category counts.

    ``by`` fits one list per group (e.g. per species) in the same pass.
    """
    target = 1.0 - float(max_other_ratio)
    part = [*(by or [c for c in counts.columns if c not in ("column", "category", "n")]), "column"]
    levels = counts.groupBy(*part, "n").agg(F.count(F.lit(1)).alias("k"))
    by_n = Window.partitionBy(*part).orderBy(F.desc("n"))
    levels = (levels
              .withColumn("mass", F.col("n") * F.col("k"))
              .withColumn("mass_before", F.coalesce(
                  F.sum("mass").over(by_n.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("total", F.sum("mass").over(Window.partitionBy(*part))))
    first_in = F.col("mass_before").cast("double") / F.col("total") < F.lit(target)
    last_in = ((F.col("mass_before") + (F.col("k") - 1) * F.col("n")).cast("double")
               / F.col("total") < F.lit(target))
    levels = levels.withColumn(
        "status", F.when(last_in, F.lit("all")).when(first_in, F.lit("part")).otherwise(F.lit("none")))
    live = levels.filter(F.col("status") != "none").select(
        *part, "n", "mass_before", "total", "status")
    j = counts.join(live, [*part, "n"], "inner")
    whole = j.filter(F.col("status") == "all").withColumn("rn", F.lit(None).cast("bigint"))
    split = exact_rank(j.filter(F.col("status") == "part"), [*part, "n"], [F.col("category")])
    # share before a category = mass of earlier levels + earlier ties in its level.
    tie_before = F.when(F.col("status") == "part", F.col("rn") - 1)
    out = whole.unionByName(split).withColumn("tie_before", tie_before)
    out = out.filter(F.col("tie_before").isNull() | (
        (F.col("mass_before") + F.col("tie_before") * F.col("n")).cast("double") / F.col("total")
        < F.lit(target)))
    return out.select(*part, "category", F.col("n").cast("bigint").alias("n"))


def drift_message(column: str, ratio: float, limit: float) -> str:
    return (f"Column '{column}' has an 'Other' ratio of {ratio:.3f}, which exceeds the configured "
            f"max_other_ratio of {limit:.3f}.")


class _RareParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to group",
                      typeConverter=TypeConverters.toListString)
    maxOtherRatio = Param(Params._dummy(), "maxOtherRatio", "largest share left to Other",
                          typeConverter=TypeConverters.toFloat)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    def getMaxOtherRatio(self) -> float:
        return self.getOrDefault(self.maxOtherRatio)


class RareCategoriesGrouper(Estimator, _RareParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols: list[str] | None = None, maxOtherRatio: float = 0.15):
        super().__init__()
        self._setDefault(maxOtherRatio=0.15, inputCols=[])
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        self._set(maxOtherRatio=float(maxOtherRatio))

    def fit_state(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        for c in cols:
            if c not in df.columns:
                raise ValueError(
                    f"Required column '{c}' is missing from the training DataFrame during fit.")
        return frequent_categories(category_counts(df, cols), self.getMaxOtherRatio())

    def _fit(self, df: DataFrame) -> "RareCategoriesModel":
        cols = self.getInputCols()
        if not cols:
            return self._copyValues(RareCategoriesModel(state=None, inline={}))
        state = self.fit_state(df)
        # One job: fetch at most INLINE_LIMIT + 1 rows; more means "large".
        head = state.limit(INLINE_LIMIT + 1).collect()
        inline = None
        if len(head) <= INLINE_LIMIT:
            inline = {c: [] for c in cols}
            for r in head:
                inline[r["column"]].append(r["category"])
            state = None
            kept = {c for c in cols if inline[c]}
        else:
            # Large lists: materialise once in the shared checkpoint folder so
            # every later transform reads the table instead of refitting.
            state = cut_lineage(state)
            kept = {r["column"] for r in state.select("column").distinct().collect()}
        empty = [c for c in cols if c not in kept]
        for c in empty:
            msg = f"Column '{c}' is empty or contains only NaNs (nulls) during fit."
            log.warning(msg)
            warnings.warn(msg, RuntimeWarning)
        model = RareCategoriesModel(state=state, inline=inline)
        return self._copyValues(model)


class RareCategoriesModel(Model, _RareParams):
    """Fitted lists. Small lists live inline; large ones as a state table."""

    def __init__(self, state: DataFrame | None = None, inline: dict | None = None):
        super().__init__()
        self._setDefault(maxOtherRatio=0.15, inputCols=[])
        self.state = state
        self.inline = inline
        self.last_report: DataFrame | None = None
        self.observation: Observation | None = None

    # -- transform ---------------------------------------------------------
    def _apply_inline(self, df: DataFrame, cols: list[str]) -> DataFrame:
        exprs = {}
        for c in cols:
            keep = self.inline.get(c, [])
            kept = F.col(c).isin(*[F.lit(v) for v in keep]) if keep else F.lit(False)
            exprs[c] = F.when(kept | F.col(c).isNull(), F.col(c)).otherwise(F.lit(OTHER))
        return df.withColumns(exprs)

    def _apply_join(self, df: DataFrame, cols: list[str]) -> DataFrame:
        out = df
        for c in cols:
            flag = f"__kept_{c}"
            keep = (self.state.filter(F.col("column") == c)
                    .select(F.col("category").alias(f"__cat_{c}"), F.lit(True).alias(flag)))
            # Left join on the category; AQE picks broadcast when the list is small.
            out = (out.join(keep, out[c] == keep[f"__cat_{c}"], "left")
                   .withColumn(c, F.when(F.col(flag) | F.col(c).isNull(), F.col(c))
                               .otherwise(F.lit(OTHER)))
                   .drop(f"__cat_{c}", flag))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.inline is None and self.state is None:
            raise NotFittedError(
                "RareCategoriesGrouper instance is not fitted. Call 'fit' before 'transform'.")
        cols = [c for c in self.getInputCols() if c in df.columns]
        if not cols:
            return df
        return self._apply_inline(df, cols) if self.inline is not None else self._apply_join(df, cols)

    def transform_observed(self, df: DataFrame) -> DataFrame:
        """``transform`` plus the share of ``Other`` per column, observed on the
        caller's next action; ``check_drift()`` then warns like the reference."""
        out = self.transform(df)
        cols = [c for c in self.getInputCols() if c in df.columns]
        if not cols:
            return out
        self.observation = Observation(f"other_ratio_{uuid.uuid4().hex[:8]}")
        return out.observe(self.observation, *[
            F.avg(F.coalesce(F.col(c) == F.lit(OTHER), F.lit(False)).cast("double"))
            .alias(c) for c in cols])

    def drift_report(self, df: DataFrame) -> DataFrame:
        """(column, other_ratio, max_other_ratio, exceeded) for a transformed table."""
        cols = [c for c in self.getInputCols() if c in df.columns]
        r = float(self.getMaxOtherRatio())
        row = df.agg(*[F.avg(F.coalesce(F.col(c) == F.lit(OTHER), F.lit(False)).cast("double"))
                       .alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        rep = row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, other_ratio)")
        return rep.select("column", "other_ratio", F.lit(r).alias("max_other_ratio"),
                          (F.col("other_ratio") > F.lit(r)).alias("exceeded"))

    def warn_on_drift(self, report_rows) -> list[str]:
        msgs = []
        for row in report_rows:
            if row["exceeded"]:
                msg = drift_message(row["column"], row["other_ratio"], row["max_other_ratio"])
                warnings.warn(msg, RuntimeWarning)
                msgs.append(msg)
        return msgs

    def check_drift(self) -> list[str]:
        """Warn from the observed ratios of the last transform (after an action)."""
        if self.observation is None:
            return []
        ratios = self.observation.get
        rows = [{"column": c, "other_ratio": v or 0.0, "max_other_ratio": self.getMaxOtherRatio(),
                 "exceeded": (v or 0.0) > self.getMaxOtherRatio()} for c, v in ratios.items()]
        return self.warn_on_drift(rows)

    # -- persistence -------------------------------------------------------
    def write(self) -> MLWriter:
        return _RareWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RareReader(cls)

    @classmethod
    def load(cls, path: str) -> "RareCategoriesModel":
        return cls.read().load(path)

    def save(self, path: str) -> None:
        self.write().overwrite().save(path)


class _RareWriter(MLWriter):
    def __init__(self, instance: RareCategoriesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        inline = self.instance.inline
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"inline": json.dumps(inline)})
        if inline is None:
            self.instance.state.write.mode("overwrite").parquet(f"{path}/state")


class _RareReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> RareCategoriesModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        inline = json.loads(meta["inline"])
        state = None if inline is not None else self.sparkSession.read.parquet(f"{path}/state")
        model = RareCategoriesModel(state=state, inline=inline)
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
