"""Registered queries: one per operator group of the survey inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or tables Spark derives from them). The matching DuckDB text
lives next to it (``sql=``) and is the independent oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pawprint.functions import temporal as tf
from pawprint.functions import text as tx
from pawprint.functions.text import OTHER
from pawprint.operators import profile
from pawprint.operators.explore import exploration_table
from pawprint.operators.clean import DataCleaner
from pawprint.operators.ranks import exact_rank
from pawprint.operators.rare import RareCategoriesGrouper, category_counts, frequent_categories
from pawprint.operators.stages import (CategoricalFeaturesEngineer, NameFeaturesExtractor,
                                       SexFeaturesExtractor, TemporalFeaturesExtractor,
                                       primary_values)
from pawprint.plans import oracle as O
from pawprint.sources import io
from pawprint.sources.fixture import record_table
from pawprint.sources.schema import (CRITICAL_COLS, KEY, LEAKAGE_COLS, RAW_SCHEMA, TARGET,
                                     TARGET_COL)
from pawprint.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

R_COLS = ("rid", "AnimalID", "Name", "DateTime", "OutcomeType", "OutcomeSubtype", "AnimalType",
          "SexuponOutcome", "AgeuponOutcome", "Breed", "Color")
QUANTILE_PROBS = (0.5, 0.9, 0.95, 0.99, 0.999)


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    """Round to 6 digits; ``+ 0.0`` turns a -0.0 into +0.0 (as in the oracle)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_table(spark, sf_dir)


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_TEXT_SQL = "strftime(DateTime, '%Y-%m-%d %H:%M:%S.%f')"


def ts_text(df: DataFrame, col: str = "DateTime") -> DataFrame:
    """Timestamp rendered as canonical microsecond text for query output:
    engines convert timestamps to different pandas precisions (ns vs us),
    the text is identical everywhere."""
    return df.withColumn(col, F.date_format(F.col(col), TS_TEXT))


def engineered(spark: SparkSession, sf_dir: str, ratio: float = 0.15) -> DataFrame:
    """K1-K5 fitted and applied on the whole record table (the flagship table)."""
    r = records(spark, sf_dir)
    cleaner = DataCleaner().fit(r)
    x = cleaner.transform(r)
    x = TemporalFeaturesExtractor().transform(x)
    x = CategoricalFeaturesEngineer(maxOtherRatio=ratio).fit(x).transform(x)
    x = SexFeaturesExtractor().transform(x)
    return NameFeaturesExtractor().transform(x)


# --------------------------------------------------------------------- cleaning

@query("clean_age_days", O.with_records(
    f"SELECT rid, {O.r6(O.age_days('AgeuponOutcome'))} AS age_days FROM R"))
def clean_age_days(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("rid", r6(tx.age_in_days("AgeuponOutcome")).alias("age_days"))


@query("clean_imputed", O.with_records(f"""
SELECT rid, coalesce(Name, 'Unknown') AS Name, {TS_TEXT_SQL} AS DateTime, OutcomeType, OutcomeSubtype,
  AnimalType, coalesce(SexuponOutcome, stats.sex_mode) AS SexuponOutcome,
  coalesce(Breed, 'Unknown') AS Breed, coalesce(Color, 'Unknown') AS Color,
  {O.r6("ln(1 + coalesce(" + O.age_days('AgeuponOutcome') + ", stats.age_median))")}
    AS log_age_in_days
FROM R CROSS JOIN stats""", O.cleaner_stats("R")))
def clean_imputed(spark, sf_dir):
    r = records(spark, sf_dir)
    out = DataCleaner().fit(r).transform(r)
    return ts_text(out.withColumn("log_age_in_days", r6("log_age_in_days")))


@query("imputation_counts", O.with_records(f"""
SELECT count(*) FILTER (WHERE SexuponOutcome IS NULL) AS n_missing_sex,
       count(*) FILTER (WHERE {O.age_days('AgeuponOutcome')} IS NULL) AS n_missing_age
FROM R"""))
def imputation_counts(spark, sf_dir):
    r = records(spark, sf_dir)
    model = DataCleaner().fit(r)
    return r.agg(*[c.cast("bigint").alias(n) for c, n in
                   zip(model.imputation_columns(r), ("n_missing_sex", "n_missing_age"))])


@query("raw_csv_round_trip", O.with_records(f"SELECT * REPLACE ({TS_TEXT_SQL} AS DateTime) FROM R"))
def raw_csv_round_trip(spark, sf_dir):
    """Records written as CSV into the shared scratch folder and read back."""
    r = records(spark, sf_dir)
    path = scratch_path(spark, "raw-csv")
    io.write_csv(r, path)
    schema = T.StructType([T.StructField(KEY, T.LongType()), *RAW_SCHEMA.fields])
    back = io.read_raw(spark, path, "csv", schema)
    return ts_text(back.withColumn("DateTime", tf.parse_datetime("DateTime")))


@query("drop_critical_nulls", O.with_records(
    f"SELECT * REPLACE ({TS_TEXT_SQL} AS DateTime) FROM R "
    "WHERE DateTime IS NOT NULL AND AnimalType IS NOT NULL"))
def drop_critical_nulls(spark, sf_dir):
    return ts_text(records(spark, sf_dir).na.drop(how="any", subset=list(CRITICAL_COLS)))


@query("group_table", O.with_records(
    f"SELECT * EXCLUDE (AnimalType) REPLACE ({TS_TEXT_SQL} AS DateTime) FROM R "
    "WHERE AnimalType = 'Dog'"))
def group_table(spark, sf_dir):
    r = records(spark, sf_dir)
    return ts_text(r.filter(F.col("AnimalType") == "Dog").drop("AnimalType"))


@query("target_without_leakage", O.with_records(
    f"SELECT * EXCLUDE (OutcomeType, OutcomeSubtype) REPLACE ({TS_TEXT_SQL} AS DateTime), "
    "OutcomeType AS target FROM R"))
def target_without_leakage(spark, sf_dir):
    r = records(spark, sf_dir)
    io.require_columns(r, [TARGET_COL])
    out = r.withColumn(TARGET, F.col(TARGET_COL)).drop(*[c for c in LEAKAGE_COLS if c in r.columns])
    return ts_text(out)


@query("features_target_check", O.with_records(
    f"SELECT * EXCLUDE (OutcomeType, OutcomeSubtype) REPLACE ({TS_TEXT_SQL} AS DateTime), "
    "OutcomeType AS target FROM R"))
def features_target_check(spark, sf_dir):
    """Features and target as two tables sharing ``rid``, checked and re-joined."""
    r = records(spark, sf_dir)
    feats = r.drop(*LEAKAGE_COLS)
    target = r.select(KEY, F.col(TARGET_COL).alias(TARGET))
    return ts_text(io.align_features_target(feats, target))


@query("alignment_report", O.with_records("""
SELECT sum(f)::BIGINT AS n_features, sum(t)::BIGINT AS n_target,
       count(*) FILTER (WHERE t = 0) AS only_features, count(*) FILTER (WHERE f = 0) AS only_target,
       count(*) FILTER (WHERE f > 1 OR t > 1) AS repeated_keys, 0::BIGINT AS without_key
FROM (SELECT rid, sum(f) AS f, sum(t) AS t FROM (
  SELECT rid, 1 AS f, 0 AS t FROM R UNION ALL SELECT rid, 1, 0 FROM R WHERE rid % 10 = 0
  UNION ALL SELECT rid, 0, 1 FROM R WHERE rid % 7 <> 0) GROUP BY rid)"""))
def alignment_report(spark, sf_dir):
    """Features with repeated keys and a target with missing ones: reported, not joined."""
    keys = records(spark, sf_dir).select(KEY)
    feats = keys.unionByName(keys.filter(F.col(KEY) % 10 == 0))
    return io.alignment_report(feats, keys.filter(F.col(KEY) % 7 != 0))


# Texts that a CSV must quote: doubled quotes, commas, line breaks, outer blanks.
_AWKWARD = "concat(Breed, ' \"', AnimalID, '\", line one' || chr(10) || 'line \"\"two ')"


@query("quoted_csv_round_trip", O.with_records(
    f"SELECT rid, {_AWKWARD} AS Breed, Name FROM R"))
def quoted_csv_round_trip(spark, sf_dir):
    """Quotes and line breaks inside values, through CSV and back."""
    r = records(spark, sf_dir).select(
        KEY, F.concat("Breed", F.lit(' "'), "AnimalID", F.lit('", line one\nline ""two '))
        .alias("Breed"), "Name")
    path = scratch_path(spark, "quoted-csv")
    io.write_csv(r, path)
    schema = T.StructType([T.StructField(KEY, T.LongType()),
                           T.StructField("Breed", T.StringType()),
                           T.StructField("Name", T.StringType())])
    return io.read_raw(spark, path, "csv", schema, multiline=True)


# ------------------------------------------------------------------ temporal

@query("temporal_features", O.with_records(f"""
SELECT rid,
  {O.cyc('hour(DateTime)', '24', 'sin')} AS Hour_sin,
  {O.cyc('hour(DateTime)', '24', 'cos')} AS Hour_cos,
  {O.cyc(O.weekday('DateTime'), '7', 'sin')} AS Wday_sin,
  {O.cyc(O.weekday('DateTime'), '7', 'cos')} AS Wday_cos,
  CAST({O.weekday('DateTime')} >= 5 AS DOUBLE) AS IsWeekend,
  {O.cyc('dayofyear(DateTime)', '365.25', 'sin')} AS DoY_sin,
  {O.cyc('dayofyear(DateTime)', '365.25', 'cos')} AS DoY_cos
FROM R"""))
def temporal_features(spark, sf_dir):
    r = records(spark, sf_dir).select("rid", "DateTime")
    out = TemporalFeaturesExtractor().transform(r)
    return out.select("rid", *[r6(c).alias(c) for c in out.columns if c != "rid"])


@query("temporal_labels", O.with_records(f"""
SELECT rid,
  CASE WHEN coalesce({O.weekday('DateTime')} >= 5, false) THEN 'Weekend' ELSE 'Weekday' END
    AS IsWeekend_Label,
  CASE WHEN hour(DateTime) <= 5 THEN 'Night' WHEN hour(DateTime) <= 11 THEN 'Morning'
       WHEN hour(DateTime) <= 16 THEN 'Afternoon' WHEN hour(DateTime) <= 23 THEN 'Evening' END
    AS TimeOfDay,
  CAST(month(DateTime) AS DOUBLE) AS Month, CAST(hour(DateTime) AS DOUBLE) AS Hour,
  strftime(DateTime, '%a') AS Weekday_Name,
  CAST({O.weekday('DateTime')} AS DOUBLE) AS Weekday_Num,
  CASE WHEN coalesce(dayofyear(DateTime) BETWEEN 91 AND 304, false) THEN 'Kitten Season'
       ELSE 'Out of Season' END AS KittenSeason_Label
FROM R"""))
def temporal_labels(spark, sf_dir):
    """E6-E9. Month / hour / weekday number are null for null dates; they are
    emitted as double so nullable numbers convert alike on both sides."""
    e = exploration_table(records(spark, sf_dir))
    return e.select("rid", "IsWeekend_Label", "TimeOfDay",
                    *[F.col(c).cast("double").alias(c) for c in ("Month", "Hour", "Weekday_Num")],
                    "Weekday_Name", "KittenSeason_Label")


# ---------------------------------------------------------------- text rules

@query("primary_breed_color", O.with_records(f"""
SELECT rid, {O.primary_breed('Breed')} AS Primary_Breed, {O.primary_color('Color')} AS Primary_Color,
  {O.is_mix('Breed')} AS is_mix,
  CASE WHEN {O.is_mix('Breed')} = 1 THEN 'Mixed' ELSE 'Purebred' END AS Breed_Type,
  CASE WHEN coalesce(strpos(Color, '/') > 0, false) THEN 'Multicolor' ELSE 'Single Color' END
    AS Is_Multicolor
FROM R"""))
def primary_breed_color(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("rid", tx.primary_breed("Breed").alias("Primary_Breed"),
                    tx.primary_color("Color").alias("Primary_Color"),
                    tx.is_mix("Breed").alias("is_mix"), tx.breed_type("Breed").alias("Breed_Type"),
                    tx.color_kind("Color").alias("Is_Multicolor"))


@query("sex_features", O.with_records(f"""
SELECT rid, {O.repro('SexuponOutcome')} AS Reproductive_Status,
  {O.repro('SexuponOutcome', None)} AS Reproductive_Status_eda,
  CASE WHEN coalesce(suffix(SexuponOutcome, 'Male'), false) THEN 'Male'
       WHEN coalesce(suffix(SexuponOutcome, 'Female'), false) THEN 'Female' END AS Gender
FROM R"""))
def sex_features(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("rid", tx.reproductive_status("SexuponOutcome").alias("Reproductive_Status"),
                    tx.reproductive_status("SexuponOutcome", None).alias("Reproductive_Status_eda"),
                    tx.gender("SexuponOutcome").alias("Gender"))


@query("name_features", O.with_records(f"""
SELECT rid, {O.has_name('Name')} AS has_name, {O.has_name('Name', False)} AS has_name_eda FROM R"""))
def name_features(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("rid", tx.has_name("Name").alias("has_name"),
                    tx.has_name("Name", unknown_is_missing=False).alias("has_name_eda"))


# ---------------------------------------------------------- rare categories

_PRIMARY_LONG = (f"LB AS (SELECT 'Breed' AS \"column\", {O.primary_breed('Breed')} AS category FROM R "
                 f"UNION ALL SELECT 'Color', {O.primary_color('Color')} FROM R)")


@query("rare_fit", O.with_records(O.rare_kept("LB", 0.15), _PRIMARY_LONG))
def rare_fit(spark, sf_dir):
    prim = primary_values(records(spark, sf_dir).select("Breed", "Color"))
    return RareCategoriesGrouper(["Breed", "Color"], 0.15).fit_state(prim)


@query("rare_transform", O.with_records(f"""
SELECT R.rid, {O.is_mix('R.Breed')} AS is_mix,
  CASE WHEN kb.category IS NOT NULL OR R.Breed IS NULL THEN {O.primary_breed('R.Breed')}
       ELSE 'Other' END AS Breed,
  CASE WHEN kc.category IS NOT NULL OR R.Color IS NULL THEN {O.primary_color('R.Color')}
       ELSE 'Other' END AS Color
FROM R
LEFT JOIN (SELECT category FROM K WHERE "column" = 'Breed') kb ON kb.category = {O.primary_breed('R.Breed')}
LEFT JOIN (SELECT category FROM K WHERE "column" = 'Color') kc ON kc.category = {O.primary_color('R.Color')}
""", _PRIMARY_LONG + ",\nK AS (" + O.rare_kept("LB", 0.15) + ")"))
def rare_transform(spark, sf_dir):
    r = records(spark, sf_dir).select("rid", "Breed", "Color")
    return CategoricalFeaturesEngineer(maxOtherRatio=0.15).fit(r).transform(r)


_DRIFT_LONG = (
    f"LB AS (SELECT 'Breed' AS \"column\", {O.primary_breed('Breed')} AS category FROM R "
    f"WHERE AnimalType = 'Dog' UNION ALL SELECT 'Color', {O.primary_color('Color')} FROM R "
    f"WHERE AnimalType = 'Dog'),\nK AS ({O.rare_kept('LB', 0.15)})")


def _other_share(col: str, expr: str) -> str:
    return (f"avg(CASE WHEN {expr} NOT IN (SELECT category FROM K WHERE \"column\" = '{col}') "
            f"THEN 1.0 ELSE 0.0 END)")


_DRIFT_SELECT = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {O.r6(_other_share(c, e))} AS other_ratio, "
    f"CAST(0.15 AS DOUBLE) AS max_other_ratio, {_other_share(c, e)} > 0.15 AS exceeded "
    f"FROM R WHERE AnimalType = 'Cat'"
    for c, e in (("Breed", O.primary_breed("Breed")), ("Color", O.primary_color("Color"))))


@query("rare_drift_report", O.with_records(_DRIFT_SELECT, _DRIFT_LONG))
def rare_drift_report(spark, sf_dir):
    """Fit the lists on dogs, apply them to cats: the Other share per column."""
    r = records(spark, sf_dir).select("AnimalType", "Breed", "Color")
    model = CategoricalFeaturesEngineer(maxOtherRatio=0.15).fit(r.filter(F.col("AnimalType") == "Dog"))
    out = model.transform(r.filter(F.col("AnimalType") == "Cat"))
    rep = model.grouper.drift_report(out)
    return rep.withColumn("other_ratio", r6("other_ratio"))


@query("rare_fit_documents", f"""
WITH LB AS (SELECT 'source' AS "column", source AS category FROM documents
            UNION ALL SELECT 'p_brand', p_brand FROM part)
{O.rare_kept('LB', 0.15)}""")
def rare_fit_documents(spark, sf_dir):
    docs = io.read_table(spark, sf_dir, "documents")
    part = io.read_table(spark, sf_dir, "part")
    counts = category_counts(docs, ["source"]).unionByName(category_counts(part, ["p_brand"]))
    return frequent_categories(counts, 0.15)


@query("engineered_table", O.with_records(O.engineered_select(), O.engineered_cte()))
def engineered_table(spark, sf_dir):
    e = engineered(spark, sf_dir)
    dbl = [c for c, t in e.dtypes if t == "double"]
    return e.withColumns({c: r6(c) for c in dbl})


# ----------------------------------------------------------------- profiling

@query("value_counts", O.with_records(
    "SELECT OutcomeType AS value, count(*) AS n FROM R WHERE OutcomeType IS NOT NULL GROUP BY 1"))
def value_counts(spark, sf_dir):
    return profile.value_counts(records(spark, sf_dir), "OutcomeType")


@query("value_counts_nulls", O.with_records(
    "SELECT AnimalType, SexuponOutcome AS value, count(*) AS n FROM R GROUP BY 1, 2"))
def value_counts_nulls(spark, sf_dir):
    return profile.value_counts(records(spark, sf_dir), "SexuponOutcome", by="AnimalType",
                                dropna=False)


@query("value_shares", O.with_records(
    "SELECT OutcomeType AS value, count(*) AS n, "
    "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 6) AS pct FROM R "
    "WHERE OutcomeType IS NOT NULL GROUP BY 1"))
def value_shares(spark, sf_dir):
    out = profile.value_shares(records(spark, sf_dir), "OutcomeType", percent=True)
    return out.withColumn("pct", r6("pct"))


_BINNED_PER_SPECIES = (
    f"LB AS (SELECT AnimalType, {O.primary_breed('Breed')} AS category FROM R "
    f"WHERE AnimalType IS NOT NULL),\n"
    f"K AS ({O.rare_kept('LB', 0.15, 'AnimalType')}),\n"
    f"B AS (SELECT LB.AnimalType, CASE WHEN K.category IS NOT NULL OR LB.category IS NULL "
    f"THEN LB.category ELSE 'Other' END AS value FROM LB LEFT JOIN K "
    f"ON K.AnimalType = LB.AnimalType AND K.category = LB.category)")


@query("value_shares_binned", O.with_records(
    "SELECT AnimalType, value, count(*) AS n, "
    "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY AnimalType), 6) AS share, "
    "CAST(row_number() OVER (PARTITION BY AnimalType ORDER BY value = 'Other', count(*) DESC, value)"
    " AS BIGINT) AS position FROM B WHERE value IS NOT NULL GROUP BY 1, 2", _BINNED_PER_SPECIES))
def value_shares_binned(spark, sf_dir):
    """Primary-breed shares per species after a per-species rare grouping,
    ``Other`` listed last (one grouped fit, one grouped count)."""
    r = records(spark, sf_dir).filter(F.col("AnimalType").isNotNull())
    prim = r.select("AnimalType", tx.primary_breed("Breed").alias("Primary_Breed"))
    kept = frequent_categories(category_counts(prim, ["Primary_Breed"], by=["AnimalType"]), 0.15)
    kept = kept.select("AnimalType", F.col("category").alias("Primary_Breed"),
                       F.lit(True).alias("_kept"))
    binned = prim.join(kept, ["AnimalType", "Primary_Breed"], "left").select(
        "AnimalType", tx.keep_or_other("Primary_Breed", F.coalesce("_kept", F.lit(False)))
        .alias("Primary_Breed"))
    shares = profile.value_shares(binned, "Primary_Breed", by="AnimalType")
    ranked = exact_rank(shares, ["AnimalType"], [F.col("value") == F.lit(OTHER), -F.col("n"),
                                                 F.col("value")], "position")
    return ranked.select("AnimalType", "value", "n", r6("share").alias("share"), "position")


def _null_profile_sql(only_missing: bool) -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS non_null, "
             f"count(*) - count({c}) AS nulls FROM R" for c in R_COLS]
    body = " UNION ALL ".join(parts)
    if only_missing:
        body = f'SELECT "column", nulls FROM ({body}) WHERE nulls > 0'
    return O.with_records(body)


@query("null_profile", _null_profile_sql(True))
def null_profile(spark, sf_dir):
    return profile.null_profile(records(spark, sf_dir))


@query("column_overview", _null_profile_sql(False))
def column_overview(spark, sf_dir):
    return io.column_overview(records(spark, sf_dir)).drop("dtype")


@query("distinct_by_group", O.with_records(
    "SELECT AnimalType, count(DISTINCT Breed) AS n_Breed, count(DISTINCT Color) AS n_Color "
    "FROM R GROUP BY 1"))
def distinct_by_group(spark, sf_dir):
    return profile.distinct_counts(records(spark, sf_dir), ["Breed", "Color"], by="AnimalType")


@query("top_values_by_group", O.with_records(
    "SELECT * FROM (SELECT AnimalType, Breed AS value, count(*) AS n, "
    "row_number() OVER (PARTITION BY AnimalType ORDER BY count(*) DESC, Breed) AS rank "
    "FROM R WHERE AnimalType IS NOT NULL AND Breed IS NOT NULL GROUP BY 1, 2) WHERE rank <= 30"))
def top_values_by_group(spark, sf_dir):
    r = records(spark, sf_dir).filter(F.col("AnimalType").isNotNull())
    out = profile.top_values(r, "Breed", 30, by="AnimalType")
    return out.withColumn("rank", F.col("rank").cast("bigint"))


# ----------------------------------------------------------- cross tables

def eda_table(spark, sf_dir) -> DataFrame:
    """Exploration columns of the records (notebook derivations)."""
    return exploration_table(records(spark, sf_dir))


_EDA_SQL = (
    f"D AS (SELECT AnimalType, OutcomeType, SexuponOutcome, "
    f"CAST(month(DateTime) AS BIGINT) AS Month, CAST(hour(DateTime) AS BIGINT) AS Hour, "
    f"strftime(DateTime, '%a') AS Weekday_Name, {O.has_name('Name', False)} AS has_name, "
    f"{O.repro('SexuponOutcome', None)} AS Reproductive_Status, "
    f"CASE WHEN {O.is_mix('Breed')} = 1 THEN 'Mixed' ELSE 'Purebred' END AS Breed_Type, "
    f"CASE WHEN coalesce({O.weekday('DateTime')} >= 5, false) THEN 'Weekend' ELSE 'Weekday' END "
    f"AS IsWeekend_Label FROM R)")

CROSSTAB_KEYS = ("SexuponOutcome", "Month", "Weekday_Name", "Hour", "has_name",
                 "Reproductive_Status", "Breed_Type", "IsWeekend_Label")


def _crosstab_sql(key: str, by_species: bool) -> str:
    g = "AnimalType, " if by_species else ""
    where = "AnimalType IS NOT NULL AND " if by_species else ""
    part = "AnimalType, " if by_species else ""
    return O.with_records(
        f"SELECT {g}{key} AS row_value, OutcomeType AS col_value, count(*) AS n, "
        f"round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY {part}{key}), 6) AS share "
        f"FROM D WHERE {where}{key} IS NOT NULL AND OutcomeType IS NOT NULL "
        f"GROUP BY {g}{key}, OutcomeType",
        _EDA_SQL)


def _crosstab_query(key: str, by_species: bool) -> QueryFn:
    def run(spark, sf_dir):
        d = eda_table(spark, sf_dir)
        if by_species:
            d = d.filter(F.col("AnimalType").isNotNull())
        out = profile.crosstab(d, key, "OutcomeType", by="AnimalType" if by_species else None)
        return out.withColumn("share", r6("share"))
    run.__name__ = f"crosstab_{key}"
    return run


query("crosstab_AnimalType", _crosstab_sql("AnimalType", False))(
    _crosstab_query("AnimalType", False))
for _k in CROSSTAB_KEYS:
    query(f"crosstab_{_k}", _crosstab_sql(_k, True))(_crosstab_query(_k, True))


OUTCOMES = ("Adoption", "Euthanasia", "Transfer")


@query("crosstab_wide_status", O.with_records(
    "SELECT AnimalType, Reproductive_Status, " + ", ".join(
        f"round(CAST(count(*) FILTER (WHERE OutcomeType = '{o}') AS DOUBLE) / count(*), 6) AS {o}"
        for o in OUTCOMES)
    + " FROM D WHERE AnimalType IS NOT NULL AND Reproductive_Status IS NOT NULL "
      "AND OutcomeType IS NOT NULL GROUP BY 1, 2", _EDA_SQL))
def crosstab_wide_status(spark, sf_dir):
    """F10 in wide form, over the labels present in the data (absent pairs 0)."""
    d = eda_table(spark, sf_dir).filter(F.col("AnimalType").isNotNull())
    out = profile.crosstab_wide(d, "Reproductive_Status", "OutcomeType", by="AnimalType")
    return out.select("AnimalType", "Reproductive_Status", *[r6(o).alias(o) for o in OUTCOMES])


@query("crosstab_wide_listed", O.with_records(
    "SELECT AnimalType, Reproductive_Status, round(CAST(count(*) FILTER (WHERE OutcomeType = "
    "'Transfer') AS DOUBLE) / count(*), 6) AS Transfer FROM D WHERE AnimalType IS NOT NULL "
    "AND Reproductive_Status IS NOT NULL AND OutcomeType IS NOT NULL GROUP BY 1, 2", _EDA_SQL))
def crosstab_wide_listed(spark, sf_dir):
    """A listed label that does not cover the data: shares stay shares of all rows."""
    d = eda_table(spark, sf_dir).filter(F.col("AnimalType").isNotNull())
    out = profile.crosstab_wide(d, "Reproductive_Status", "OutcomeType", ("Transfer",),
                                by="AnimalType")
    return out.select("AnimalType", "Reproductive_Status", r6("Transfer").alias("Transfer"))


# --------------------------------------------------------------- quantiles

def _age_table(spark, sf_dir) -> DataFrame:
    r = records(spark, sf_dir).filter(F.col("AnimalType").isNotNull())
    return r.select("AnimalType", tx.age_in_days("AgeuponOutcome").alias("age_in_days"))


_AGE_SQL = f"A AS (SELECT AnimalType, {O.age_days('AgeuponOutcome')} AS x FROM R " \
           f"WHERE AnimalType IS NOT NULL)"


def _quantile_union(table: str, key: str, probs) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, CAST({p!r} AS DOUBLE) AS prob, round(quantile_cont(x, {p!r}), 6) AS value "
        f"FROM {table} WHERE x IS NOT NULL GROUP BY 1" for p in probs)


@query("age_quantiles", O.with_records(_quantile_union("A", "AnimalType", QUANTILE_PROBS), _AGE_SQL))
def age_quantiles(spark, sf_dir):
    out = profile.quantiles(_age_table(spark, sf_dir), "age_in_days", QUANTILE_PROBS, by="AnimalType")
    return out.withColumn("value", r6("value"))


@query("age_box", O.with_records("""
SELECT Q.AnimalType, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (WHERE NOT (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers,
  count(*) AS n
FROM A JOIN (SELECT AnimalType, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med,
                    quantile_cont(x, 0.75) AS q3 FROM A WHERE x IS NOT NULL GROUP BY 1) Q
  ON Q.AnimalType = A.AnimalType
WHERE x IS NOT NULL GROUP BY Q.AnimalType, q1, med, q3""", _AGE_SQL))
def age_box(spark, sf_dir):
    out = profile.box_summary(_age_table(spark, sf_dir), "age_in_days", by="AnimalType")
    return out.select("AnimalType", *[r6(c).alias(c) for c in
                                      ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                      "n_outliers", "n")


@query("age_histogram", O.with_records("""
SELECT G.AnimalType, CAST(G.bin AS BIGINT) AS bin,
  round(G.lo + (G.bin - 1) * ((G.hi - G.lo) / 50), 6) AS bin_lo,
  round(G.lo + G.bin * ((G.hi - G.lo) / 50), 6) AS bin_hi,
  coalesce(N.n, 0) AS n
FROM (SELECT AnimalType, lo, hi, unnest(range(1, 51)) AS bin FROM
        (SELECT AnimalType, min(x) AS lo, max(x) AS hi FROM A WHERE x IS NOT NULL GROUP BY 1)) G
LEFT JOIN (
  SELECT A.AnimalType,
    CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(50 * (x - lo) / (hi - lo)) AS BIGINT) + 1, 50) END AS bin,
    count(*) AS n
  FROM A JOIN (SELECT AnimalType, min(x) AS lo, max(x) AS hi FROM A WHERE x IS NOT NULL GROUP BY 1) M
    ON M.AnimalType = A.AnimalType
  WHERE x IS NOT NULL GROUP BY 1, 2) N ON N.AnimalType = G.AnimalType AND N.bin = G.bin""", _AGE_SQL))
def age_histogram(spark, sf_dir):
    out = profile.histogram(_age_table(spark, sf_dir), "age_in_days", 50, by="AnimalType")
    return out.withColumn("bin_lo", r6("bin_lo")).withColumn("bin_hi", r6("bin_hi"))


@query("quantiles_lineitem",
       "WITH A AS (SELECT l_returnflag, l_extendedprice AS x FROM lineitem) "
       + _quantile_union("A", "l_returnflag", QUANTILE_PROBS))
def quantiles_lineitem(spark, sf_dir):
    li = io.read_table(spark, sf_dir, "lineitem")
    # Prices are an unbounded domain: exact distributed selection, not one
    # in-memory value map per return flag.
    out = profile.quantiles(li, "l_extendedprice", QUANTILE_PROBS, by="l_returnflag",
                            method="selection")
    return out.withColumn("value", r6("value"))
