"""Record schema of the shelter-outcome table and its fixed names."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for identical results.
TARGET_COL = "OutcomeType"
TARGET = "target"
LEAKAGE_COLS = ("OutcomeType", "OutcomeSubtype")
ID_COLS = ("AnimalID",)
CRITICAL_COLS = ("DateTime", "AnimalType")
GROUP_COL = "AnimalType"
SPECIES = ("Dog", "Cat")
KEY = "rid"

# Text tokens the pandas CSV reader turns into missing values by default
# (case-sensitive; the empty field is nulled by Spark itself).
NA_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

RAW_SCHEMA = T.StructType([
    T.StructField("AnimalID", T.StringType()),
    T.StructField("Name", T.StringType()),
    T.StructField("DateTime", T.StringType()),
    T.StructField("OutcomeType", T.StringType()),
    T.StructField("OutcomeSubtype", T.StringType()),
    T.StructField("AnimalType", T.StringType()),
    T.StructField("SexuponOutcome", T.StringType()),
    T.StructField("AgeuponOutcome", T.StringType()),
    T.StructField("Breed", T.StringType()),
    T.StructField("Color", T.StringType()),
])

# Engineered-table column roles (classifier input before encoding).
NUM_SCALE_COLS = ("Hour_sin", "Hour_cos", "Wday_sin", "Wday_cos", "DoY_sin", "DoY_cos",
                  "log_age_in_days")
CAT_ENCODE_COLS = ("Breed", "Color", "Reproductive_Status")
BINARY_COLS = ("IsWeekend", "is_mix", "has_name")
