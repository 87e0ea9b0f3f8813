"""Column functions: literal expectations of the reference's unit tests."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pawprint.functions import temporal as tf
from pawprint.functions import text as tx


def col_values(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn("x")).collect()]


def test_age_standard_units(spark):
    assert col_values(spark, ["1 year", "2 months", "3 weeks", "5 days"], tx.age_in_days) == \
        [365.0, 60.0, 21.0, 5.0]


def test_age_case_and_spaces(spark):
    assert col_values(spark, ["1 YEAR", "  2 months  ", "1 day", "10 DAYS"], tx.age_in_days) == \
        [365.0, 60.0, 1.0, 10.0]


def test_age_invalid_is_null(spark):
    assert col_values(spark, [None, "Unknown", "5 units"], tx.age_in_days) == [None, None, None]


def test_age_unit_priority_not_position(spark):
    assert col_values(spark, ["3 months 2 years", "1.5 years"], tx.age_in_days) == [1095.0, 365.0]


def test_age_all_null_gives_null_double(spark):
    df = spark.createDataFrame([(None,), (None,)], "x string")
    out = df.select(tx.age_in_days("x").alias("d"))
    assert dict(out.dtypes)["d"] == "double"
    assert [r.d for r in out.collect()] == [None, None]


def test_primary_color(spark):
    assert col_values(spark, ["Black/White", "Brown Tabby/White", "Blue", "\tRed /x"],
                      tx.primary_color) == ["Black", "Brown Tabby", "Blue", "Red"]


def test_primary_breed(spark):
    got = col_values(spark, ["Labrador Retriever/German Shepherd", "Chihuahua Shorthair Mix",
                             "Siamese", "Lab  MIX/Beagle", "Mix", "Lab Mix ", None],
                     tx.primary_breed)
    assert got == ["Labrador Retriever", "Chihuahua Shorthair", "Siamese", "Lab", "Mix",
                   "Lab Mix", None]


def test_is_mix(spark):
    assert col_values(spark, ["Pit Bull Mix", "Lab/Poodle", "Siamese", None, "mixed breed"],
                      tx.is_mix) == [1, 1, 0, 0, 1]


def test_reproductive_status(spark):
    vals = ["Neutered Male", "Spayed Female", "Intact Male", "Unknown", None]
    assert col_values(spark, vals, tx.reproductive_status) == \
        ["Neutered/Spayed", "Neutered/Spayed", "Intact", "Unknown", "Unknown"]
    assert col_values(spark, vals, lambda c: tx.reproductive_status(c, None)) == \
        ["Neutered/Spayed", "Neutered/Spayed", "Intact", None, None]


def test_gender_suffix_is_case_sensitive(spark):
    assert col_values(spark, ["Neutered Male", "Spayed Female", "Unknown", None], tx.gender) == \
        ["Male", "Female", None, None]


def test_has_name(spark):
    vals = ["Bella", "   ", None, "Unknown", "UNKNOWN"]
    assert col_values(spark, vals, tx.has_name) == [1, 0, 0, 0, 0]
    assert col_values(spark, vals, lambda c: tx.has_name(c, False)) == [1, 0, 0, 1, 1]


def _ts(*args):
    return dt.datetime(*args)


def test_weekend_flag(spark):
    # Monday, Friday, Saturday, Sunday
    days = [_ts(2024, 1, 1, 10), _ts(2024, 1, 5, 10), _ts(2024, 1, 6, 10), _ts(2024, 1, 7, 10)]
    assert col_values(spark, days, tf.is_weekend, "timestamp_ntz") == [0.0, 0.0, 1.0, 1.0]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-07",)], "x string")
    out = df.select(tf.weekday(tf.parse_datetime("x")).alias("w")).collect()
    assert [r.w for r in out] == [0, 6]


def test_cyclic_hour(spark):
    hours = [_ts(2024, 1, 1, h) for h in (0, 6, 12)]
    sins = col_values(spark, hours, lambda c: tf.cyclic(F.hour(c), 24)[0], "timestamp_ntz")
    coss = col_values(spark, hours, lambda c: tf.cyclic(F.hour(c), 24)[1], "timestamp_ntz")
    assert sins == pytest.approx([0.0, 1.0, 0.0], abs=1e-7)
    assert coss == pytest.approx([1.0, 0.0, -1.0], abs=1e-7)


def test_cyclic_day_of_year(spark):
    days = [_ts(2024, 1, 1), _ts(2024, 4, 9)]  # day 1 and day 100
    sins = col_values(spark, days, lambda c: tf.cyclic(F.dayofyear(c), 365.25)[0], "timestamp_ntz")
    assert sins == pytest.approx([math.sin(2 * math.pi / 365.25),
                                  math.sin(2 * math.pi * 100 / 365.25)], abs=1e-7)


def test_null_date_gives_null(spark):
    assert col_values(spark, [None], tf.is_weekend, "timestamp_ntz") == [None]
    assert col_values(spark, [None], tf.weekend_label, "timestamp_ntz") == ["Weekday"]
    assert col_values(spark, [None], tf.kitten_season, "timestamp_ntz") == ["Out of Season"]


def test_bad_date_text(spark):
    df = spark.createDataFrame([("not a date",)], "x string")
    assert df.select(tf.parse_datetime("x", "null")).first()[0] is None
    with pytest.raises(Exception):
        df.select(tf.parse_datetime("x")).collect()


def test_time_of_day_bins(spark):
    hours = [_ts(2024, 1, 1, h) for h in (0, 5, 6, 11, 12, 16, 17, 23)]
    assert col_values(spark, hours, tf.time_of_day, "timestamp_ntz") == \
        ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]
