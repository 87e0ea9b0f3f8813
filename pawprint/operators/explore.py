"""The exploration table of the notebook as one projection.

All notebook derivations (age in days, month, hour, weekday name and number,
weekend label, time of day, name flag, gender, reproductive status with a
null default, breed type, primary breed/colour, multicolour, kitten season)
are built-in expressions in a single ``select``; per-species analyses then
group by ``AnimalType`` instead of splitting the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.functions import temporal as tf
from pawprint.functions import text as tx


def exploration_table(df: DataFrame, datetime_col: str = "DateTime") -> DataFrame:
    ts = tf.parse_datetime(datetime_col)
    cols = {
        "age_in_days": tx.age_in_days("AgeuponOutcome"),
        "Month": F.month(ts).cast("bigint"),
        "Hour": F.hour(ts).cast("bigint"),
        "Weekday_Name": tf.weekday_name(ts),
        "Weekday_Num": tf.weekday(ts).cast("bigint"),
        "IsWeekend_Label": tf.weekend_label(ts),
        "TimeOfDay": tf.time_of_day(ts),
        "has_name": tx.has_name("Name", unknown_is_missing=False),
        "Gender": tx.gender("SexuponOutcome"),
        "Reproductive_Status": tx.reproductive_status("SexuponOutcome", None),
        "Breed_Type": tx.breed_type("Breed"),
        "Primary_Breed": tx.primary_breed("Breed"),
        "Is_Multicolor": tx.color_kind("Color"),
        "Primary_Color": tx.primary_color("Color"),
        "KittenSeason_Label": tf.kitten_season(ts),
    }
    return df.withColumns(cols)
