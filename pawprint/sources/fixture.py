"""The shelter-record table derived from the driver tables ``events`` and ``part``.

The driver tables hold no animal records, so the raw schema is derived by
fixed rules from each event and one part. The work grows with both tables: an
event's part is a fixed permutation of its id over all part keys, and Spark
chooses the join by the sizes it finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pawprint.sources.io import read_table

# Fixed rule parameter of the derived table: a prime above any common divisor.
STRIDE = 7919


def _case(value: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        cond = value == F.lit(k)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr if default is None else expr.otherwise(default)


def records_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """Shelter records with the raw schema plus the row key ``rid``."""
    eid = F.col("event_id")
    # Reduced before it is multiplied: no bigint overflow on huge ids.
    n_parts = F.lit(max(1, part.count()))
    part_key = ((eid % n_parts) * STRIDE) % n_parts
    parts = part.select("p_partkey", "p_name", "p_type", "p_size")
    ev = events.select("event_id", "ts", "user_id", "event_type").withColumn("_pk", part_key)
    joined = ev.join(parts, F.col("_pk") == F.col("p_partkey"), "inner")

    name = (F.when(eid % 7 == 0, F.lit(None).cast("string"))
            .when(eid % 11 == 0, F.lit("Unknown"))
            .when(eid % 13 == 0, F.lit("  "))
            .otherwise(F.concat(F.lit("N"), F.col("user_id").cast("string"))))
    outcome = (F.when(F.col("event_type").isin("click", "view", "signup"), F.lit("Adoption"))
               .when(F.col("event_type") == "purchase", F.lit("Transfer"))
               .otherwise(F.lit("Euthanasia")))
    animal = (F.when(eid % 101 == 0, F.lit(None).cast("string"))
              .when(F.col("user_id") % 2 == 0, F.lit("Dog")).otherwise(F.lit("Cat")))
    sex = _case(eid % 6, {0: F.lit("Neutered Male"), 1: F.lit("Spayed Female"),
                          2: F.lit("Intact Male"), 3: F.lit("Intact Female"),
                          4: F.lit("Unknown")})
    unit = _case(eid % 4, {0: F.lit(" years"), 1: F.lit(" MONTHS"), 2: F.lit(" weeks")},
                 F.lit(" day"))
    age = (F.when(eid % 9 == 7, F.lit("Unknown"))
           .when(eid % 9 == 8, F.lit(None).cast("string"))
           .otherwise(F.concat((F.lit(1) + eid % 12).cast("string"), unit)))
    breed_suffix = _case(F.col("p_partkey") % 3,
                         {0: F.lit(" Mix"), 1: F.concat(F.lit("/"), F.col("p_type"))}, F.lit(""))
    color_suffix = F.when(F.col("p_size") % 2 == 0, F.lit("/White")).otherwise(F.lit(""))

    return joined.select(
        eid.alias("rid"),
        F.concat(F.lit("A"), eid.cast("string")).alias("AnimalID"),
        name.alias("Name"),
        F.when(eid % 97 == 0, F.lit(None)).otherwise(F.col("ts")).alias("DateTime"),
        outcome.alias("OutcomeType"),
        F.when(eid % 2 == 0, F.lit("Partner")).alias("OutcomeSubtype"),
        animal.alias("AnimalType"),
        sex.alias("SexuponOutcome"),
        age.alias("AgeuponOutcome"),
        F.concat(F.col("p_name"), breed_suffix).alias("Breed"),
        F.concat(F.col("p_type"), color_suffix).alias("Color"),
    )


def record_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from(read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "part"))


# The same derivation as SQL text, used as the independent oracle (DuckDB).
RECORDS_SQL = """
SELECT
  e.event_id AS rid,
  'A' || CAST(e.event_id AS VARCHAR) AS AnimalID,
  CASE WHEN e.event_id % 7 = 0 THEN NULL
       WHEN e.event_id % 11 = 0 THEN 'Unknown'
       WHEN e.event_id % 13 = 0 THEN '  '
       ELSE 'N' || CAST(e.user_id AS VARCHAR) END AS Name,
  CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.ts END AS DateTime,
  CASE WHEN e.event_type IN ('click', 'view', 'signup') THEN 'Adoption'
       WHEN e.event_type = 'purchase' THEN 'Transfer' ELSE 'Euthanasia' END AS OutcomeType,
  CASE WHEN e.event_id % 2 = 0 THEN 'Partner' END AS OutcomeSubtype,
  CASE WHEN e.event_id % 101 = 0 THEN NULL
       WHEN e.user_id % 2 = 0 THEN 'Dog' ELSE 'Cat' END AS AnimalType,
  CASE e.event_id % 6 WHEN 0 THEN 'Neutered Male' WHEN 1 THEN 'Spayed Female'
       WHEN 2 THEN 'Intact Male' WHEN 3 THEN 'Intact Female' WHEN 4 THEN 'Unknown' END
    AS SexuponOutcome,
  CASE WHEN e.event_id % 9 = 7 THEN 'Unknown' WHEN e.event_id % 9 = 8 THEN NULL
       ELSE CAST(1 + e.event_id % 12 AS VARCHAR) ||
            CASE e.event_id % 4 WHEN 0 THEN ' years' WHEN 1 THEN ' MONTHS'
                 WHEN 2 THEN ' weeks' ELSE ' day' END END AS AgeuponOutcome,
  p.p_name || CASE p.p_partkey % 3 WHEN 0 THEN ' Mix' WHEN 1 THEN '/' || p.p_type ELSE '' END
    AS Breed,
  p.p_type || CASE WHEN p.p_size % 2 = 0 THEN '/White' ELSE '' END AS Color
FROM events e JOIN part p ON p.p_partkey =
  ((e.event_id % (SELECT count(*) FROM part)) * 7919) % (SELECT count(*) FROM part)
"""
