"""Exact ranks inside groups of any size, without one task per group.

A window over a whole group puts all of it into one task. Here a sample of
the group's rows, chosen by hash and bounded in number, cuts its order into
ranges; a small histogram of the ranges gives the rows before each, and a
row's rank is that offset plus its rank inside its range, a window over one
range. The sample decides the balance only, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cuts of a group: a range holds about 1/512 of it, rarely more than ten times that.
CUTS = 512


def exact_rank(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn",
               cuts: int = CUTS) -> DataFrame:
    """``df`` with ``name``: the 1-based rank of the row in its group by ``order``, ascending.

    ``order`` must tell rows of a group apart (rows equal in it share no defined
    order, as in any window). Rows with a null key are left out.
    """
    x = df.withColumn("_o", F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)]))
    by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64("_o"), "_o")
    some = (x.select(*keys, "_o").withColumn("_r", F.row_number().over(by_hash))
            .filter(F.col("_r") <= cuts)
            .groupBy(*keys).agg(F.sort_array(F.collect_list("_o")).alias("_cuts")))
    x = (x.join(some, keys).withColumn("_range", F.size(F.filter(
        "_cuts", lambda c: c <= F.col("_o")))).drop("_cuts"))
    ranges = x.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy("_o"))
    return (x.join(ranges, [*keys, "_range"])
            .withColumn(name, (F.col("_before") + inside).cast("bigint"))
            .drop("_o", "_range", "_before"))
