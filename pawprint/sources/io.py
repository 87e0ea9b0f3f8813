"""Scans and sinks: raw records, feature/target pairs, splits, JSON sidecars."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pawprint.sources.quoted import read_quoted
from pawprint.sources.schema import KEY, NA_TOKENS, RAW_SCHEMA, TARGET


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def null_na_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Turn pandas-style missing tokens (``NA``, ``None``, ...) into SQL null."""
    toks = [F.lit(t) for t in tokens]
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(F.col(f.name).isin(*toks), F.lit(None)).otherwise(F.col(f.name))
                        .alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_raw(spark: SparkSession, path: str, fmt: str = "csv",
             schema: T.StructType | None = RAW_SCHEMA, multiline: bool = False) -> DataFrame:
    """Read the raw record file (CSV with header, or parquet).

    CSV: the header line names the columns (a one-line read, no inference
    pass over the data); known columns get their declared type, others are
    strings. Whitespace is kept as is, doubled quotes inside quotes are one
    quote, and the NA tokens become null (CSV only: parquet has real nulls).
    ``multiline`` is for files with line breaks inside quotes: their splits are
    read in parallel, in two passes (``sources.quoted``). A column absent from the file stays absent (so a
    missing target is detected).
    """
    if fmt == "csv":
        reader = (spark.read.option("header", True).option("mode", "FAILFAST")
                  .option("escape", '"').option("multiLine", multiline))
        if schema is not None:
            header = reader.csv(path).columns
            known = {f.name: f for f in schema.fields}
            schema = T.StructType([known.get(c, T.StructField(c, T.StringType()))
                                   for c in header])
            if multiline:
                return null_na_tokens(read_quoted(spark, path, schema))
            reader = reader.schema(schema)
        return null_na_tokens(reader.csv(path))
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported format {fmt!r}")


def with_row_key(df: DataFrame, key: str = KEY, from_col: str | None = None) -> DataFrame:
    """Attach a row key: an existing id column, or a hash of the row's values.

    The hash does not depend on how the file is laid out. Equal rows get
    different keys by their number among their equals, which of them gets
    which being all the same.
    """
    if key in df.columns:
        return df
    if from_col is not None:
        return df.withColumn(key, F.col(from_col))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    again = Window.partitionBy("_h").orderBy("_h")
    return (df.withColumn("_h", whole).withColumn("_k", F.row_number().over(again))
            .withColumn(key, F.when(F.col("_k") == 1, F.col("_h"))
                        .otherwise(F.xxhash64("_h", "_k"))).drop("_h", "_k"))


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input file") -> None:
    """Driver-side schema check; ``KeyError`` like a missing pandas column."""
    for c in cols:
        if c not in df.columns:
            raise KeyError(f"Target column '{c}' missing from {what}.")


def alignment_report(features: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """One row: rows on either side, keys on one side only, keys that occur
    more than once on a side, and rows without a key.

    Counted per key on each side before any join, in one shuffle.
    """
    side = lambda df, f, t: df.select(
        F.col(key), F.lit(f).alias("_f"), F.lit(t).alias("_t"))
    per_key = (side(features, 1, 0).unionByName(side(target, 0, 1)).groupBy(key)
               .agg(F.sum("_f").alias("_f"), F.sum("_t").alias("_t")))
    null, f, t = F.col(key).isNull(), F.col("_f"), F.col("_t")
    big = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return per_key.agg(
        big(F.sum(f)).alias("n_features"), big(F.sum(t)).alias("n_target"),
        big(F.count_if(~null & (t == 0))).alias("only_features"),
        big(F.count_if(~null & (f == 0))).alias("only_target"),
        big(F.count_if(~null & ((f > 1) | (t > 1)))).alias("repeated_keys"),
        big(F.sum(F.when(null, f + t))).alias("without_key"))


def align_features_target(features: DataFrame, target: DataFrame, key: str = KEY,
                          target_col: str = TARGET) -> DataFrame:
    """Pair features with targets by key; ``ValueError`` unless every key occurs
    exactly once on both sides. The returned table is the inner join (lazy)."""
    r = alignment_report(features, target, key).first()
    if r["n_features"] != r["n_target"] or r["only_target"] or r["only_features"] \
            or r["repeated_keys"] or r["without_key"]:
        raise ValueError(
            f"Features ({r['n_features']} rows) and target ({r['n_target']} rows) "
            f"are misaligned ({r['only_features']} keys only in features, "
            f"{r['only_target']} only in target, {r['repeated_keys']} repeated, "
            f"{r['without_key']} rows without a key).")
    return features.join(target.select(key, target_col), key, "inner")


def write_split(df: DataFrame, out: str, split_col: str = "split", mode: str = "overwrite") -> None:
    """One parquet table partitioned by split: readers prune by ``split = 'test'``."""
    df.write.mode(mode).partitionBy(split_col).parquet(out)


def write_csv(df: DataFrame, out: str, mode: str = "overwrite") -> None:
    """CSV with header, whitespace kept (Spark trims by default) and full
    microsecond timestamps (the default format would cut them to millis)."""
    (df.write.mode(mode).option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
     .option("escape", '"').option("emptyValue", "").csv(out))


def write_four_way_csv(df: DataFrame, out_dir: str, key: str = KEY, split_col: str = "split",
                       target_col: str = TARGET) -> dict[str, str]:
    """The four-file layout: train/test features and train/test target.

    Each file keeps the row key so features and target re-join exactly.
    """
    paths = {}
    base = out_dir.rstrip("/")
    feats = [c for c in df.columns if c not in (split_col, target_col)]
    for part in ("train", "test"):
        sub = df.filter(F.col(split_col) == part)
        paths[f"{part}_features"] = f"{base}/{part}_features.csv"
        paths[f"{part}_target"] = f"{base}/{part}_target.csv"
        write_csv(sub.select(*feats), paths[f"{part}_features"])
        write_csv(sub.select(key, target_col), paths[f"{part}_target"])
    return paths


def write_json_row(spark: SparkSession, record: dict, out: str) -> None:
    """One-row JSON sidecar (metrics, model metadata) via the DataFrame writer."""
    payload = json.dumps(record, default=str, sort_keys=True)
    (spark.createDataFrame([(payload,)], "value string")
     .coalesce(1).write.mode("overwrite").text(out))


def read_json_row(spark: SparkSession, path: str) -> dict:
    row = spark.read.text(path).first()
    return json.loads(row["value"])


def column_overview(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, nulls) for every column, one aggregation job."""
    aggs = []
    for c in df.columns:
        aggs.append(F.count(F.col(c)).alias(f"nn_{c}"))
    n = F.count(F.lit(1)).alias("_n")
    row = df.agg(n, *aggs)
    types = dict(df.dtypes)
    stack = ", ".join(f"'{c}', '{types[c]}', `nn_{c}`" for c in df.columns)
    return row.selectExpr(
        f"stack({len(df.columns)}, {stack}) AS (column, dtype, non_null)", "_n"
    ).select("column", "dtype", F.col("non_null").cast("bigint").alias("non_null"),
             (F.col("_n") - F.col("non_null")).cast("bigint").alias("nulls"))
