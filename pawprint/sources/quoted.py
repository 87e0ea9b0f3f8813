"""CSV records with line breaks inside quotes, read in parallel.

A line break ends a record only outside quotes, and whether a byte is inside
quotes depends on all quotes before it. So the file is read as lines, split
after split, in two passes. The first counts the quotes of every split; the
running parity over the splits of a file (one row a split) tells which splits
begin inside quotes. In the second each split joins its own lines to records,
starting from that parity; what it cannot finish alone, the end of a record
begun earlier and its last record, are at most two fragments a split, put
together by their order in the file. Parsing is Spark's.

Quotes must be balanced and a quote inside quotes doubled. Only the splits
that begin inside quotes are known to every task (one short entry a split).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Records of a batch that leaves a task.
BATCH = 4096
_OUT = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()),
                  ("record", pa.string())])
#: Kinds of rows: a whole record, the end of an earlier one, a split's last one.
WHOLE, HEAD, LAST = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def splits_inside_quotes(lines: DataFrame) -> DataFrame:
    """(file, start) of the splits whose first byte is inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1)
    return (counts.withColumn("before", F.sum("n").over(before))
            .filter(F.col("before") % 2 == 1).select("file", "start"))


def _records(inside: set[tuple[str, int]]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        here, open_, parts, kind, first = None, False, [], LAST, False
        for batch in batches:
            values = batch.column("value").to_pylist()
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
            for value, split in zip(values, zip(files, starts)):
                if split != here:
                    if parts and not first:
                        yield (*here, kind, "\n".join(parts))
                    here, open_, parts = split, split in inside, []
                    # A file's first record is its header.
                    kind, first = (HEAD if open_ else LAST), split[1] == 0
                elif not open_:
                    if not first:
                        yield (*here, HEAD if kind == HEAD else WHOLE, "\n".join(parts))
                    parts, kind, first = [], LAST, False
                parts.append(value)
                open_ ^= value.count('"') % 2 == 1
        if parts and not first:
            yield (*here, kind, "\n".join(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) == BATCH:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*held), _OUT)], schema=_OUT)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), _OUT)], schema=_OUT)
    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every record but the headers and blank lines."""
    lines = _lines(spark, path)
    inside = {(r["file"], r["start"]) for r in splits_inside_quotes(lines).collect()}
    rows = lines.mapInArrow(_records(inside), "file string, start bigint, kind int, record string")
    # A split's last record goes on in the heads of later splits, until one of
    # them has a last record of its own.
    order = Window.partitionBy("file").orderBy("start", "kind")
    pieces = (rows.filter(F.col("kind") != WHOLE)
              .withColumn("number", F.sum((F.col("kind") == LAST).cast("bigint")).over(order)))
    joined = pieces.groupBy("file", "number").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "kind", "record"))),
        lambda p: p["record"]), "\n").alias("record"))
    out = rows.filter(F.col("kind") == WHOLE).select("record").unionByName(joined.select("record"))
    end = F.regexp_replace("record", "\r$", "")
    return out.select(end.alias("record")).filter(F.col("record") != "")


def read_quoted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of CSV files with a header, by a schema in the order of the header."""
    options = {"mode": "FAILFAST", "escape": '"', "maxCharsPerColumn": "-1"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records(spark, path).select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
