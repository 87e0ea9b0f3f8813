"""CSV files of several splits with line breaks inside quotes, against pandas."""

import pandas as pd
import pytest
from pyspark.sql import types as T

from pawprint.sources import io
from pawprint.sources.quoted import _lines, records, splits_inside_quotes

SCHEMA = T.StructType([T.StructField("rid", T.LongType()), T.StructField("Name", T.StringType()),
                       T.StructField("Breed", T.StringType())])
LONG_BREAKS = "\n".join(f"line {i}, with ""quotes"" and, commas" for i in range(80))
NAMES = ["plain", 'quote " inside', "a\nb", "\n", "\n\nends\n", 'x,"y",\n"z"', "", None, "été 日本",
         LONG_BREAKS, '""', "NA", "tab\there", "\r\nwindows\r\n"]


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_reads_as_pandas_does(spark, tmp_path, small_splits, end):
    rows = [(i, NAMES[i % len(NAMES)], f"breed {i}") for i in range(120)]
    path = tmp_path / "raw.csv"
    pd.DataFrame(rows, columns=SCHEMA.names).to_csv(path, index=False, lineterminator=end)
    lines = _lines(spark, str(path))
    assert lines.rdd.getNumPartitions() > 5
    assert splits_inside_quotes(lines).count() >= 3
    got = io.read_raw(spark, str(path), "csv", SCHEMA, multiline=True)
    want = pd.read_csv(path, lineterminator="\n" if end == "\n" else None)
    expected = sorted((int(r.rid), None if pd.isna(r.Name) else r.Name, r.Breed)
                      for r in want.itertuples())
    found = sorted((r.rid, r.Name or None, r.Breed) for r in got.collect())
    assert found == expected


def test_several_files_and_blank_lines(spark, tmp_path, small_splits):
    for n in range(3):
        (tmp_path / f"p{n}.csv").write_text(
            "rid,Name,Breed\n\n" + "".join(f'{n * 10 + i},"a\n\n{i}",b\n\n' for i in range(4)))
    (tmp_path / "only_header.csv").write_text("rid,Name,Breed\n")
    got = io.read_raw(spark, str(tmp_path), "csv", SCHEMA, multiline=True)
    assert sorted(r.rid for r in got.collect()) == sorted(n * 10 + i for n in range(3)
                                                          for i in range(4))
    assert {r.Name for r in got.collect()} == {f"a\n\n{i}" for i in range(4)}


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    text = "word\n" * 1000
    (tmp_path / "big.csv").write_text(f'rid,Name,Breed\n1,"{text}",x\n2,"b\nc",y')
    assert records(spark, str(tmp_path / "big.csv")).count() == 2
    got = {r.rid: r.Name for r in io.read_raw(spark, str(tmp_path / "big.csv"), "csv", SCHEMA,
                                              multiline=True).collect()}
    assert got == {1: text, 2: "b\nc"}
