import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Names that the operators use inside: as extra columns they must not clash.
EXTRA = ("mark", "node", "group", "root", "place", "toxic", "row", "range", "host", "n", "sid",
         "id", "m", "h", "l", "line", "words", "data", "z", "slice", "bucket", "copies", "expression")

LONG = " ".join(f"word{i % 977} of{i}" for i in range(30_000))


def with_extra(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])


@pytest.fixture(scope="session")
def edge_rows():
    plain = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    return [(1, plain), (2, plain), (2, plain), (3, None), (4, ""), (5, " \n\t "), (6, "one"),
            (7, LONG), (8, LONG + " tail"), (9, "Straße ÉTÉ 日本語 \x1c \x00 end"),
            (10, plain.upper()), (None, plain), (None, None)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return with_extra(spark.createDataFrame(edge_rows, "doc_id long, text string")).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_extra(spark.createDataFrame([], "doc_id long, text string"))
