"""The pipeline's group stage: one document of each group, and no text lost to its id."""

from pyspark.sql import functions as F

import corpus_pipeline

ONE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
TWO = " ".join(f"gamma{i} delta{i % 5}" for i in range(60))
THREE = " ".join(f"rho{i} sigma{i % 9}" for i in range(60))


def test_different_texts_of_one_id_all_stay(spark):
    rows = [(1, ONE), (1, TWO), (1, TWO), (2, THREE), (3, THREE + " end"), (4, THREE),
            (None, ONE), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.length("text").cast("long").alias("n_chars"))
    kept = corpus_pipeline.jaccard_groups(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())
    assert got == sorted([(False, 1, ONE), (False, 1, TWO), (False, 2, THREE), (True, 0, ONE),
                          (False, 5, "")])
