"""Inputs as they come: quotes and line breaks, repeated keys, unlisted labels."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pawprint.operators import profile
from pawprint.operators.models import make_classifier
from pawprint.plans.search import prepare_split
from pawprint.session import scratch_path
from pawprint.sources import io


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    names = ['Bob "B" X', "two\nlines", 'comma, "and" break\nhere', " spaced "]
    path = tmp_path / "q.csv"
    pd.DataFrame({"Name": names, "AnimalType": "Dog"}).to_csv(path, index=False)
    back = io.read_raw(spark, str(path), multiline=True)
    assert sorted(r.Name for r in back.collect()) == sorted(names)
    out = scratch_path(spark, "csv")
    io.write_csv(back.coalesce(1), out)
    import glob
    part = glob.glob(out.replace("file:", "") + "/part-*")[0]
    assert sorted(pd.read_csv(part).Name) == sorted(names)


def test_na_words_of_parquet_stay(spark):
    path = scratch_path(spark, "na")
    spark.createDataFrame([("None",), ("NA",), (None,)], "Name string").write.parquet(path)
    assert sorted(str(r.Name) for r in io.read_raw(spark, path, "parquet").collect()) == [
        "NA", "None", "None"]
    assert io.read_raw(spark, path, "parquet").filter("Name IS NULL").count() == 1


@pytest.mark.parametrize("left,right", [([1, 1, 2], [1, 2]), ([1, 1, 2], [1, 1, 2]), ([1, 2], [1, 3]),
                                        ([1, None], [1, None]), ([1], [1, 2])])
def test_misaligned(spark, left, right):
    feats = spark.createDataFrame([(k, "x") for k in left], "rid long, f string")
    target = spark.createDataFrame([(k, "y") for k in right], "rid long, target string")
    with pytest.raises(ValueError, match="misaligned"):
        io.align_features_target(feats, target)


def test_row_key_follows_the_values(spark):
    rows = [(f"A{i % 17}", f"o{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "AnimalID string, OutcomeType string")
    one = {tuple(r) for r in io.with_row_key(df.repartition(1)).collect()}
    many = {tuple(r) for r in io.with_row_key(df.repartition(7)).collect()}
    assert one == many and len({r[2] for r in one}) == 60
    split = lambda n: sorted(tuple(r) for r in prepare_split(df.repartition(n)).collect())
    assert split(2) == split(9)


def test_wide_shares_are_of_all_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("b", None)],
                               "k string, v string")
    got = {r.k: r.x for r in profile.crosstab_wide(df, "k", "v", ["x"]).collect()}
    assert got == {"a": 0.5, "b": 0.0}
    assert profile.crosstab_wide(df, "k", "v").columns == ["k", "x", "y", "z"]


def test_unknown_family_and_parameter():
    with pytest.raises(ValueError, match="Unknown model type"):
        make_classifier("svm")
    with pytest.raises(ValueError, match="takes"):
        make_classifier("knn", C=1.0)
    with pytest.raises(ValueError, match="limit"):
        make_classifier("random_forest", max_depth=31)


def test_callers_cache_stays(spark):
    from pawprint.plans.chain import fit_chain
    from pawprint.sources.fixture import record_table
    from conftest import SF001
    train = (record_table(spark, SF001).filter("rid < 300").na.drop(subset=["DateTime"])
             .withColumnRenamed("OutcomeType", "target").drop("OutcomeSubtype", "AnimalType")
             .cache())
    train.count()
    fit_chain(train, "logistic_regression", {"smote__k_neighbors": 3})
    assert train.storageLevel.useMemory
    train.unpersist()


def test_no_local_checkpoint_folder_on_a_cluster():
    from types import SimpleNamespace
    from pawprint.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(spark)


def test_metrics_are_one_scan_without_joins(spark):
    from pawprint.operators import metrics
    path = scratch_path(spark, "pred")
    spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")],
                          "target string, prediction string").write.parquet(path)
    s = metrics.summary(metrics.confusion(spark.read.parquet(path)))
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("== Initial Plan ==")[0].count("FileScan") == 1
