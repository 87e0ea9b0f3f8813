"""Registry, end-to-end chain, persistence and I/O contracts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pawprint.operators.models import available_models, make_classifier
from pawprint.plans.chain import ChainModel, fit_chain, with_p_true
from pawprint.plans.search import build_search_spaces, candidates
from pawprint.session import scratch_path
from pawprint.sources import io

S = ("rid long, AnimalID string, Name string, DateTime string, SexuponOutcome string, "
     "AgeuponOutcome string, Breed string, Color string, target string")


@pytest.fixture(scope="module")
def shelter(spark):
    """40 rows, three classes (20 / 10 / 10), like the reference's pipeline frame."""
    targets = ["Adoption"] * 20 + ["Transfer"] * 10 + ["Euthanasia"] * 10
    sexes = ["Neutered Male", "Spayed Female", "Intact Male", "Intact Female"]
    breeds = ["Lab Mix", "Beagle", "Siamese/Tabby", "Poodle"]
    rows = []
    for i, t in enumerate(targets):
        rows.append((i, f"A{i}", None if i % 5 == 0 else f"N{i}",
                     (dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)).isoformat(" "),
                     sexes[i % 4], f"{1 + i % 5} years" if i % 3 else f"{i + 1} weeks",
                     breeds[(i + len(t)) % 4], "Black/White" if i % 2 else "Brown", t))
    return spark.createDataFrame(rows, S)


def test_registry():
    assert available_models() == ("knn", "logistic_regression", "random_forest")
    with pytest.raises(ValueError, match="Unknown model type"):
        make_classifier("svm")


def test_grids():
    spaces = build_search_spaces()
    assert set(spaces) == {"knn", "logistic_regression", "random_forest"}
    assert [len(candidates(g)) for g in spaces.values()] == [36, 18, 36]
    for g in spaces.values():
        assert "categorical_eng__max_other_ratio" in g and "smote__k_neighbors" in g


@pytest.mark.parametrize("family,params", [
    ("knn", {"clf__n_neighbors": 3, "clf__weights": "distance"}),
    ("logistic_regression", {"clf__C": 1.0}),
    ("random_forest", {"clf__n_estimators": 10}),
])
def test_chain_fit_predict(spark, shelter, family, params):
    model = fit_chain(shelter, family, {"smote__k_neighbors": 3, **params})
    pred = with_p_true(model.predict(shelter)).collect()
    assert len(pred) == 40
    assert {r.prediction for r in pred} <= {"Adoption", "Transfer", "Euthanasia"}
    assert all(abs(sum(r.proba.values()) - 1.0) < 1e-6 for r in pred)


def test_unseen_categories_predict(spark, shelter):
    model = fit_chain(shelter, "knn", {"smote__k_neighbors": 3, "clf__n_neighbors": 3})
    new = spark.createDataFrame([(999, "X", "Rex", "2024-02-01 10:00:00", "Intact Male",
                                  "2 years", "Dragon Mix", "Sparkly Golden", None)], S)
    r = model.predict(new).first()
    assert r.prediction in {"Adoption", "Transfer", "Euthanasia"}


def test_save_load_same_predictions(spark, shelter):
    model = fit_chain(shelter, "logistic_regression", {"smote__k_neighbors": 3})
    path = scratch_path(spark, "model-test")
    model.save(path)
    loaded = ChainModel.load(spark, path)
    a = sorted((r.rid, r.prediction) for r in model.predict(shelter).collect())
    b = sorted((r.rid, r.prediction) for r in loaded.predict(shelter).collect())
    assert a == b


def test_na_tokens_and_whitespace_round_trip(spark):
    base = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([("a", "NA"), ("   ", "None"), ("  x ", "none")], "p string, q string")
    io.write_csv(df, base)
    back = io.read_raw(spark, base, "csv", schema=None)
    got = sorted((r.p, r.q) for r in back.collect())
    assert got == sorted([("a", None), ("   ", None), ("  x ", "none")])


def test_require_columns_and_alignment(spark):
    df = spark.createDataFrame([("A1",)], "AnimalID string")
    with pytest.raises(KeyError, match="missing"):
        io.require_columns(df, ["OutcomeType"])
    f = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "rid long, a string")
    t = spark.createDataFrame([(1, "Adoption")], "rid long, target string")
    with pytest.raises(ValueError, match="misaligned"):
        io.align_features_target(f, t)
    ok = io.align_features_target(f.filter("rid = 1"), t)
    assert ok.count() == 1


def test_column_overview(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string")
    rows = {r.column: (r.dtype, r.non_null, r.nulls) for r in io.column_overview(df).collect()}
    assert rows == {"a": ("bigint", 2, 0), "b": ("string", 1, 1)}
