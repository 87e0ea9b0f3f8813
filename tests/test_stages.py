"""Cleaner, rare grouping and feature stages (reference unit-test fixtures)."""

import warnings

import pytest
from pyspark.sql import functions as F

from pawprint.operators.base import NotFittedError
from pawprint.operators.clean import DataCleaner, DataCleanerModel
from pawprint.operators.rare import RareCategoriesGrouper
from pawprint.operators.stages import (CategoricalFeaturesEngineer, NameFeaturesExtractor,
                                       SexFeaturesExtractor, TemporalFeaturesExtractor)

S = "AnimalID string, DateTime string, Name string, Breed string, Color string, " \
    "SexuponOutcome string, AgeuponOutcome string"


@pytest.fixture
def train_frame(spark):
    rows = [("A1", "2024-01-01 10:00:00", "Bella", "Lab Mix", "Black", "Neutered Male", "2 years"),
            ("A2", "2024-01-02 11:00:00", None, None, None, "Neutered Male", "1 year"),
            ("A3", "2024-01-03 12:00:00", "Max", "Siamese", "Blue", None, "3 years"),
            ("A4", "2024-01-04 13:00:00", "Luna", "Beagle", "White", "Spayed Female", None)]
    return spark.createDataFrame(rows, S)


def test_cleaner_learns_mode_and_median(train_frame):
    m = DataCleaner().fit(train_frame)
    assert m.getOrDefault(m.sexMode) == "Neutered Male"
    assert m.getOrDefault(m.ageMedian) == 730.0


def test_cleaner_transform(train_frame):
    m = DataCleaner().fit(train_frame)
    out = m.transform_observed(train_frame)
    assert "AnimalID" not in out.columns and "AgeuponOutcome" not in out.columns
    rows = {r.Name: r for r in out.collect()}
    assert rows["Unknown"].Breed == "Unknown" and rows["Unknown"].Color == "Unknown"
    assert rows["Max"].SexuponOutcome == "Neutered Male"
    assert rows["Luna"].log_age_in_days == pytest.approx(6.594413, abs=1e-6)  # log1p(730)
    counts = m.imputation_counts()
    assert counts == {"n_missing_sex": 1, "n_missing_age": 1}


def test_cleaner_uses_training_statistics_only(spark, train_frame):
    m = DataCleaner().fit(train_frame)
    test = spark.createDataFrame([("B1", None, None, None, None, None, None)], S)
    r = m.transform(test).first()
    assert r.SexuponOutcome == "Neutered Male"
    assert r.log_age_in_days == pytest.approx(6.594413, abs=1e-6)


def test_cleaner_all_null_and_empty(spark):
    s = "Name string, SexuponOutcome string, AgeuponOutcome string"
    all_null = spark.createDataFrame([(None, None, None), (None, None, None)], s)
    m = DataCleaner().fit(all_null)
    assert m.getOrDefault(m.sexMode) == "Unknown" and m.getOrDefault(m.ageMedian) == 0.0
    out = [r.asDict() for r in m.transform(all_null).collect()]
    assert out[0] == {"Name": "Unknown", "SexuponOutcome": "Unknown", "log_age_in_days": 0.0}
    empty = spark.createDataFrame([], s)
    m2 = DataCleaner().fit(empty)
    assert m2.getOrDefault(m2.sexMode) == "Unknown"
    assert m2.transform(empty).columns == ["Name", "SexuponOutcome", "log_age_in_days"]


def test_cleaner_not_fitted(spark):
    df = spark.createDataFrame([("x",)], "Name string")
    with pytest.raises(NotFittedError, match="not fitted"):
        DataCleanerModel().transform(df)


def test_cleaner_zero_age(spark):
    df = spark.createDataFrame([("0 days",), ("7 days",)], "AgeuponOutcome string")
    out = [r[0] for r in DataCleaner().fit(df).transform(df).collect()]
    assert out == pytest.approx([0.0, 2.0794415], abs=1e-6)


def _col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_rare_grouping(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("AABBC")], "i int, Breed string")
    m = RareCategoriesGrouper(["Breed"], 0.25).fit(df)
    assert sorted(m.inline["Breed"]) == ["A", "B"]
    assert _col(m.transform(df).orderBy("i"), "Breed") == ["A", "A", "B", "B", "Other"]


def test_rare_grouping_keeps_null(spark):
    df = spark.createDataFrame([(0, "A"), (1, "A"), (2, "B"), (3, "B"), (4, None)],
                               "i int, Breed string")
    m = RareCategoriesGrouper(["Breed"], 0.25).fit(df)
    assert _col(m.transform(df).orderBy("i"), "Breed") == ["A", "A", "B", "B", None]


def test_rare_grouping_by_group_in_one_pass(spark):
    from pawprint.operators.rare import category_counts, frequent_categories
    rows = [("Dog", v) for v in "AAAABC"] + [("Cat", v) for v in "XXYYZ"]
    df = spark.createDataFrame(rows, "g string, v string")
    kept = frequent_categories(category_counts(df, ["v"], by=["g"]), 0.25)
    got = sorted((r.g, r.category) for r in kept.collect())
    assert got == [("Cat", "X"), ("Cat", "Y"), ("Dog", "A"), ("Dog", "B")]


def test_rare_drift_warning(spark):
    train = spark.createDataFrame([("A",)] * 90 + [("B",)] * 10, "Breed string")
    test = spark.createDataFrame([("B",)] * 100, "Breed string")
    m = RareCategoriesGrouper(["Breed"], 0.15).fit(train)
    out = m.transform_observed(test)
    out.count()
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        msgs = m.check_drift()
    assert msgs and any(issubclass(x.category, RuntimeWarning) for x in w)
    rep = m.drift_report(out).first()
    assert rep.exceeded and rep.other_ratio == 1.0


def test_rare_missing_column_at_fit(spark):
    df = spark.createDataFrame([("A",)], "Color string")
    with pytest.raises(ValueError, match="missing"):
        RareCategoriesGrouper(["Breed"], 0.15).fit(df)


def test_rare_large_list_uses_join(spark, monkeypatch):
    import pawprint.operators.rare as rare
    monkeypatch.setattr(rare, "INLINE_LIMIT", 1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate("AABBC")], "i int, Breed string")
    m = RareCategoriesGrouper(["Breed"], 0.25).fit(df)
    assert m.inline is None
    assert _col(m.transform(df).orderBy("i"), "Breed") == ["A", "A", "B", "B", "Other"]


def test_categorical_engineer(spark):
    rows = [(0, "Lab Mix", "Black/White"), (1, "Lab/Poodle", "Black"), (2, "Lab", "Black"),
            (3, "Lab", "Black"), (4, "Siamese", "Blue"), (5, None, None)]
    df = spark.createDataFrame(rows, "i int, Breed string, Color string")
    out = CategoricalFeaturesEngineer(maxOtherRatio=0.25).fit(df).transform(df).orderBy("i")
    assert _col(out, "is_mix") == [1, 1, 0, 0, 0, 0]
    assert _col(out, "Breed") == ["Lab", "Lab", "Lab", "Lab", "Other", None]
    assert _col(out, "Color") == ["Black", "Black", "Black", "Black", "Other", None]


def test_missing_columns_return_input(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for stage in (TemporalFeaturesExtractor(), SexFeaturesExtractor(), NameFeaturesExtractor()):
        assert stage.transform(df).columns == ["x"]


def test_temporal_stage_accepts_text_and_timestamp(spark):
    import datetime as dt
    a = spark.createDataFrame([("2024-03-02 06:00:00",)], "DateTime string")
    b = spark.createDataFrame([(dt.datetime(2024, 3, 2, 6),)], "DateTime timestamp_ntz")
    ra = TemporalFeaturesExtractor().transform(a).first().asDict()
    rb = TemporalFeaturesExtractor().transform(b).first().asDict()
    assert ra == rb and "DateTime" not in ra and ra["IsWeekend"] == 1.0


def test_sex_and_name_stages(spark):
    df = spark.createDataFrame([("Neutered Male", "Bella"), (None, "  ")],
                               "SexuponOutcome string, Name string")
    out = NameFeaturesExtractor().transform(SexFeaturesExtractor().transform(df)).collect()
    assert [(r.Reproductive_Status, r.has_name) for r in out] == [("Neutered/Spayed", 1),
                                                                  ("Unknown", 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rare_fit_matches_direct_rule(spark, seed):
    """Level/prefix decomposition equals the direct running-share rule."""
    import random
    from pawprint.operators.rare import category_counts, frequent_categories
    rnd = random.Random(seed)
    letters = "abcdefghij"
    cats = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = [(c,) for c in cats for _ in range(rnd.choice([1, 1, 1, 2, 3, 8]))]
    df = spark.createDataFrame(rows, "v string")
    for ratio in (0.1, 0.35, 0.6):
        got = sorted(r.category for r in frequent_categories(category_counts(df, ["v"]), ratio)
                     .collect())
        counts = {}
        for (c,) in rows:
            counts[c] = counts.get(c, 0) + 1
        total = sum(counts.values())
        order = sorted(counts, key=lambda c: (-counts[c], c.encode()))
        want, before = [], 0
        for c in order:
            if before / total < 1 - ratio:
                want.append(c)
            before += counts[c]
        assert got == sorted(want)


def test_fit_transform_helper(train_frame):
    from pawprint.operators.base import fit_transform
    out = fit_transform(DataCleaner(), train_frame)
    assert out.count() == 4 and "log_age_in_days" in out.columns


def test_record_key_has_no_overflow_on_huge_ids(spark):
    import datetime as dt
    from pawprint.sources.fixture import records_from
    ids = [5, 3_037_000_500, 9_000_000_000_000_000_000]
    events = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), 2, "click") for i in ids],
        "event_id long, ts timestamp_ntz, user_id long, event_type string")
    part = spark.createDataFrame([(k, f"p{k}", "TYPE", k % 5) for k in range(200)],
                                 "p_partkey long, p_name string, p_type string, p_size int")
    got = {r.rid: r.Breed for r in records_from(events, part).collect()}
    want = {i: f"p{(i % 200) * 7919 % 200}" for i in ids}
    assert {k: v.split(" ")[0].split("/")[0] for k, v in got.items()} == want
