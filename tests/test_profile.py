"""Profiling operators and k-NN voting rules on small literal fixtures."""

import pytest
from pyspark.sql import functions as F

from pawprint.operators import profile
from pawprint.operators.models import KNNClassifier


@pytest.fixture(scope="module")
def shelter(spark):
    rows = [("Dog", "Intact", "Transfer"), ("Dog", "Intact", "Adoption"),
            ("Dog", "Neutered/Spayed", "Adoption"), ("Dog", "Neutered/Spayed", "Adoption"),
            ("Cat", "Intact", "Euthanasia"), ("Cat", None, "Adoption"), ("Cat", "Intact", None)]
    return spark.createDataFrame(rows, "AnimalType string, status string, outcome string")


def test_crosstab_long_and_wide(shelter):
    long = {(r.AnimalType, r.row_value, r.col_value): (r.n, r.share) for r in
            profile.crosstab(shelter, "status", "outcome", by="AnimalType").collect()}
    assert long[("Dog", "Intact", "Transfer")] == (1, 0.5)
    assert long[("Dog", "Neutered/Spayed", "Adoption")] == (2, 1.0)
    assert ("Cat", None, "Adoption") not in long  # null keys excluded
    wide = {(r.AnimalType, r.status): r for r in profile.crosstab_wide(
        shelter, "status", "outcome", ["Adoption", "Euthanasia", "Transfer"],
        by="AnimalType").collect()}
    assert wide[("Dog", "Intact")].Adoption == 0.5 and wide[("Dog", "Intact")].Euthanasia == 0.0
    assert wide[("Cat", "Intact")].Euthanasia == 1.0


def test_value_shares_and_other_last(spark):
    df = spark.createDataFrame([(v,) for v in ["Other"] * 5 + ["a"] * 3 + ["b"] * 3 + [None]],
                               "v string")
    shares = profile.value_shares(df, "v")
    ordered = [r.value for r in shares.orderBy(*profile.other_last_order()).collect()]
    assert ordered == ["a", "b", "Other"]
    assert {r.value: r.share for r in shares.collect()}["Other"] == pytest.approx(5 / 11)
    with_nulls = {r.value: r.n for r in profile.value_counts(df, "v", dropna=False).collect()}
    assert with_nulls[None] == 1
    ordered = [(r.value, r.n) for r in profile.value_counts(df, "v", ordered=True).collect()]
    assert ordered == [("Other", 5), ("a", 3), ("b", 3)]


def test_box_summary_and_histogram(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = profile.box_summary(df, "x").first()
    assert (b.q1, b.median, b.q3) == (2.0, 3.0, 4.0)
    s = profile.box_summary(df, "x", method="selection").first()
    assert s.asDict() == b.asDict()
    assert b.whisker_lo == 1.0 and b.whisker_hi == 4.0 and b.n_outliers == 1
    h = {r.bin: r.n for r in profile.histogram(df, "x", bins=10).collect()}
    assert len(h) == 10 and sum(h.values()) == 5 and h[10] == 1 and h[1] == 4


def test_quantile_modes_agree(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"),
                                     (F.col("id") % 3).alias("g"))
    probs = (0.0, 0.1, 0.5, 0.9, 0.999, 1.0)
    a = sorted((r.g, r.prob, round(r.value, 9)) for r in
               profile.quantiles(df, "x", probs, by="g").collect())
    b = sorted((r.g, r.prob, round(r.value, 9)) for r in profile.exact_quantiles(
        df, "x", probs, by="g", buckets=4, small=10).collect())
    assert a == b
    c = profile.quantiles(df, "x", (0.5,), approx=True).first().value
    assert abs(c - 500.5) <= 2


def test_null_profile_sorted(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 2, 3)], "a int, b int, c int")
    rows = [(r.column, r.nulls) for r in profile.null_profile(df).collect()]
    assert rows == [("a", 2), ("b", 1)]


def _knn_fit(spark, rows, k, weights):
    train = spark.createDataFrame(rows, "rid long, features array<double>, target string")
    return KNNClassifier(k, weights).fit(train)


def test_knn_uniform_vote_tie_lowest_label(spark):
    model = _knn_fit(spark, [(1, [0.0], "b"), (2, [2.0], "a")], 2, "uniform")
    q = spark.createDataFrame([(10, [1.0])], "rid long, features array<double>")
    r = model.predict(q).first()
    assert r.prediction == "a" and r.proba == {"a": 0.5, "b": 0.5}


def test_knn_distance_weights_and_zero_distance(spark):
    rows = [(1, [0.0], "a"), (2, [3.0], "b"), (3, [3.5], "b")]
    model = _knn_fit(spark, rows, 3, "distance")
    q = spark.createDataFrame([(10, [1.0]), (11, [0.0])], "rid long, features array<double>")
    out = {r.rid: r for r in model.predict(q).collect()}
    # 1/1 for "a" against 1/2 + 1/2.5 for "b"
    assert out[10].prediction == "a"
    assert out[10].proba["a"] == pytest.approx(1.0 / (1.0 + 0.5 + 0.4))
    # zero distance: only the identical row votes
    assert out[11].prediction == "a" and out[11].proba["a"] == 1.0


def test_exploration_table(spark):
    from pawprint.operators.explore import exploration_table
    df = spark.createDataFrame(
        [("2024-04-06 03:00:00", "2 years", "Rex", "Intact Female", "Lab Mix", "Black/White")],
        "DateTime string, AgeuponOutcome string, Name string, SexuponOutcome string, "
        "Breed string, Color string")
    r = exploration_table(df).first()
    assert (r.age_in_days, r.Month, r.Hour, r.Weekday_Name, r.Weekday_Num) == (730.0, 4, 3, "Sat", 5)
    assert (r.IsWeekend_Label, r.TimeOfDay, r.has_name, r.Gender) == ("Weekend", "Night", 1, "Female")
    assert (r.Reproductive_Status, r.Breed_Type, r.Primary_Breed) == ("Intact", "Mixed", "Lab")
    assert (r.Is_Multicolor, r.Primary_Color, r.KittenSeason_Label) == \
        ("Multicolor", "Black", "Kitten Season")


def test_quantiles_of_many_groups_and_large_ones(spark):
    # 3,000 small groups, a null one, and two that take several passes.
    small = spark.range(60_000).select((F.col("id") % 3000).alias("g"),
                                       F.hash("id").cast("double").alias("x"))
    large = spark.range(20_000).select(
        F.when(F.col("id") % 5 < 3, 9001).otherwise(9002).cast("long").alias("g"),
        F.pow(F.lit(1.001), F.hash("id") % 9000).alias("x"))
    null = spark.createDataFrame([(None, 1.0), (None, 4.0), (None, 2.5)], "g long, x double")
    df = small.unionByName(large).unionByName(null)
    probs = (0.0, 0.1, 0.5, 0.99, 1.0)
    key = lambda d: sorted(((r.g is None, r.g or 0, r.prob, r.value) for r in d.collect()))
    got = key(profile.exact_quantiles(df, "x", probs, by="g", buckets=16, small=50))
    want = key(profile.quantiles(df, "x", probs, by="g"))
    assert len(got) == len(want) == 3003 * 5
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) <= 1e-9 * max(1.0, abs(b[3]))
               for a, b in zip(got, want))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "g long, x double")
    assert profile.exact_quantiles(df, "x", (0.5,), by="g").collect() == []
    assert profile.exact_quantiles(df, "x", (0.5,)).collect() == []


def test_ranks_of_tied_names_are_dealt(spark):
    # 20,000 names with one prefix in one group: no range holds above 1/50 of them.
    from pawprint.operators.ranks import exact_rank
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.concat(
        F.lit("same prefix "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"))
    ranked = exact_rank(df, ["g"], [F.col("name")])
    assert ranked.filter(F.col("rn") - 1 != F.substring("name", 13, 6).cast("long")).isEmpty()
    plan = df.withColumn("_o", F.struct("name"))
    cuts = sorted(r[0] for r in plan.select("name").orderBy(F.xxhash64("_o")).limit(512).collect())
    at = [int(c[12:]) for c in cuts] + [20_000]
    assert max(b - a for a, b in zip([0] + at, at)) <= 20_000 / 50


def test_ranks_equal_a_window(spark):
    from pyspark.sql import Window

    from pawprint.operators.ranks import exact_rank
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("n"),
                                 F.col("id").cast("string").alias("v"))
    got = exact_rank(df, ["g"], [-F.col("n"), F.col("v")], cuts=4)
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(F.desc("n"), "v")).cast("long"))
    assert sorted(map(tuple, got.select("g", "n", "v", "rn").collect())) == \
        sorted(map(tuple, want.collect()))


def test_null_column_is_warned_of_at_every_size(spark, monkeypatch):
    import pawprint.operators.rare as rare
    df = spark.range(50).select(F.col("id").cast("string").alias("a"),
                                F.lit(None).cast("string").alias("b"))
    for limit in (20_000, 3):
        monkeypatch.setattr(rare, "INLINE_LIMIT", limit)
        with pytest.warns(RuntimeWarning, match="Column 'b' is empty"):
            rare.RareCategoriesGrouper(["a", "b"], 0.1).fit(df)
