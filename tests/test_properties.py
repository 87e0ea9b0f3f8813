"""Property checks against direct (single-machine) computations."""

import hashlib
import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pawprint.operators import profile
from pawprint.operators.sample import stratified_folds, stratified_split

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def direct_split(labels: list[str], test_size: float, seed: int) -> dict[int, str]:
    df = pd.DataFrame({"rid": range(len(labels)), "target": labels})
    df["h"] = [hashlib.md5(f"{seed}:{r}".encode()).hexdigest() for r in df.rid]
    n = len(df)
    n_test = math.ceil(test_size * n)
    sizes = df.groupby("target").size()
    exact = {c: n_test * k / n for c, k in sizes.items()}
    base = {c: math.floor(v) for c, v in exact.items()}
    left = n_test - sum(base.values())
    order = sorted(exact, key=lambda c: (-(exact[c] - base[c]), c))
    quota = {c: base[c] + (1 if i < left else 0) for i, c in enumerate(order)}
    out = {}
    for c, g in df.sort_values(["h", "rid"]).groupby("target", sort=False):
        for i, rid in enumerate(g.rid):
            out[rid] = "test" if i < quota[c] else "train"
    return out


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=5, max_size=300),
       st.sampled_from([0.1, 0.2, 0.33]), st.integers(0, 1000))
def test_split_equals_direct_rule(spark, labels, test_size, seed):
    labels = labels + ["a"] * (len(labels) // 2)  # one dominant class
    df = spark.createDataFrame(list(enumerate(labels)), "rid long, target string")
    got = {r.rid: r.split for r in stratified_split(df, test_size, seed).collect()}
    assert got == direct_split(labels, test_size, seed)


@SETTINGS
@given(st.lists(st.sampled_from(["x", "y"]), min_size=10, max_size=200), st.integers(2, 5))
def test_folds_balanced_property(spark, labels, k):
    df = spark.createDataFrame(list(enumerate(labels)), "rid long, target string")
    out = stratified_folds(df, k, 42).toPandas()
    sizes = out.groupby("fold").size().reindex(range(k), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    per = out.groupby(["target", "fold"]).size().unstack(fill_value=0).reindex(
        columns=range(k), fill_value=0)
    assert ((per.max(axis=1) - per.min(axis=1)) <= 1).all()


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=400),
       st.sampled_from([2, 5, 64]))
def test_selection_quantiles_equal_numpy(spark, values, buckets):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)
    got = {r.prob: r.value for r in
           profile.exact_quantiles(df, "x", probs, buckets=buckets, small=3).collect()}
    want = np.quantile(np.array(values), probs, method="linear")
    for p, w in zip(probs, want):
        assert math.isclose(got[p], w, rel_tol=1e-12, abs_tol=1e-9)
