"""op12: whitened vectors against a plain dense computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pawprint.llm import whitening
from tests.llm.conftest import with_extra


def plain(rows, top=8, ones=False):
    """(id, component) -> what the operator should return, of one length of vectors."""
    rows = [(i, v) for i, v in rows if v and all(
        c is not None and math.isfinite(c) for c in v)]
    xs = [tuple(math.floor(1024 * float(c)) + 100_000 for c in v) for _, v in rows]
    fit = sorted(set(xs)) if ones else xs
    n, d = len(fit), len(xs[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[(n * x[j] - s[j]) / n for j in range(d)] for x in fit])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:top], v[:, ::-1][:, :top]
    keep = e > e[0] * d * np.finfo(float).eps
    e, v = e[keep], v[:, keep]
    out = []
    for (i, _), x in zip(rows, xs):
        off = [n * x[j] - s[j] for j in range(d)]
        z = (np.array(off) / n) @ v / np.sqrt(e)
        for c in range(len(e)):
            out.append((i, c + 1, n, sum(o * o for o in off), z[c], e[c] / np.trace(cov)))
    return out


def same(df, expected):
    got = df.select("vec_id", "component", "n", "deviation", "whitened", "explained",
                    "identity_error").collect()
    assert len(got) == len(expected)
    order = lambda r: (r[1], r[0] is None, r[0] or 0, r[3], abs(r[4]))
    got, expected = sorted(map(tuple, got), key=order), sorted(expected, key=order)
    signs = {}
    for g, x in zip(got, expected):
        assert g[:4] == x[:4]
        assert abs(g[4]) == pytest.approx(abs(x[4]), rel=1e-7, abs=1e-7)
        if abs(x[4]) > 1e-3:
            assert signs.setdefault(g[1], np.sign(g[4] * x[4])) == np.sign(g[4] * x[4])
        assert g[5] == pytest.approx(x[5], rel=1e-9)
        assert g[6] <= 1e-4
    assert len({g[6] for g in got}) <= 1


def vectors(spark, rows):
    return with_extra(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def test_table(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    same(whitening.whiten(df), plain(rows))


EDGE = [(i, [float(np.float32(math.sin(i * k))) for k in (1, 2, 3)]) for i in range(40)] + [
    (100, [0.5, 0.25, -0.125])] * 30 + [
    (200 + i, [0.5, 0.25, -0.125]) for i in range(30)] + [
    (300, None), (301, [1.0, None, 2.0]), (302, [float("nan"), 1.0, 1.0]),
    (303, [1.0, float("inf"), 1.0]), (304, []), (None, [1.0, 2.0, 3.0]), (None, [40.0, -50.0, 1.0])]


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_edges_and_weights(spark, weights):
    df = vectors(spark, EDGE).repartition(4)
    same(whitening.whiten(df, weights=weights), plain(EDGE, ones=weights == "ones"))


def test_heavy_keys_join_like_light_ones(spark, monkeypatch):
    import pawprint.llm.common as common
    df = vectors(spark, EDGE).repartition(3)
    expected = plain(EDGE)
    for parts in (1, 2, 10 ** 9):
        monkeypatch.setattr(common, "HEAVY_PARTS", parts)
        same(whitening.whiten(df), expected)


def test_no_variance_no_rows(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.5])] * 5)).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    line = [(i, [float(i), 2.0 * i]) for i in range(9)]
    same(whitening.whiten(vectors(spark, line)), plain(line))


def test_lengths_are_fitted_apart(spark):
    a = [(i, [math.sin(i), math.cos(3 * i)]) for i in range(30)]
    b = [(100 + i, [math.sin(i), math.cos(i), math.sin(5 * i)]) for i in range(30)]
    out = whitening.whiten(vectors(spark, a + b))
    f32 = lambda rows: [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    same(out.filter("vec_id < 100"), plain(f32(a)))
    same(out.filter("vec_id >= 100"), plain(f32(b)))


def test_large_entries_are_exact(spark):
    rows = [(i, [1e9 * i, -3e8 * i * i]) for i in range(20)] + [(50, [1e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).filter("component = 1").collect()}
    x = [[math.floor(1024 * max(-whitening.LIMIT, min(whitening.LIMIT, c))) + 100_000 for c in v]
         for _, v in rows]
    s, n = [sum(c) for c in zip(*x)], len(x)
    for (i, _), v in zip(rows, x):
        exact = sum((n * c - t) ** 2 for c, t in zip(v, s))
        assert got[i] == (exact if exact < 1 << 63 else None)


def test_whitened_is_once_per_distinct_vector(spark):
    df = vectors(spark, EDGE)
    keys = whitening.keyed(df).groupBy("key").agg(F.count("*").alias("n"))
    assert keys.agg(F.max("n")).first()[0] == 60 and keys.count() == 43
