"""op11: source divergences against exact brute force, runs and shards of any size."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pawprint.llm import spimi
from tests.llm.conftest import LONG, with_extra

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least=spimi.LEAST_DOCS, top=spimi.TOP_TERMS):
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        count[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {k[0] for k in count}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (g, s), c in count.items() if g == lang}
        whole = sum(own.values(), Counter())

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pair = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)
                    for o in own if o != s}
            term = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept
                    if own[s][t] and p[s][t] > q[t]}
            for part, values, last in (("pair", pair, None), ("term", term, top)):
                order = sorted(values, key=lambda i: (-values[i], i.encode()))[:last]
                out += [(lang, s, part, i, values[i], r) for r, i in enumerate(order, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value",
                                              "rank").collect())


ROWS = [
    ("one two Two three été", "en", "a"), ("one two three été", "en", "b"),
    ("one two three été ÉTÉ", "en", "a"), ("one one one", "en", None), ("x" * 5000, "en", "a"),
    (None, "en", "empty"), ("", "en", "empty"), ("1 2 3", None, None), (None, None, "b"),
    ("solo solo", "de", "only"), ("solo", "de", "only"), ("solo rest", "de", "only"),
    ("日本 語 word\x00word", "fr", "a"), ("日本 word", "fr", "b"), ("日本 word", "fr", "c"),
    ("word", "fr", "c"), (LONG, "fr", "b"), (LONG, "fr", "b"), (LONG, "fr", "c"),
]


@pytest.mark.parametrize("block, shard", [(64 << 20, 64 << 20), (500, 20_000)])
def test_divergence(spark, block, shard):
    df = with_extra(spark.createDataFrame(ROWS, "text string, lang string, source string")
                    .repartition(5))
    got = found(spimi.divergence(df, block_bytes=block, shard_bytes=shard))
    assert got == brute_force(ROWS)
    assert ("en", "empty") in {g[:2] for g in got} and ("", "b") in {g[:2] for g in got}


def test_top_terms_and_ties(spark):
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    rows = [(" ".join(words), "en", "a")] * 3 + [("other " * 50, "en", "b")] * 3
    got = found(spimi.divergence(
        spark.createDataFrame(rows, "text string, lang string, source string"), top=7))
    assert got == brute_force(rows, top=7)
    assert [g[3] for g in got if g[1] == "a" and g[2] == "term"] == sorted(
        t for t in {re.sub(r"\d", "", w) for w in words})[:7]


def test_no_rows(spark, no_docs):
    df = no_docs.select("text", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    assert found(spimi.divergence(df)) == []


def test_runs_are_sorted_and_bounded(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    runs = spimi._texts(df).coalesce(1).mapInArrow(spimi._build(4, 1 << 20), spimi.RUN_DDL)
    rows = runs.collect()
    assert len({r.shard for r in rows}) == 4
    several = Counter((r.shard, r.lang) for r in rows)
    assert max(several.values()) > 1
    for r in rows:
        terms = bytes(r.terms).split(b"\n")
        assert terms == sorted(set(terms)) and terms[0] == bytes(r.first)
        assert len(terms) <= spimi.SEGMENT_TERMS


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]
    got = found(spimi.divergence(df, block_bytes=1 << 20, shard_bytes=100_000))
    assert got == brute_force(rows)


def test_shares_are_exact(spark):
    rows = [(0, 1, 0), (5, 7, 3), (10 ** 14, 2 * 10 ** 14, 10 ** 6), (2 ** 47, 2 ** 47, 1)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in df.select(spimi._share("c", F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10 ** 9 * (c + 1) // (n + v) for c, n, v in rows]
