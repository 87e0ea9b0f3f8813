"""Profiling aggregates: counts, shares, nulls, distincts, cross tabs, quantiles.

Every function returns a small aggregate ``DataFrame``; grouping keys (e.g.
the species) are passed as ``by`` so one job serves all groups instead of
one filtered copy per group. Aggregations use Spark's partial (map-side) +
final aggregation, so a hot key is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pawprint.functions.text import OTHER
from pawprint.session import Scratch


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


_ALL = "__all"


def _keyed(df: DataFrame, by) -> tuple[list[str], DataFrame]:
    """Group keys, with a constant key when ungrouped (so joins are equi-joins)."""
    keys = _by(by)
    if keys:
        return keys, df
    return [_ALL], df.withColumn(_ALL, F.lit(0))


def _attach(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Add the per-group columns of ``small`` (one row per group) to ``df``.

    Grouped: equi-join on the keys (AQE broadcasts the small side at
    runtime). Ungrouped: scalar subqueries, so no cross join is planned.
    """
    if keys:
        return df.join(small, keys, "inner")
    return df.withColumns({c: small.select(c).scalar() for c in small.columns})


def value_counts(df: DataFrame, col: str, by=None, dropna: bool = True,
                 ordered: bool = False) -> DataFrame:
    """(by..., value, n); nulls excluded unless ``dropna=False``.

    ``ordered=True`` sorts the (small, aggregated) result like a report:
    group keys, count descending, then value.
    """
    keys = _by(by)
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    out = (src.groupBy(*keys, F.col(col).alias("value"))
           .agg(F.count(F.lit(1)).alias("n")))
    return out.orderBy(*keys, F.desc("n"), F.col("value")) if ordered else out


def value_shares(df: DataFrame, col: str, by=None, dropna: bool = True,
                 percent: bool = False) -> DataFrame:
    """Value counts with their share of the group total (``n / sum(n)``).

    The group totals are a second aggregation over the counts attached on
    the group keys (one row per group), so a group with very many distinct
    values is never gathered into one window task.
    """
    keys = _by(by)
    counts = value_counts(df, col, by, dropna)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    share = F.col("n") / F.col("_total")
    if percent:
        share = share * 100.0
    return (_attach(counts, totals, keys)
            .withColumn("pct" if percent else "share", share).drop("_total"))


def other_last_order(value: str = "value", n: str = "n") -> list[Column]:
    """Sort keys: ``Other`` after all real categories, then count desc, value."""
    return [F.col(value) == F.lit(OTHER), F.desc(n), F.col(value)]


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column, nulls) for every column in one aggregation; by default only > 0."""
    cols = df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    out = row.selectExpr(f"stack({len(cols)}, {stack}) AS (column, nulls)")
    out = out.withColumn("nulls", F.col("nulls").cast("bigint"))
    out = out.filter(F.col("nulls") > 0) if only_missing else out
    # One row per column: sorting the report is free.
    return out.orderBy(F.desc("nulls"), "column")


def distinct_counts(df: DataFrame, cols: Sequence[str], by=None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column and group (exact or HyperLogLog++)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    keys = _by(by)
    return df.groupBy(*keys).agg(*[fn(F.col(c)).cast("bigint").alias(f"n_{c}") for c in cols])


def top_values(df: DataFrame, col: str, k: int, by=None) -> DataFrame:
    """Top ``k`` values by count per group (ties: value ascending), with rank.

    The window runs on the aggregated counts (one row per group and value).
    """
    keys = _by(by)
    counts = value_counts(df, col, by)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(
        F.desc("n"), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def crosstab(df: DataFrame, row: str, col: str, by=None) -> DataFrame:
    """Row-normalised cross tabulation in long form: (by..., row, col, n, share).

    Rows with a null in either key are excluded; absent pairs are absent (0).
    """
    keys = _by(by)
    src = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    counts = src.groupBy(*keys, F.col(row).alias("row_value"), F.col(col).alias("col_value")) \
        .agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys, "row_value")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(w))


def crosstab_wide(df: DataFrame, row: str, col: str, labels: Sequence[str] | None = None,
                  by=None) -> DataFrame:
    """Wide form with one share column per label (absent pairs -> 0.0).

    Shares are of all rows with both keys, so labels that are not listed make
    them sum to less than one. Without ``labels`` those in the data are taken
    (one small job; as many columns as there are labels).
    """
    keys = _by(by)
    src = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    if labels is None:
        labels = [str(r[0]) for r in src.select(col).distinct().orderBy(col).collect()]
    total = F.count(F.lit(1))
    return src.groupBy(*keys, row).agg(
        *[(F.count_if(F.col(col).cast("string") == F.lit(lab)) / total).alias(lab)
          for lab in labels])


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by=None,
              approx: bool = False, accuracy: int = 10000, method: str = "inmemory") -> DataFrame:
    """Quantiles of non-null values per group, long form (by..., prob, value).

    ``method="inmemory"``: exact ``percentile`` (linear interpolation like
    pandas) -- one value->count map per group, right for bounded domains
    (ages, counts). ``method="selection"``: exact distributed selection
    (``exact_quantiles``) for unbounded domains and huge groups.
    ``approx=True``: the mergeable GK sketch (``percentile_approx``).
    """
    if method == "selection" and not approx:
        return exact_quantiles(df, col, probs, by)
    keys = _by(by)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if approx:
        agg = F.percentile_approx(F.col(col), arr, accuracy)
    else:
        agg = F.percentile(F.col(col), arr)
    out = df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(
        F.arrays_zip(arr.alias("prob"), agg.alias("value")).alias("q"))
    return out.select(*keys, F.explode("q").alias("q")).select(
        *keys, F.col("q.prob").alias("prob"), F.col("q.value").cast("double").alias("value"))


def box_summary(df: DataFrame, col: str, by=None, whisker: float = 1.5,
                method: str = "inmemory") -> DataFrame:
    """Quartiles, whiskers (extreme values within ``whisker``*IQR) and outlier count.

    ``method`` as in ``quantiles`` ("selection" for unbounded value domains).
    """
    keys = _by(by)
    src = df.filter(F.col(col).isNotNull())
    if method == "selection":
        long = exact_quantiles(src, col, (0.25, 0.5, 0.75), by)
        q = long.groupBy(*keys).agg(*[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    else:
        q = src.groupBy(*keys).agg(
            F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
        q = q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                     F.col("q")[2].alias("q3"))
    q = (q.withColumn("lo_fence", F.col("q1") - whisker * (F.col("q3") - F.col("q1")))
          .withColumn("hi_fence", F.col("q3") + whisker * (F.col("q3") - F.col("q1"))))
    j = _attach(src, q, keys)
    inside = (F.col(col) >= F.col("lo_fence")) & (F.col(col) <= F.col("hi_fence"))
    return j.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 50, by=None) -> DataFrame:
    """Equal-width histogram over [min, max] per group, all bins present.

    Bin = ``least(width_bucket(x, lo, hi, bins), bins)`` so the maximum lands
    in the last bin. Empty bins come from ``sequence(1, bins)`` on the
    per-group range table, left-joined to the counts.
    """
    keys = _by(by)
    src = df.filter(F.col(col).isNotNull())
    rng = src.groupBy(*keys).agg(F.min(col).cast("double").alias("lo"),
                                 F.max(col).cast("double").alias("hi"))
    j = _attach(src, rng, keys)
    width = (F.col("hi") - F.col("lo")) / bins
    bucket = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.width_bucket(F.col(col), F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins)))
    counts = j.groupBy(*keys, bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left")
    return out.select(*keys, F.col("bin").cast("bigint").alias("bin"),
                      (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                      (F.col("lo") + F.col("bin") * width).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


#: Fewest rows of an interval that is narrowed further instead of ranked.
SMALL_BUCKET = 200_000


def _inside(src: DataFrame, spans: DataFrame, keys: list[str], grouped: bool) -> DataFrame:
    """Rows of ``src`` (keys, _x) in every interval of ``spans`` (keys, _lo, _hi, ...) of
    their group, with the interval's columns.

    Grouped: a null-safe equi-join on the keys. Ungrouped: there are at most
    two intervals a probability; they are literals, and no join is planned."""
    more = [c for c in spans.columns if c not in keys]
    if grouped:
        t = spans.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *more)
        return (src.join(t, _same(keys) & F.col("_x").between(F.col("_lo"), F.col("_hi")))
                .select(*keys, "_x", *more))
    kind = dict(spans.dtypes)
    spans = spans.collect()
    if not spans:
        return src.limit(0).select(*keys, "_x", *[F.lit(None).cast(kind[c]).alias(c)
                                                  for c in more])
    rows = F.array(*[F.struct(*[F.lit(r[c]).cast(kind[c]).alias(c) for c in more])
                     for r in spans])
    hit = F.filter(rows, lambda e: F.col("_x").between(e["_lo"], e["_hi"]))
    return src.select(*keys, "_x", F.explode(hit).alias("_t")).select(*keys, "_x", "_t.*")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by=None,
                    buckets: int = 1024, small: int = SMALL_BUCKET) -> DataFrame:
    """Exact linearly-interpolated quantiles by distributed selection.

    For value domains too large for ``percentile`` (which keeps one
    ``value -> count`` map per group in a single task). The needed ranks of a
    group start in one interval, that of all its values. Every pass cuts the
    intervals of more than ``small`` rows into equal-width buckets (count, min
    and max of each) and keeps, for each rank, the bucket that holds it; a
    bucket's [min, max] holds exactly its rows, and an interval shrinks in
    every pass, so all become small or a single value. Then the ranks of an
    interval are read from one window over it.

    The intervals are a written table: groups may be few and huge or many and
    small, and nothing of them passes through the driver (of an ungrouped
    call, two intervals a probability do).
    """
    keys, src = _keyed(df.filter(F.col(col).isNotNull()), by)
    grouped = bool(_by(by))
    src = src.select(*keys, F.col(col).cast("double").alias("_x"))
    scratch = Scratch(df.sparkSession, "quantiles")
    prob = F.array(*[F.lit(float(p)) for p in probs])
    position = F.transform(prob, lambda p: p * (F.col("_n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(position, lambda q: F.array(
        F.floor(q), F.ceil(q)))))
    stats = scratch.table(src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    # (keys, _lo, _hi, _below: rows of the group under the interval, _count, _ranks)
    spans = scratch.table(stats.select(
        *keys, "_lo", "_hi", F.lit(0).cast("bigint").alias("_below"),
        F.col("_n").alias("_count"), ranks.alias("_ranks")))
    open_ = (F.col("_count") > small) & (F.col("_lo") < F.col("_hi"))
    done = spans.filter(~open_)
    spans = spans.filter(open_)
    while not spans.isEmpty():
        bucket = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
                                 * buckets), F.lit(buckets - 1))
        span = [*keys, "_below"]
        hist = (_inside(src, spans.drop("_count"), keys, grouped)
                .groupBy(*span, "_ranks", bucket.alias("_b"))
                .agg(F.count(F.lit(1)).alias("_count"), F.min("_x").alias("_lo"),
                     F.max("_x").alias("_hi")))
        before = Window.partitionBy(*span).orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1)
        hist = hist.withColumn("_below", F.col("_below") + F.coalesce(
            F.sum("_count").over(before), F.lit(0)))
        held = F.filter("_ranks", lambda r: (r >= F.col("_below"))
                        & (r < F.col("_below") + F.col("_count")))
        cut = scratch.table(hist.select(*keys, "_lo", "_hi", "_below", "_count",
                                        held.alias("_ranks")).filter(F.size("_ranks") > 0))
        done = done.unionByName(cut.filter(~open_))
        spans = cut.filter(open_)
    # Single values are their ranks' values; of the others every row is ranked once.
    one = (done.filter(F.col("_lo") == F.col("_hi"))
           .select(*keys, F.explode("_ranks").alias("_r"), F.col("_lo").alias("_x")))
    rest = done.filter(F.col("_lo") < F.col("_hi")).drop("_count")
    rank = (F.row_number().over(Window.partitionBy(*keys, "_below").orderBy("_x"))
            + F.col("_below") - 1)
    found = (_inside(src, rest, keys, grouped).withColumn("_r", rank.cast("bigint"))
             .filter(F.array_contains("_ranks", F.col("_r"))).select(*keys, "_r", "_x"))
    # The two ranks of a probability, side by side: one row a group and probability.
    values = one.unionByName(found).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_v"))
    want = values.join(stats.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_n"),
                       _same(keys)) if grouped else values.withColumn(
        "_n", stats.select("_n").scalar())
    q = F.col("_p") * (F.col("_n") - 1)
    low, high = F.floor(q), F.ceil(q)
    low_x, high_x = F.element_at("_v", low), F.element_at("_v", high)
    out = want.select(*keys, "_v", "_n", F.explode(prob).alias("_p")).select(
        *keys, F.col("_p").alias("prob"),
        F.when(low == high, low_x).otherwise((high - q) * low_x + (q - low) * high_x)
        .alias("value"))
    result = scratch.table(out.drop(_ALL))
    scratch.clear(keep=result)
    return result


def _same(keys: list[str]):
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return on
