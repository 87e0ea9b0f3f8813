"""Embedding whitening by weighted multiplicity covariance.

Entries become integers x = floor(1024 c) + 100000 and equal x vectors are one
row with their count: a hot vector costs one row of every product. Fit weights
are the counts, or one a distinct vector. Sums are exact integers; covariances
are weighted products of vectors centred first. Each distinct vector is
whitened once, and rows get their vector's result by a join.

A vector's key holds its x without loss (16 bits an entry, 64 where one does
not fit), so equal keys are equal vectors. The few keys that hold more than a
thousandth of all rows each are joined by broadcast, the others by a shuffle.

Rows whose vector is null or holds a null or non-finite entry are left out;
an empty vector has no components and so no rows. Entries beyond 2^42 in size
count as that. Vectors of different lengths are fitted apart, one list a
length. Null and repeated ids keep a row each; extra columns are ignored.
Components with no variance (an eigenvalue within rounding of 0) do not
exist: copies of one vector alone, like an empty table, give no rows. A
deviation that does not fit 64 bits is null. To the driver go sums and
covariances, one matrix for each length of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pawprint.llm.common import join_back, need, stored

#: The grid of the entries.
SCALE, SHIFT = 1024, 100_000
#: Largest entry, and bytes of vectors that one product handles.
LIMIT = float(1 << 42)
STEP_BYTES = 16 << 20
_LOW = 26
_FIT = 1 << 62


def _grid(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of the batch's usable vectors, by length and in steps."""
    lists = batch.column(column)
    lens = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(lens)
    usable = (lens > 0) & (wrong[ends] == wrong[ends - lens])
    for width in np.unique(lens[usable]):
        rows = np.flatnonzero(usable & (lens == width))
        step = max(1, int(STEP_BYTES // (8 * width)))
        for a in range(0, len(rows), step):
            own = rows[a:a + step]
            c = values[(ends[own] - width)[:, None] + np.arange(width)]
            yield own, np.floor(SCALE * np.clip(c, -LIMIT, LIMIT)).astype(np.int64) + SHIFT


def _pack(x: np.ndarray) -> list[bytes]:
    """The key of every row of x."""
    off = x - SHIFT
    small = (np.abs(off) < 1 << 15).all(axis=1)
    narrow = off.astype("<i2")
    return [b"\2" + narrow[i].tobytes() if s else b"\10" + x[i].astype("<i8").tobytes()
            for i, s in enumerate(small.tolist())]


def _unpack(keys: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of keys, by length of the vector and in steps."""
    kinds = np.array([(len(k) - 1) // k[0] for k in keys])
    for width in np.unique(kinds):
        rows = np.flatnonzero(kinds == width)
        step = max(1, int(STEP_BYTES // (8 * width)))
        for a in range(0, len(rows), step):
            own = rows[a:a + step]
            yield own, np.stack([
                np.frombuffer(keys[i], "<i2", offset=1).astype(np.int64) + SHIFT
                if keys[i][0] == 2 else np.frombuffer(keys[i], "<i8", offset=1) for i in own])


def keyed(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, key) of every usable row."""
    plain = need(vectors, vec_id, embedding).select(F.col(vec_id).alias("vec_id"),
                                                    F.col(embedding).alias("embedding"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, x in _grid(batch, "embedding"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(own)), pa.array(_pack(x), pa.binary())],
                    names=["vec_id", "key"])
    schema = T.StructType([plain.schema["vec_id"], T.StructField("key", T.BinaryType())])
    return plain.mapInArrow(keys, schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and dimension: weighted sums of x in two halves, and weights."""
    held: dict[int, list] = {}
    for batch in batches:
        w = batch.column("w").to_numpy()
        for own, x in _unpack(batch.column("key").to_pylist()):
            high, low, n = held.setdefault(x.shape[1], [0, 0, 0])
            held[x.shape[1]] = [high + w[own] @ (x >> _LOW), low + w[own] @ (x & (1 << _LOW) - 1),
                                n + int(w[own].sum())]
    for d, (high, low, n) in held.items():
        yield pa.RecordBatch.from_pydict({
            "d": np.full(d, d, np.int32), "i": np.arange(d, dtype=np.int32), "high": high,
            "low": low, "n": np.full(d, n, np.int64)})


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in 64 bits where that holds it, else as Python integers."""
    if len(x) and int(np.abs(x).max()) * n + max(map(abs, sums)) < _FIT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_offsets(x, n, sums) / n).astype(np.float64)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    off = _offsets(x, n, sums)
    if off.dtype == object or int(np.abs(off).max()) ** 2 * x.shape[1] >= _FIT:
        off = off.astype(object)
        return [s if s < 1 << 63 else None for s in (off * off).sum(axis=1)]
    return (off * off).sum(axis=1).tolist()


def _upper(totals: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for d, c in totals.items():
        i, j = np.triu_indices(len(c))
        yield pa.RecordBatch.from_pydict({
            "d": np.full(len(i), d, np.int32), "i": i.astype(np.int32), "j": j.astype(np.int32),
            "v": c[i, j]})


def _products(means: dict[int, tuple[int, list[int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("w").to_numpy()
            for own, x in _unpack(batch.column("key").to_pylist()):
                c = _centred(x, *means[x.shape[1]])
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + (c * w[own, None]).T @ c
        yield from _upper(totals)
    return run


def _matrices(partial: DataFrame) -> dict[int, np.ndarray]:
    """The summed matrices: one a length, half of it as rows."""
    out: dict[int, np.ndarray] = {}
    for r in (partial.groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
              .orderBy(F.desc("i")).collect()):
        # The first row of a matrix has its last number: the matrix's size.
        c = out.get(r["d"])
        if c is None:
            c = out[r["d"]] = np.zeros((r["i"] + 1, r["i"] + 1))
        c[r["i"], r["j"]] = c[r["j"], r["i"]] = r["v"]
    return out


def components(covariance: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling; those of no variance left out.

    A vector's largest entry is positive, so every run has the same signs."""
    e, v = np.linalg.eigh(covariance)
    order = np.argsort(-e, kind="stable")[:top]
    e, v = e[order], v[:, order]
    real = e > max(e[0], 0.0) * len(covariance) * np.finfo(float).eps
    e, v = e[real], v[:, real]
    if len(e):
        v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(len(e))])
    return e, v


def _whiten(means: dict, models: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for own, x in _unpack(keys.to_pylist()):
                d = x.shape[1]
                at = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(at), batch.column("copies").take(at), batch.column("w").take(at),
                     pa.array([d] * len(own), pa.int32()),
                     pa.array(_deviations(x, *means[d]), pa.int64()),
                     pa.array(list(_centred(x, *means[d]) @ models[d]), pa.list_(pa.float64()))],
                    names=["key", "copies", "w", "d", "deviation", "z"])
    return run


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        w, d = batch.column("w").to_numpy(), batch.column("d").to_numpy()
        for width in np.unique(d):
            rows = np.flatnonzero(d == width)
            z = batch.column("z").take(pa.array(rows)).flatten().to_numpy()
            z = z.reshape(len(rows), -1)
            totals[int(width)] = totals.get(int(width), 0) + (z * w[rows, None]).T @ z
    yield from _upper(totals)


def whiten(vectors: DataFrame, top: int = 8, weights: str = "counts", vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for
    each usable row and component. ``weights``: "counts" or "ones"."""
    if weights not in ("counts", "ones"):
        raise ValueError("weights are 'counts' or 'ones'")
    rows = keyed(vectors, vec_id, embedding)
    w = F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
                      .withColumn("w", w), "whiten-distinct")
    exact = "decimal(38,0)"
    sums: dict[int, tuple[int, list[int]]] = {}
    for r in (distinct.mapInArrow(_sums, "d int, i int, high bigint, low bigint, n bigint")
              .groupBy("d", "i").agg(*[F.sum(F.col(c).cast(exact)).alias(c)
                                       for c in ("high", "low", "n")])
              .orderBy("d", "i").collect()):
        sums.setdefault(r["d"], (int(r["n"]), []))[1].append(
            (int(r["high"]) << _LOW) + int(r["low"]))
    upper = "d int, i int, j int, v double"
    models, explained = {}, {}
    for d, c in _matrices(distinct.mapInArrow(_products(sums), upper)).items():
        e, v = components(c / sums[d][0], top)
        models[d] = v / np.sqrt(e)
        explained[d] = (e / np.trace(c / sums[d][0])).tolist() if len(e) else []
    kind = ("key binary, copies bigint, w bigint, d int, deviation bigint, z array<double>")
    white = stored(distinct.mapInArrow(_whiten(sums, models), kind), "whiten-vectors")
    moments = _matrices(white.filter(F.size("z") > 0).mapInArrow(_second_moments, upper))
    error = {d: float(np.abs(m / sums[d][0] - np.eye(len(m))).max()) for d, m in moments.items()}

    def by_length(values: dict, kind: str):
        pairs = [x for d, v in values.items() for x in (F.lit(d), v)]
        held = F.create_map(*pairs) if pairs else F.lit(None).cast(f"map<int,{kind}>")
        return F.element_at(held, F.col("d"))
    out = join_back(rows, white.drop("w"), ["key"], "copies")
    out = out.select("vec_id", "d", "deviation", F.posexplode("z").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"),
        by_length({d: F.lit(n).cast("bigint") for d, (n, _) in sums.items()}, "bigint").alias("n"),
        "deviation", "whitened",
        F.element_at(by_length({d: F.array(*[F.lit(x) for x in v]).cast("array<double>")
                                for d, v in explained.items()}, "array<double>"),
                     F.col("at") + 1).alias("explained"),
        by_length({d: F.lit(x) for d, x in error.items()}, "double").alias("identity_error"))
