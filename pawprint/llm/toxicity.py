"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams.

Features of a text are its words, their beginnings (the first 5, 6 and 7
bytes), pairs of neighbours and skip-grams over one and two words, hashed
into ``2 ** BITS`` slots and counted. The learner keeps two sums per slot;
every slot has its own rate, and the L1 term leaves slots whose gradients do
not add up at exactly zero, so the weights that are broadcast are few.

Training reads a bounded number of labelled rows (``TRAIN_ROWS`` of either
class, by hash of the id) outside the held-out third; scoring reads every
text. Labels, lang, source and doc_id are never inputs of a score.

Null and empty texts score as the intercept alone. Labels that are null are
no labels; of several labels of one id the highest counts. Without labelled
rows of both classes every score is the share of toxic labels (0 if none).
Repeated rows score alike; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import (ALNUM, byte_table, mix, need, offsets_of, powers, slices,
                                 word_hashes)

BITS = 20
#: Labelled rows of either class that training reads at most.
TRAIN_ROWS = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 6.0, 1.0
THRESHOLD = 0.7
_STEMS = (5, 6, 7)


def text_features(offs: np.ndarray, data: np.ndarray):
    """(slot, row) of every occurrence of a feature."""
    words, row, start, end = word_hashes(data, offs, ALNUM)
    n = len(words)
    slots, rows = [words], [row]
    if n:
        table = byte_table(True)
        up, down = powers(len(data))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * up)])
        for k in _STEMS:
            at = np.flatnonzero(end - start > k)
            s = start[at]
            slots.append(mix((total[s + k] - total[s]) * down[s] + np.uint64(k)))
            rows.append(row[at])
        for gap in (1, 2, 3):
            same = np.flatnonzero(row[gap:] == row[:-gap])
            slots.append(mix(words[same] * np.uint64(0xD6E8FEB86659FD93) + words[same + gap]
                             + np.uint64(gap)))
            rows.append(row[same])
    return ((np.concatenate(slots) >> np.uint64(64 - BITS)).astype(np.int32),
            np.concatenate(rows))


class Ftrl:
    """FTRL-proximal with per-coordinate rates; ``weights`` is sparse by L1."""

    def __init__(self, size: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(size + 1)  # the last slot is the intercept, without L1
        self.n = np.zeros(size + 1)

    def at(self, slots: np.ndarray) -> np.ndarray:
        z = self.z[slots]
        l1 = np.where(slots == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / (
            (self.beta + np.sqrt(self.n[slots])) / self.alpha + self.l2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        slots = np.append(slots, len(self.z) - 1)
        values = np.append(values, 1.0)
        w = self.at(slots)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
        g = (p - label) * values
        step = (np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])) / self.alpha
        self.z[slots] += g - step * w
        self.n[slots] += g * g

    def weights(self):
        """Slots with a weight, the weights, and the intercept."""
        w = self.at(np.arange(len(self.z)))
        used = np.flatnonzero(w[:-1])
        return used.astype(np.int32), w[used], float(w[-1])


def _feature_rows(names: list[str]):
    def run(batches):
        for part in slices(batches):
            slot, row = text_features(*offsets_of(part.column("text")))
            key, count = np.unique((row << BITS) | slot, return_counts=True)
            at = np.searchsorted(key >> BITS, np.arange(part.num_rows + 1))
            slot = (key & ((1 << BITS) - 1)).astype("<i4")
            count = np.minimum(count, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([
                part.column("place"), part.column("toxic"),
                pa.array([slot[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                pa.array([count[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=names)
    return run


def _value(count: np.ndarray) -> np.ndarray:
    return np.minimum(count, 3).astype(np.float64)


def _train(epochs: int):
    """One task over the bounded sample, in the order of its hashes."""
    def run(batches):
        rows = []
        for b in batches:
            rows += list(zip(b.column("place").to_pylist(), b.column("toxic").to_pylist(),
                             b.column("slots").to_pylist(), b.column("counts").to_pylist()))
        rows.sort(key=lambda r: r[0])
        model = Ftrl(1 << BITS)
        for _ in range(epochs):
            for _, label, slots, counts in rows:
                model.learn(np.frombuffer(slots, "<i4"),
                            _value(np.frombuffer(counts, np.uint8)), float(label))
        if rows:
            used, w, intercept = model.weights()
            yield pa.RecordBatch.from_arrays([
                pa.array([used.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary()),
                pa.array([intercept])], names=["slots", "weights", "intercept"])
    return run


def held_out():
    """The third of the ids that no training reads."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                      F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
        epochs: int = EPOCHS):
    """(slots, weights, intercept) learnt from labelled rows outside the held-out third."""
    known = (need(labels, "doc_id", "toxic").filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("place", F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = float(bool(counts.get(1)))
        return np.zeros(0, np.int32), np.zeros(0), (30.0 if share else -30.0)
    sample = None
    for label in sorted(counts):
        part = known.filter(F.col("toxic") == label).orderBy("place", "doc_id").limit(train_rows)
        sample = part if sample is None else sample.unionByName(part)
    # At most 2 * train_rows rows of three numbers.
    names = ["place", "toxic", "slots", "counts"]
    rows = (need(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("place", "toxic", "text").mapInArrow(
                _feature_rows(names), "place bigint, toxic int, slots binary, counts binary"))
    trained = rows.repartition(1).mapInArrow(
        _train(epochs), "slots binary, weights binary, intercept double").collect()
    if not trained:
        return np.zeros(0, np.int32), np.zeros(0), float(np.log(
            (counts.get(1, 0) + 1e-9) / (total - counts.get(1, 0) + 1e-9)))
    used, w, intercept = trained[0]
    # The sample's classes may be thinned unevenly: put the intercept right.
    seen = {k: min(v, train_rows) for k, v in counts.items()}
    shift = np.log(counts[1] / counts[0]) - np.log(seen[1] / seen[0])
    return np.frombuffer(used, np.int32), np.frombuffer(w), float(intercept + shift)


def _score_rows(model, names: list[str]):
    def run(batches):
        used, w, intercept = model.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[used] = w
        for part in slices(batches):
            slot, row = text_features(*offsets_of(part.column("text")))
            here = np.flatnonzero(dense[slot])
            # Counts above three add no more, as in training.
            key, count = np.unique((row[here] << BITS) | slot[here], return_counts=True)
            logit = intercept + np.bincount(
                key >> BITS, weights=dense[key & ((1 << BITS) - 1)] * _value(count),
                minlength=part.num_rows)
            score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("held_out"), pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32))], names=names)
    return run


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "score", "predicted"]
    return (need(docs, "doc_id", "text").select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(_score_rows(shared, names), f"doc_id {kind}, held_out boolean, "
                        "score double, predicted int"))
