"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of all vote patterns (a table of at
most 3 ** labellers rows, whatever the input) estimates how often each
labeller votes what on good and on bad documents, which gives every pattern a
posterior. The posteriors of a bounded number of documents (``TRAIN_DOCS``,
by hash of the id) train a linear scorer over hashed shapes of the text, and
the scorer judges every document.

Null and empty texts have only the length labeller's vote and a score from
the intercept and the length; repeated rows score alike; without any document
the scorer rejects nothing; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import SPACE, need, offsets_of, shingles, slices, word_hashes, word_spans

TRAIN_DOCS = 6_000
#: Bytes of text judged at once: about 150 bytes of memory for each.
STEP = 1 << 18
#: Documents whose score (probability of good) is below this are rejected.
THRESHOLD = 0.5
NONE, BAD, GOOD = 0, 1, 2

LABELLERS = ("length", "symbols", "capitals", "repetition", "lines", "separators", "shouting",
             "sentences", "word_length", "small_words")

#: Those that only ever vote bad.
DETECTORS = ("symbols", "capitals", "repetition", "lines", "separators", "shouting",
             "word_length")
#: Share of good documents before any vote is seen.
PRIOR = 0.85
#: Quiet good documents, in multiples of all, that every detector is credited with.
BELIEF = 5.0

#: Byte classes of the scorer's shapes.
_CLASSES = np.full(256, 12, np.int64)
_CLASSES[65:91], _CLASSES[97:123], _CLASSES[48:58] = 0, 1, 2
_CLASSES[[9, 11, 12, 13, 32]], _CLASSES[10] = 3, 4
for _k, _chars in enumerate((".", ",;:", "!", "?", "|", "#*$%&<>", "\"'()[]-"), 5):
    _CLASSES[[ord(c) for c in _chars]] = _k
_CLASSES[128:] = 13
N_CLASSES = 14
#: Slots of byte-class triples, and of bucketed measures behind them.
SHAPES = N_CLASSES ** 3
BUCKETS = 16
SLOTS = SHAPES + BUCKETS * 6


def _share(part, whole):
    return part / np.maximum(whole, 1)


def measures(offs: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """What labellers and scorer look at, per row."""
    n = len(offs) - 1
    words, row, start, end = word_hashes(data, offs, ~SPACE)
    n_words = np.bincount(row, minlength=n)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    size = end - start

    def per_row(flags, rows=row):
        return np.bincount(rows, weights=flags, minlength=n)

    def chars(classes):
        total = np.concatenate([[0], np.cumsum(np.isin(_CLASSES[data], classes))])
        return total[offs[1:]] - total[offs[:-1]]

    upper, lower = chars([0]), chars([1, 13])
    triple, triple_row, _ = shingles(words, row, n, 3)
    key = np.stack([triple_row.astype(np.uint64), triple], 1)
    order = np.lexsort((key[:, 1], key[:, 0]))
    same = np.zeros(len(key), bool)
    if len(key) > 1:
        ranked = key[order]
        same[1:] = (ranked[1:] == ranked[:-1]).all(axis=1)
    again = np.bincount(triple_row[order], weights=same, minlength=n)
    n_triples = np.bincount(triple_row, minlength=n)
    # Lines: maximal runs of bytes between line feeds.
    not_feed = np.ones(256, bool)
    not_feed[10] = False
    lines, line_row, _, line_end = word_hashes(data, offs, not_feed, lower=False)
    n_lines = np.bincount(line_row, minlength=n)
    order = np.lexsort((lines, line_row))
    same = np.zeros(len(lines), bool)
    if len(lines) > 1:
        same[1:] = (lines[order][1:] == lines[order][:-1]) & (
            line_row[order][1:] == line_row[order][:-1])
    dup = np.bincount(line_row[order], weights=same, minlength=n)
    ends_well = np.isin(data[line_end - 1], np.frombuffer(b".!?:\"')", np.uint8)) \
        if len(line_end) else np.zeros(0, bool)
    return {
        "n_words": n_words,
        "symbols": _share(chars([10]), n_words),
        "capitals": _share(upper, upper + lower),
        "repetition": _share(again, n_triples),
        "n_lines": n_lines,
        "dup_lines": _share(dup, n_lines),
        "separators": _share(chars([9]), n_words),
        "shouting": _share(per_row(last == ord("!")), n_words),
        "sentences": _share(np.bincount(line_row, weights=ends_well, minlength=n), n_lines),
        "word_length": _share(per_row(size), n_words),
        "small_words": _share(per_row(size <= 3), n_words),
    }


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """rows x labellers of NONE, BAD or GOOD."""
    some = m["n_words"] >= 5

    def rule(bad, good, where=some):
        return np.where(~where, NONE, np.where(bad, BAD, np.where(good, GOOD, NONE)))

    no = np.zeros(len(some), bool)
    return np.stack([
        rule(m["n_words"] < 1, m["n_words"] >= 20, ~no),
        # Each of these knows one kind of junk.
        rule(m["symbols"] > 0.15, no),
        rule(m["capitals"] > 0.3, no),
        rule(m["repetition"] > 0.25, no),
        rule(m["dup_lines"] > 0.4, no, some & (m["n_lines"] >= 3)),
        rule(m["separators"] > 0.1, no),
        rule(m["shouting"] > 0.2, no),
        rule(m["sentences"] < 0.2, m["sentences"] > 0.7, some & (m["n_lines"] >= 2)),
        rule((m["word_length"] > 16) | (m["word_length"] < 2), no),
        rule(m["small_words"] < 0.05, m["small_words"] > 0.15, m["n_words"] >= 20),
    ], axis=1).astype(np.int64)


def pattern_of(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return (np.asarray(pattern)[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


def estimate(pattern: np.ndarray, count: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of good per vote pattern, by expectation-maximisation.

    Every labeller has two accuracies: how often it is right on good and on
    bad documents. A labeller that only votes bad has a rate of firing for
    either class, and is believed to be precise by as many quiet good
    documents as ``BELIEF`` times all there are; one that votes both ways has a rate of
    voting bad, among its votes, for either class. Silence counts for nothing:
    kinds of junk exclude each other, so the silence of the other detectors
    would speak for every document that one of them finds. The share of good
    documents is held at ``PRIOR``, which keeps the classes from drifting.
    """
    v = votes_of(pattern)
    count = count.astype(float)
    total = count.sum()
    detector = np.isin(np.arange(v.shape[1]), [LABELLERS.index(x) for x in DETECTORS])
    bad, good = (v == BAD).astype(float), (v == GOOD).astype(float)
    post = np.where(bad.any(axis=1), 0.1, PRIOR)
    for _ in range(rounds):
        logs = []
        for prior, extra, p in ((PRIOR, BELIEF * total, post), (1 - PRIOR, 0.0, 1 - post)):
            weight = count * p
            said_bad, said_good = weight @ bad + 1, weight @ good + 1
            quiet = weight.sum() - weight @ bad + 1 + extra
            rate = said_bad / (said_bad + np.where(detector, quiet, said_good))
            of_good = np.where(detector, 0.0, np.log(1 - rate))
            logs.append(np.log(prior) + bad @ np.log(rate) + good @ of_good)
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-9:
            break
    return post


def shape_slots(offs: np.ndarray, data: np.ndarray):
    """(slot, row) of every byte-class triple."""
    c = _CLASSES[data]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    slot = (c[:-2] * N_CLASSES + c[1:-1]) * N_CLASSES + c[2:]
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    inside = row[:-2] == row[2:]
    return slot[inside], row[:-2][inside]


def bucket_slots(m: dict[str, np.ndarray]) -> np.ndarray:
    """rows x 6 slots of bucketed measures."""
    logs = np.minimum(np.log2(m["n_words"] + 1).astype(int), BUCKETS - 1)
    cols = [logs] + [np.minimum((m[k] * (BUCKETS - 1)).astype(int), BUCKETS - 1) for k in (
        "repetition", "dup_lines", "sentences", "small_words", "shouting")]
    return np.stack([SHAPES + BUCKETS * k + c for k, c in enumerate(cols)], axis=1)


def _pattern_rows(names: list[str]):
    def run(batches):
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for part in slices(batches, step=STEP):
            v = votes(measures(*offsets_of(part.column("text"))))
            total += np.bincount(pattern_of(v), minlength=len(total))
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=names)
    return run


def _train_rows(names: list[str]):
    """Per document its pattern and shape frequencies (in 1/65535)."""
    def run(batches):
        for part in slices(batches, step=STEP):
            offs, data = offsets_of(part.column("text"))
            m = measures(offs, data)
            slot, row = shape_slots(offs, data)
            n = part.num_rows
            counts = np.bincount(row * SHAPES + slot, minlength=n * SHAPES).reshape(n, SHAPES)
            share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
            yield pa.RecordBatch.from_arrays([
                part.column("place"), pa.array(pattern_of(votes(m))),
                pa.array([(x * 65535).astype("<u2").tobytes() for x in share], pa.binary()),
                pa.array([x.astype("<i4").tobytes() for x in bucket_slots(m)], pa.binary())],
                names=names)
    return run


def _train(posterior: dict, rounds: int, rate: float, decay: float):
    """One task over the bounded sample: logistic regression on posteriors."""
    def run(batches):
        place, pattern, shape, bucket = [], [], [], []
        for b in batches:
            place += b.column("place").to_pylist()
            pattern += b.column("pattern").to_pylist()
            shape += [np.frombuffer(x, "<u2") for x in b.column("shape").to_pylist()]
            bucket += [np.frombuffer(x, "<i4") for x in b.column("bucket").to_pylist()]
        if not place:
            return
        order = np.argsort(np.array(place), kind="stable")
        x = np.stack(shape)[order].astype(np.float32) / 65535
        y = np.array([posterior[p] for p in pattern])[order].astype(np.float32)
        hot = np.stack(bucket)[order] - SHAPES
        scale = np.sqrt((x ** 2).mean(axis=0)) + 1e-4
        x /= scale
        # Both classes weigh the same in sum.
        weight = y / max(y.sum(), 1) + (1 - y) / max((1 - y).sum(), 1)
        weight /= weight.mean()
        w, h, b0 = np.zeros(SHAPES), np.zeros(SLOTS - SHAPES), 0.0
        gw, gh, gb = np.full(SHAPES, 1e-6), np.full(SLOTS - SHAPES, 1e-6), 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w + h[hot].sum(axis=1) + b0, -30, 30)))
            d = (weight * (p - y)).astype(np.float32) / len(y)
            step = x.T @ d + decay * w
            step_h = np.bincount(hot.ravel(), weights=np.repeat(d, hot.shape[1]),
                                 minlength=len(h)) + decay * h
            gw += step ** 2
            gh += step_h ** 2
            gb += d.sum() ** 2
            w -= rate * step / np.sqrt(gw)
            h -= rate * step_h / np.sqrt(gh)
            b0 -= rate * d.sum() / np.sqrt(gb)
        yield pa.RecordBatch.from_arrays([
            pa.array([np.concatenate([w / scale, h]).tobytes()], pa.binary()),
            pa.array([float(b0)])], names=["weights", "intercept"])
    return run


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS):
    """(posterior per vote pattern, weights, intercept) from ``docs(doc_id, text)``."""
    docs = need(docs, "doc_id", "text")
    patterns = (docs.select("text").mapInArrow(_pattern_rows(["pattern", "n"]),
                                               "pattern bigint, n bigint")
                .groupBy("pattern").agg(F.sum("n").alias("n")).collect())
    if not patterns:
        return {}, np.zeros(SLOTS), 30.0
    name = np.array([r[0] for r in patterns])
    n = np.array([r[1] for r in patterns])
    posterior = dict(zip(name.tolist(), estimate(name, n).tolist()))
    one_in = max(1, int(n.sum()) // train_docs)
    names = ["place", "pattern", "shape", "bucket"]
    rows = (docs.withColumn("place", F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)))
            .filter(F.pmod("place", F.lit(one_in)) == 0).select("place", "text")
            .mapInArrow(_train_rows(names),
                        "place bigint, pattern bigint, shape binary, bucket binary"))
    trained = rows.limit(train_docs + train_docs // 2).mapInArrow(
        _train(posterior, 200, 0.1, 1e-5), "weights binary, intercept double").collect()
    if not trained:
        return posterior, np.zeros(SLOTS), 30.0
    return posterior, np.frombuffer(trained[0][0]), trained[0][1]


def _judge(model, part: pa.RecordBatch):
    posterior, weights, intercept = model
    offs, data = offsets_of(part.column("text"))
    m = measures(offs, data)
    n = part.num_rows
    slot, row = shape_slots(offs, data)
    logit = np.bincount(row, weights=weights[slot], minlength=n) / np.maximum(
        np.bincount(row, minlength=n), 1)
    logit += weights[bucket_slots(m)].sum(axis=1) + intercept
    weak = np.array([posterior.get(p, 0.5) for p in pattern_of(votes(m)).tolist()])
    return weak, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _score_rows(shared, names: list[str], threshold: float):
    def run(batches):
        for part in slices(batches, step=STEP):
            weak, score = _judge(shared.value, part)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(weak, pa.float64()), pa.array(score),
                pa.array(score >= threshold)], names=names)
    return run


def classify(docs: DataFrame, model=None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, weak_good (posterior of the votes), score and kept of every row."""
    docs = need(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "weak_good", "score", "kept"]
    return docs.mapInArrow(_score_rows(shared, names, threshold),
                           f"doc_id {kind}, weak_good double, score double, kept boolean")


def _keep_rows(shared, threshold: float):
    def run(batches):
        for part in slices(batches, step=STEP):
            yield part.filter(pa.array(_judge(shared.value, part)[1] >= threshold))
    return run


def keep_good(docs: DataFrame, model=None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    return docs.mapInArrow(_keep_rows(shared, threshold), docs.schema)
