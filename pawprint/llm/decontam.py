"""Benchmark decontamination with a stored positional inverted index.

``build_index`` writes the postings of every training word: one row per shard
of documents, holding the shard's terms, and for every term the ascending
places of its occurrences. ``search`` intersects, shard by shard, the
offset-adjusted lists of a window's terms, from the term that is rarest in
the shard to the commonest, and returns exact phrase matches; ``near``
matches have all words of a window within ``slop`` words of its rarest one.

Words are maximal runs of ASCII letters and digits (A-Z as a-z) and non-ASCII
characters; terms are 64-bit hashes of them. Null and empty texts have no
words; items of fewer than ``width`` words are one window, items without
words none; a null item id counts as the empty id; repeated items count once
per id; documents are matched row by row, repeated rows too; extra columns
are ignored; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import ALNUM, need, offsets_of, slices, word_hashes
from pawprint.session import scratch_path

WIDTH = 10
SLOP = 20
#: Words of benchmark items that one search holds in every task (8 bytes each
#: and place); more items are searched in several passes.
PASS_WORDS = 2_000_000
INDEX = ("shard bigint, doc_ids array<{kind}>, n_words array<bigint>, terms binary, "
         "counts binary, places binary")


def _squeeze(values: np.ndarray) -> bytes:
    """uint32 values with their byte planes apart, compressed."""
    import zstandard
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unsqueeze(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def postings(hashes: np.ndarray):
    """Terms (ascending), occurrences of each, and places sorted by term and place."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else order
    return ranked[first], np.diff(np.r_[first, len(ranked)]), order


def _index_rows(names: list[str]):
    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        for part in slices(batches, step=4 << 20):
            offs, data = offsets_of(part.column("text"))
            hashes, row, _, _ = word_hashes(data, offs, ALNUM)
            terms, counts, places = postings(hashes)
            # Differences within a term's list; a list starts with its first place.
            delta = np.diff(places, prepend=0)
            starts = np.cumsum(counts) - counts
            delta[starts] = places[starts]
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int64()),
                pa.array([part.column("doc_id").to_pylist()],
                         pa.list_(part.schema.field("doc_id").type)),
                pa.array([np.bincount(row, minlength=part.num_rows)], pa.list_(pa.int64())),
                pa.array([terms.tobytes()], pa.binary()),
                pa.array([_squeeze(counts)], pa.binary()),
                pa.array([_squeeze(delta)], pa.binary())], names=names)
            shard += 1
    return run


def build_index(docs: DataFrame, path: str) -> None:
    """Write the positional index of ``docs(doc_id, text)`` to ``path``."""
    docs = need(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["shard", "doc_ids", "n_words", "terms", "counts", "places"]
    docs.mapInArrow(_index_rows(names), INDEX.format(kind=kind)).write.parquet(path)


def item_windows(items: list[tuple[str, str]], width: int):
    """Distinct windows by length: {length: (terms [n, length], item numbers per window)}."""
    ids, found = [], {}
    raw = [(t or "").encode() for _, t in items]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    hashes, row, _, _ = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offs, ALNUM)
    per_item = np.split(hashes, np.cumsum(np.bincount(row, minlength=len(items)))[:-1]) \
        if len(items) else []
    for (item, _), words in zip(items, per_item):
        ids.append(item)
        n = min(width, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            key = words[at:at + n].tobytes()
            found.setdefault(n, {}).setdefault(key, []).append(len(ids) - 1)
    return ids, {n: (np.frombuffer(b"".join(w), np.uint64).reshape(-1, n), list(w.values()))
                 for n, w in found.items()}


class Shard:
    """One index row, opened for searching."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = _unsqueeze(row["counts"]).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        delta = _unsqueeze(row["places"]).astype(np.int64)
        total = np.cumsum(delta)
        base = np.repeat(total[self.starts] - delta[self.starts], self.counts) \
            if len(delta) else delta
        self.places = total - base
        term = np.repeat(np.arange(len(self.terms)), self.counts)
        #: Every posting as one number, ascending: term, then place.
        self.keys = (term << 32) | self.places
        n_words = np.array(row["n_words"], np.int64)
        self.doc_end = np.cumsum(n_words)
        self.doc_start = self.doc_end - n_words

    def _plan(self, windows: np.ndarray):
        """Windows of which every term occurs here: number, terms and order of rarity."""
        at = np.searchsorted(self.terms, windows)
        at = np.minimum(at, max(len(self.terms) - 1, 0))
        here = (self.terms[at] == windows).all(axis=1) if len(self.terms) else np.zeros(
            len(windows), bool)
        which = np.flatnonzero(here)
        at = at[which]
        return which, at, np.argsort(self.counts[at] if len(at) else at, axis=1, kind="stable")

    def _rarest(self, which, at, order):
        """Occurrences of each window's rarest term: (number in ``which``, place)."""
        term = at[np.arange(len(which)), order[:, 0]]
        n = self.counts[term]
        number = np.repeat(np.arange(len(which)), n)
        inside = np.arange(len(number)) - np.repeat(np.cumsum(n) - n, n)
        return number, self.places[self.starts[term][number] + inside]

    def _has(self, term, low, high):
        """Whether ``term`` occurs at a place from ``low`` to ``high``."""
        at = np.searchsorted(self.keys, (term << 32) | low)
        return (at < len(self.keys)) & (
            self.keys[np.minimum(at, len(self.keys) - 1)] <= ((term << 32) | high))

    def phrases(self, windows: np.ndarray):
        """(window number, document, start place) of every exact occurrence."""
        which, at, order = self._plan(windows)
        if not len(which):
            return (np.zeros(0, np.int64),) * 3
        number, place = self._rarest(which, at, order)
        start = place - order[number, 0]
        doc = np.searchsorted(self.doc_end, place, side="right")
        ok = (start >= self.doc_start[doc]) & (start + windows.shape[1] <= self.doc_end[doc])
        number, start, doc = number[ok], start[ok], doc[ok]
        for k in range(1, windows.shape[1]):
            col = order[number, k]
            want = start + col
            ok = self._has(at[number, col], want, want)
            number, start, doc = number[ok], start[ok], doc[ok]
        return which[number], doc, start

    def near(self, windows: np.ndarray, slop: int):
        """(window number, document) where all words lie within ``slop`` of the rarest."""
        which, at, order = self._plan(windows)
        if not len(which):
            return (np.zeros(0, np.int64),) * 2
        number, place = self._rarest(which, at, order)
        doc = np.searchsorted(self.doc_end, place, side="right")
        for k in range(1, windows.shape[1]):
            low = np.maximum(place - slop, self.doc_start[doc])
            high = np.minimum(place + slop, self.doc_end[doc] - 1)
            ok = self._has(at[number, order[number, k]], low, high)
            number, place, doc = number[ok], place[ok], doc[ok]
        return which[number], doc


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping or touching (start, end) spans joined, ascending."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


def _search_rows(found, slop: int, names: list[str], types: list):
    ids, by_length = found

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                n = len(row["n_words"])
                spans: list[list] = [[] for _ in range(n)]
                items: list[set] = [set() for _ in range(n)]
                near: list[set] = [set() for _ in range(n)]
                for length, (windows, owners) in by_length.items():
                    w, d, s = shard.phrases(windows)
                    s = s - shard.doc_start[d]
                    for wi, di, si in zip(w.tolist(), d.tolist(), s.tolist()):
                        spans[di].append((si, si + length))
                        items[di].update(owners[wi])
                    w, d = shard.near(windows, slop)
                    for wi, di in zip(w.tolist(), d.tolist()):
                        near[di].update(owners[wi])
                spans = [merged(s) for s in spans]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * n, types[0]), pa.array(range(n), types[1]),
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    pa.array(row["n_words"], types[3]),
                    pa.array([[a for a, _ in s] for s in spans], types[4]),
                    pa.array([[b for _, b in s] for s in spans], types[5]),
                    pa.array([[ids[i] for i in x] for x in items], types[6]),
                    pa.array([[ids[i] for i in x] for x in near], types[7])], names=names)
    return run


def search(spark, path: str, benchmark: DataFrame, width: int = WIDTH,
           slop: int = SLOP) -> DataFrame:
    """All indexed documents: doc_id, n_words, starts and ends of the words hit by
    exact windows (merged, in words), ids of the matched items and of the items
    with a proximity match. The benchmark is searched in passes of bounded size."""
    items = need(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_passes = 1 + total // (PASS_WORDS * 4)
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["shard", "row", "doc_id", "n_words", "starts", "ends", "items", "near"]
    texts, places = pa.list_(pa.string()), pa.list_(pa.int64())
    types = [pa.int64(), pa.int32(), None, pa.int64(), places, places, texts, texts]
    schema = (f"shard bigint, row int, doc_id {kind}, n_words bigint, starts array<bigint>, "
              "ends array<bigint>, items array<string>, near array<string>")
    out = None
    for k in range(n_passes):
        block = items if n_passes == 1 else items.filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(n_passes)) == k)
        found = item_windows([(r[0], r[1]) for r in block.collect()], width)
        hits = files.mapInArrow(_search_rows(found, slop, names, types), schema)
        out = hits if out is None else out.unionByName(hits)
    if n_passes > 1:
        out = out.groupBy("shard", "row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in names[4:]])
    return out


def _digest_rows(names: list[str]):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            hit = [sum(b - a for a, b in merged(zip(r["starts"], r["ends"]))) for r in rows]
            items = [sorted(set(r["items"])) for r in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([h > 0 for h in hit])], names=names)
    return run


def digest(found: DataFrame) -> DataFrame:
    kind = found.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return found.select("doc_id", "n_words", "starts", "ends", "items").mapInArrow(
        _digest_rows(names), f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, "
        "items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Index ``docs``, search ``benchmark``, and report each document's hits."""
    spark = docs.sparkSession
    path = scratch_path(spark, "positional-index")
    build_index(docs, path)
    return digest(search(spark, path, benchmark))


#: The words of a text, as DuckDB finds them.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), {WIDTH}) AS n, array_to_string(
         w[s:s + least(len(w), {WIDTH}) - 1], ' ') AS k
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1)) AS s
             FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)),
m AS (SELECT rid, s, dw.n AS n, item FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
h AS (SELECT rid, count(DISTINCT p) AS n_hit
      FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM m) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)
"""
