"""Source divergence audit by single-pass in-memory indexing.

A task reads its documents once and counts (language, source, term) postings
in memory until the block holds ``block_bytes``; the block is then spilled as
one run: per hash shard of the terms, segments in term order. Segments go to
their shard, where a heap merges the runs: segments arrive by first term, a
term leaves the heap when no later segment can hold it, so at most one open
segment a run is in memory. The merged frequencies (terms in enough documents
of their language) are a written table.

Divergences between sources are sums over all kept terms. For nearly all of
them both sources have count 0, where the value is one constant a pair; the
sum starts at that constant times the number of terms, terms of one source
correct it through a histogram of its counts, and terms of both sources are
streamed term by term into exact partial sums.

Arithmetic is in 64-bit integers and exact as long as a language has fewer
than 2.9e14 term occurrences.

Null lang, source and text count as empty. Every row is a document of its
own, repeated or not; doc_id and extra columns are ignored. A group without
terms, or a language without kept terms, has pair rows of value 0 and no term
rows; a language of one source has no pair rows; an empty table gives no
rows. Ties are ranked by the item's UTF-8 bytes. A text's terms are counted
in pieces of a few MB, so its length does not matter.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pawprint.llm.common import STEP_BYTES, need, offsets_of, partitions, slices, stored

#: Memory of a block's postings, text bytes per shard, terms per segment.
BLOCK_BYTES = 64 << 20
SHARD_BYTES = 64 << 20
SEGMENT_TERMS = 4096
#: Documents of its language that hold a kept term, and ranks of the term part.
LEAST_DOCS = 3
TOP_TERMS = 200
#: What an entry costs beside its term: dictionary slot, bytes object, count.
ENTRY_BYTES = 160

RUN = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()),
                 ("terms", pa.binary()), ("docs", pa.binary()), ("lens", pa.binary()),
                 ("places", pa.binary()), ("counts", pa.binary()),
                 ("names", pa.list_(pa.string()))])
RUN_DDL = ("shard int, lang string, first binary, terms binary, docs binary, lens binary, "
           "places binary, counts binary, names array<string>")
MERGED = pa.schema([("lang", pa.string()), ("term", pa.string()),
                    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
MERGED_DDL = "lang string, term string, sources array<string>, counts array<bigint>"
PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()),
                   ("value", pa.int64())])
PAIRS_DDL = "lang string, source string, other string, value bigint"


def _term_table() -> bytes:
    """Bytes of terms (letters, A-Z as a-z, and all from 0x80 on); others become blanks."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table.tobytes()


def _pieces(raw: bytes, start: int, end: int) -> Iterator[bytes]:
    """``raw[start:end]`` in pieces of about ``STEP_BYTES``, cut at blanks."""
    while end - start > STEP_BYTES:
        cut = raw.find(b" ", start + STEP_BYTES, end)
        if cut < 0:
            break
        yield raw[start:cut]
        start = cut
    yield raw[start:end]


class Block:
    """Postings in memory: occurrences per (lang, source), documents per lang."""

    def __init__(self):
        self.occurrences: dict[str, dict[str, Counter]] = {}
        self.documents: dict[str, Counter] = {}
        self.bytes = 0

    def add(self, lang: str, source: str, raw: bytes, start: int, end: int) -> None:
        counts = self.occurrences.setdefault(lang, {}).setdefault(source, Counter())
        docs = self.documents.setdefault(lang, Counter())
        before, seen, words = len(counts) + len(docs), set(), 0
        for piece in _pieces(raw, start, end):
            found = piece.split()
            counts.update(found)
            seen.update(found)
            words += len(found)
        docs.update(seen)
        self.bytes += ((len(counts) + len(docs) - before)
                       * (ENTRY_BYTES + (end - start) // max(words, 1)))

    def run(self, shards: int) -> Iterator[dict]:
        """The block as one run: segments of every language and shard, in term order."""
        for lang, docs in self.documents.items():
            terms = sorted(docs)
            at = {t: i for i, t in enumerate(terms)}
            names = sorted(self.occurrences[lang])
            held = [self.occurrences[lang][n] for n in names]
            term = np.fromiter((at[t] for c in held for t in c), np.int64, sum(map(len, held)))
            place = np.repeat(np.arange(len(held), dtype=np.int32), [len(c) for c in held])
            count = np.fromiter((n for c in held for n in c.values()), np.int64, len(term))
            order = np.argsort(term, kind="stable")
            place, count = place[order], count[order]
            ends = np.searchsorted(term[order], np.arange(len(terms)), side="right")
            lens = np.diff(ends, prepend=0)
            shard = np.fromiter((zlib.crc32(t) % shards for t in terms), np.int32, len(terms))
            n_docs = np.fromiter((docs[t] for t in terms), np.int64, len(terms))
            by_shard = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.diff(shard[by_shard])) + 1
            for part in np.split(by_shard, edges) if len(by_shard) else ():
                for a in range(0, len(part), SEGMENT_TERMS):
                    own = part[a:a + SEGMENT_TERMS]
                    width = lens[own]
                    total = np.cumsum(width)
                    where = np.arange(total[-1]) + np.repeat(ends[own] - total, width)
                    yield {"shard": int(shard[own[0]]), "lang": lang, "first": terms[own[0]],
                           "terms": b"\n".join([terms[i] for i in own]),
                           "docs": n_docs[own].tobytes(),
                           "lens": width.astype(np.int32).tobytes(),
                           "places": place[where].tobytes(), "counts": count[where].tobytes(),
                           "names": names}


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _build(shards: int, block_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table, block = _term_table(), Block()
        for batch in slices(batches):
            offs, data = offsets_of(batch.column("text"))
            raw = data.tobytes().translate(table)
            langs = batch.column("lang").to_pylist()
            sources = batch.column("source").to_pylist()
            for i, (lang, source) in enumerate(zip(langs, sources)):
                block.add(lang, source, raw, int(offs[i]), int(offs[i + 1]))
                if block.bytes >= block_bytes:
                    yield from block.run(shards)
                    block = Block()
        yield from block.run(shards)

    def build(batches):
        return _batches(rows(batches), RUN, 16)
    return build


class Segment:
    """A run's next terms, read one by one."""

    def __init__(self, row: dict):
        self.terms = row["terms"].split(b"\n")
        self.docs = np.frombuffer(row["docs"], np.int64).tolist()
        self.ends = np.cumsum(np.frombuffer(row["lens"], np.int32)).tolist()
        self.places = np.frombuffer(row["places"], np.int32).tolist()
        self.counts = np.frombuffer(row["counts"], np.int64).tolist()
        self.names = row["names"]
        self.i = self.at = 0

    def take(self, found: dict[str, int]) -> int:
        """Add this term's postings to ``found``; the number of documents."""
        end = self.ends[self.i]
        for k in range(self.at, end):
            name = self.names[self.places[k]]
            found[name] = found.get(name, 0) + self.counts[k]
        self.at = end
        self.i += 1
        return self.docs[self.i - 1]


def _merge(least: int):
    def drain(heap: list, lang: str, limit: bytes | None) -> Iterator[dict]:
        """Terms below ``limit`` (none: all), each from all runs that hold it."""
        while heap and (limit is None or heap[0][0] < limit):
            term, n_docs, found = heap[0][0], 0, {}
            while heap and heap[0][0] == term:
                _, number, segment = heap[0]
                n_docs += segment.take(found)
                if segment.i < len(segment.terms):
                    heapq.heapreplace(heap, (segment.terms[segment.i], number, segment))
                else:
                    heapq.heappop(heap)
            if n_docs >= least:
                names = sorted(found)
                yield {"lang": lang, "term": term.decode(), "sources": names,
                       "counts": [found[n] for n in names]}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        heap: list = []
        here, number = (None, ""), 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in RUN.names}
                if (row["shard"], row["lang"]) != here:
                    yield from drain(heap, here[1], None)
                    here = (row["shard"], row["lang"])
                else:
                    yield from drain(heap, here[1], row["first"])
                number += 1
                heapq.heappush(heap, (row["first"], number, Segment(row)))
        yield from drain(heap, here[1], None)

    def merge(batches):
        return _batches(rows(batches), MERGED, 4096)
    return merge


def _texts(docs: DataFrame) -> DataFrame:
    plain = need(docs, "text", "lang", "source")
    return plain.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                  for c in ("lang", "source")])


def group_sizes(docs: DataFrame) -> DataFrame:
    """(lang, source, bytes) of every group, one row a group."""
    return _texts(docs).groupBy("lang", "source").agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).alias("bytes"))


def frequencies(docs: DataFrame, shards: int, least: int = LEAST_DOCS,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, term, sources, counts): the postings of every term in ``least`` documents."""
    runs = _texts(docs).mapInArrow(_build(shards, block_bytes), RUN_DDL)
    return (runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
            .mapInArrow(_merge(least), MERGED_DDL))


def _share(count, n, v) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)), by parts that fit 64 bits."""
    x, m = F.col(count) + 1 if isinstance(count, str) else count + 1, F.greatest(n + v, F.lit(1))
    m = m.cast("bigint")
    whole = F.call_function("div", x * 32000, m)
    return (1 + whole * 31250 + F.call_function("div", (x * 32000 - whole * m) * 31250, m)
            ).cast("bigint")


def _gap(p, q) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of terms that both sources of a pair hold, as partial sums."""
    sums: dict[tuple, int] = {}

    def out():
        rows = [(*k, v) for k, v in sums.items()]
        sums.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), PAIRS)], schema=PAIRS)

    for batch in batches:
        held = batch.column("held")
        lens = np.diff(np.asarray(held.offsets))
        first = np.cumsum(lens) - lens
        flat = held.flatten()
        coded = flat.field("source").dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        names, p, b = coded.dictionary.to_pylist(), np.asarray(flat.field("p")), np.asarray(
            flat.field("b"))
        langs = batch.column("lang").dictionary_encode()
        lang_of = np.asarray(langs.indices)
        for lang, wide in sorted({*zip(lang_of.tolist(), lens.tolist())}):
            rows = np.flatnonzero((lang_of == lang) & (lens == wide))
            # Terms of equally many sources are one array of pairs; long lists go
            # through it a part of the first sides at a time.
            sides = max(1, min(wide, (1 << 19) // max(wide, 1)))
            many = max(1, (1 << 19) // max(sides * wide, 1))
            for r in range(0, len(rows), many):
                at = first[rows[r:r + many], None] + np.arange(wide)
                for s in range(0, wide, sides):
                    one = at[:, s:s + sides]
                    pa_, ba, pb, bb = (p[one][:, :, None], b[one][:, :, None],
                                       p[at][:, None, :], b[at][:, None, :])
                    value = ((pa_ - pb) ** 2 // pb - (pa_ - bb) ** 2 // bb
                             - (ba - pb) ** 2 // pb + (ba - bb) ** 2 // bb).ravel()
                    key = (code[one][:, :, None] * len(names) + code[at][:, None, :]).ravel()
                    keys, inverse = np.unique(key, return_inverse=True)
                    total = np.zeros(len(keys), np.int64)
                    np.add.at(total, inverse, value)
                    name = langs.dictionary[lang].as_py()
                    for k, v in zip(keys.tolist(), total.tolist()):
                        x, y = divmod(k, len(names))
                        if x != y:
                            k = (name, names[x], names[y])
                            sums[k] = sums.get(k, 0) + v
                    if len(sums) > 200_000:
                        yield out()
    if sums:
        yield out()


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS,
               block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and the terms
    that a source has more of than its language."""
    spark = docs.sparkSession
    groups = stored(group_sizes(docs), "audit-groups")
    size = groups.agg(F.sum("bytes")).first()[0] or 0
    shards = max(partitions(spark), -(-size // shard_bytes))
    kept = stored(frequencies(docs, shards, least, block_bytes), "audit-terms")

    flat = kept.select(
        "lang", "term", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias(
            "total"), F.explode(F.arrays_zip("sources", "counts")).alias("e")
    ).select("lang", "term", "total", F.col("e.sources").alias("source"),
             F.col("e.counts").alias("count"))
    seen = flat.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    whole = seen.groupBy("lang").agg(F.sum("n").alias("lang_n"))
    zero = F.lit(0).cast("bigint")
    stats = stored(
        groups.select("lang", "source").join(seen, ["lang", "source"], "left")
        .join(terms, "lang", "left").join(whole, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "lang_n")])
        .withColumn("b", _share(zero, F.col("n"), F.col("v"))), "audit-groups-priced")

    priced = flat.join(stats, ["lang", "source"]).select(
        "lang", "source", "term", "b", _share("count", F.col("n"), F.col("v")).alias("p"),
        _share("total", F.col("lang_n"), F.col("v")).alias("q"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    term_part = (priced.filter("p > q")
                 .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                         _gap(F.col("p"), F.col("q")).alias("value"))
                 .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))

    other = stats.select("lang", F.col("source").alias("other"), F.col("b").alias("ob"))
    pairs = stats.join(other, "lang").filter(F.col("source") != F.col("other"))
    constant = pairs.select("lang", "source", "other",
                            (F.col("v") * _gap(F.col("b"), F.col("ob"))).alias("value"))
    levels = priced.groupBy("lang", "source", "p", "b").agg(F.count(F.lit(1)).alias("k"))
    p, b, ob, k = F.col("p"), F.col("b"), F.col("ob"), F.col("k")
    single = (levels.join(other, "lang").filter(F.col("source") != F.col("other"))
              .groupBy("lang", "source", "other")
              .agg(F.sum(k * (_gap(p, ob) - _gap(b, ob))).alias("there"),
                   F.sum(k * (_gap(ob, p) - _gap(ob, b))).alias("back")))
    joint = (priced.groupBy("lang", "term")
             .agg(F.collect_list(F.struct("source", "p", "b")).alias("held"))
             .filter(F.size("held") > 1).select("lang", "held").mapInArrow(_joint, PAIRS_DDL))
    parts = (constant
             .unionByName(single.select("lang", "source", "other", F.col("there").alias("value")))
             .unionByName(single.select("lang", F.col("other").alias("source"),
                                        F.col("source").alias("other"),
                                        F.col("back").alias("value")))
             .unionByName(joint))
    pair_part = (parts.groupBy("lang", "source", F.col("other").alias("item"))
                 .agg(F.sum("value").alias("value"))
                 .withColumn("part", F.lit("pair"))
                 .withColumn("rank", F.row_number().over(order)))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pair_part.select(*columns).unionByName(term_part.select(*columns))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang,
             coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT rid, lang, source, unnest(
        regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY 1, 2
         HAVING count(DISTINCT rid) >= {LEAST_DOCS}),
lv AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY 1),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (kept.n + 1)) // (lv.n + v) AS q
      FROM kept JOIN lv USING (lang)),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term)
      GROUP BY 1, 2, 3),
s AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY 1, 2),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + lv.v) AS p
      FROM g JOIN kept k ON k.lang = g.lang JOIN lv ON lv.lang = g.lang
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
       FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
       GROUP BY 1, 2, 3),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tr AS (SELECT f.lang, f.source, 'term' AS part, f.term AS item, ((p - q) * (p - q)) // q AS value
       FROM f JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pr UNION ALL SELECT * FROM tr))
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
