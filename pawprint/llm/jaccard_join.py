"""Exact Jaccard join of shingle sets in a metric space of regions around pivots.

1 - J is a metric, so a document within r = 1/4 of another lies, for any
pivot p, within r of it on the scale of distances to p, and within 2r of the
border between two pivots' Voronoi regions if the two fall on different sides.

Level 0. A document as pivot is at distance 1 from nearly all others, which
separates nothing. Pivots of this level are one-shingle sets {s}: a document
x is at distance 1 - 1/|x| from the pivots in it and at 1 from all others.
Ties go to the pivot first in a global order (rare shingles first, by a
count-min sketch of all documents). Two documents within r share at least 3/4
of x, so x is placed in the regions of its first |x| - ceil(3/4 |x|) + 1
pivots: the window that keeps every link inside a region.

Between levels. Regions of few members give candidate pairs; a pair whose
parity sketches differ in more bits than the symmetric difference of two
linked sets can have is no link, exactly. Larger regions are compared by
sketches as a whole, the largest stay together. What still hangs together is
a group, and no link leaves a group.

Level 1 and on. Inside a group pivots are documents: members within r of a
pivot join its class, all go to the Voronoi region of their nearest pivot and
into those whose border window they fall into, and regions recurse until they
are small or one class, where the rest is compared exactly under the same
bounds. Groups beyond ``GROUP_DOCS`` members are dealt over chunks that share
the pivots of highest degree; what no chunk links to the largest class is
then compared with all chunks, block by block.

Rows with the same text are one class, so copies are never paired. Null and
empty texts have no shingles, link with nothing and are their own component.
Rows of one doc_id are one document. A null doc_id has a null component and
links nothing. Sets are compared as 64-bit hashes of word sequences. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import (SPACE, cut, need, offsets_of, partitions, shingles, slices,
                                 stored, word_hashes)

WIDTH = 5
#: A region of at most so many members is compared pair by pair.
SMALL_REGION = 16
#: One of at most so many by sketches in one task; a larger one is a star.
MIDDLE_REGION = 2000
PAIR, MEMBER, STAR = range(3)
#: Counters of the count-min sketch (4 bytes each), for every size of input.
COUNTERS = 1 << 20
COUNTER_BLOCKS = 64
#: A group of more members is dealt over chunks of so many.
GROUP_DOCS = 20_000
#: Members of a region that is not divided further, and pivots of a larger one.
LEAF, PIVOTS = 64, 6


def sets_of(part: pa.RecordBatch, width: int):
    """Distinct shingle hashes of every row: (hashes sorted within rows, row offsets)."""
    offs, data = offsets_of(part.column("text"))
    words, row, _, _ = word_hashes(data, offs, ~SPACE)
    h, r, _ = shingles(words, row, part.num_rows, width)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    if len(h):
        keep = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
        h, r = h[keep], r[keep]
    return h, np.searchsorted(r, np.arange(part.num_rows + 1))


def set_id(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def parity_sketch(values: np.ndarray) -> bytes:
    """One bit per bucket: whether an odd number of hashes falls into it.

    With a power of two of at least 2n buckets (at least 64). Two sketches
    differ in at most as many bits as their sets differ in elements, also
    after folding the longer onto the shorter.
    """
    size = max(64, 1 << int(2 * len(values) - 1).bit_length())
    counts = np.bincount((values % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def differing_bits(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(_ONES[x ^ y].sum())


def _profile_rows(width: int, names: list[str]):
    """Per document its set's size, id and sketch; per task the shingle counters."""
    def run(batches):
        counters = np.zeros(COUNTERS, np.uint32)
        kind = None
        for part in slices(batches):
            kind = part.schema.field("doc_id").type
            h, at = sets_of(part, width)
            counters += np.bincount((h >> np.uint64(20)).astype(np.int64) % COUNTERS,
                                    minlength=COUNTERS).astype(np.uint32)
            rows = [h[a:b] for a, b in zip(at[:-1], at[1:])]
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int32()), part.column("doc_id"),
                pa.array([len(x) for x in rows], pa.int64()),
                pa.array([set_id(x) for x in rows], pa.int64()),
                pa.array([parity_sketch(x) if len(x) else b"" for x in rows], pa.binary())],
                names=names)
        if kind is not None:
            import zstandard
            press = zstandard.ZstdCompressor(level=1)
            blocks = np.split(counters, COUNTER_BLOCKS)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(COUNTER_BLOCKS), pa.int32()), pa.nulls(COUNTER_BLOCKS, kind),
                pa.nulls(COUNTER_BLOCKS, pa.int64()), pa.nulls(COUNTER_BLOCKS, pa.int64()),
                pa.array([press.compress(b.tobytes()) for b in blocks], pa.binary())],
                names=names)
    return run


def _sum_counters(key, table):
    import zstandard
    total = np.zeros(COUNTERS // COUNTER_BLOCKS, np.uint64)
    for raw in table.column("data").to_pylist():
        total += np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint32)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                     "data": pa.array([total.tobytes()], pa.binary())})


def commonness(profile: DataFrame) -> np.ndarray:
    """Level of every counter: how many doublings its count is above the mean.

    Counts cover all documents; the result has a fixed size (1 MB)."""
    rows = (profile.filter("block IS NOT NULL").select("block", "data").groupBy("block")
            .applyInArrow(_sum_counters, "block int, data binary").collect())
    counts = np.zeros(COUNTERS, np.uint64)
    size = COUNTERS // COUNTER_BLOCKS
    for r in rows:
        counts[r[0] * size:(r[0] + 1) * size] = np.frombuffer(r[1], np.uint64)
    above = counts / max(8.0, float(counts.mean()) + 3 * float(counts.mean()) ** 0.5)
    return np.where(above >= 1, np.floor(np.log2(np.maximum(above, 1))) + 1, 0).astype(np.uint8)


def window_length(n: np.ndarray) -> np.ndarray:
    """Number of first pivots whose regions a set of n shingles enters."""
    return n - (3 * n + 3) // 4 + 1


def _window_rows(level, width: int, n_buckets: int, names: list[str]):
    """The windows of distinct sets, dealt over buckets of pivots.

    A row holds, for one bucket and one slice of documents: set ids, sizes,
    and entries (5 bytes of the pivot's hash and the set's number). Hashes
    cut to 40 bits can only add candidates.
    """
    def run(batches):
        seen: set[int] = set()
        levels = level.value
        for part in slices(batches):
            h, at = sets_of(part, width)
            n = np.diff(at)
            ids = [set_id(h[a:b]) for a, b in zip(at[:-1], at[1:])]
            fresh = np.zeros(len(n), bool)
            for i in np.flatnonzero(n).tolist():
                if ids[i] not in seen:
                    seen.add(ids[i])
                    fresh[i] = True
            row = np.repeat(np.arange(len(n)), n)
            lev = levels[(h >> np.uint64(20)).astype(np.int64) % COUNTERS].astype(np.uint64)
            order = np.lexsort(((lev << np.uint64(58)) | (h >> np.uint64(6)), row))
            h = h[order]
            place = np.arange(len(h)) - at[row]
            take = fresh[row] & (place < window_length(n)[row])
            h, row = h[take], row[take]
            bucket = (h % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            h, row, bucket = h[order], row[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            out = []
            ids = np.array(ids, np.int64)
            for b in range(n_buckets):
                x, r = h[cuts[b]:cuts[b + 1]], row[cuts[b]:cuts[b + 1]]
                if len(x):
                    members, number = np.unique(r, return_inverse=True)
                    pivots = np.ascontiguousarray(
                        (x // np.uint64(n_buckets)).astype("<u8").view(np.uint8)
                        .reshape(-1, 8)[:, :5])
                    out.append((b, ids[members].tobytes(), n[members].astype("<u4").tobytes(),
                                pivots.tobytes(), number.astype("<u4").tobytes()))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary())
                                                       for c in cols[1:]], names=names)
    return run


def region_edges(pivot: np.ndarray, ids: np.ndarray, size: np.ndarray):
    """What the regions of entries (pivot, set id, size) leave to compare.

    Pairs of small regions that sizes allow; members of middle regions, as
    (hash of the member list, set id), equal lists once; stars (first member
    to all others) of the largest.
    """
    order = np.lexsort((ids, size, pivot))
    pivot, ids, size = pivot[order], ids[order], size[order]
    keep = np.r_[True, (pivot[1:] != pivot[:-1]) | (ids[1:] != ids[:-1])]
    pivot, ids, size = pivot[keep], ids[keep], size[keep]
    start = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]])
    count = np.diff(np.r_[start, len(pivot)])
    pairs, members, stars = [], [], []
    for m in np.unique(count[(count > 1) & (count <= SMALL_REGION)]).tolist():
        first = start[count == m]
        for i, j in itertools.combinations(range(m), 2):
            x, y = first + i, first + j
            ok = 3 * size[y] <= 4 * size[x]  # ascending sizes within a region
            pairs.append(np.stack([ids[x[ok]], ids[y[ok]]], 1))
    lists = set()
    for s, m in zip(start[count > SMALL_REGION].tolist(), count[count > SMALL_REGION].tolist()):
        own = ids[s:s + m]
        name = set_id(own)
        if name in lists:
            continue
        lists.add(name)
        if m <= MIDDLE_REGION:
            members.append(np.stack([np.full(m, name), own], 1))
        else:
            stars.append(np.stack([np.full(m - 1, own[0]), own[1:]], 1))

    def distinct(rows, ordered):
        rows = np.concatenate(rows) if rows else np.zeros((0, 2), np.int64)
        rows = rows if ordered else np.sort(rows, axis=1)
        return np.unique(rows, axis=0) if len(rows) else rows

    return distinct(pairs, False), distinct(members, True), distinct(stars, False)


def _bucket_edges(key, table):
    pivot, ids, size = [], [], []
    for r in table.select(["ids", "sizes", "pivots", "numbers"]).to_pylist():
        raw = np.frombuffer(r["pivots"], np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :5] = raw
        number = np.frombuffer(r["numbers"], "<u4")
        pivot.append(wide.view("<u8").ravel())
        ids.append(np.frombuffer(r["ids"], np.int64)[number])
        size.append(np.frombuffer(r["sizes"], "<u4").astype(np.int64)[number])
    found = region_edges(*map(np.concatenate, (pivot, ids, size)))
    rows = np.concatenate(found)
    return pa.table({"a": pa.array(rows[:, 0], pa.int64()), "b": pa.array(rows[:, 1], pa.int64()),
                     "kind": pa.array(np.repeat([PAIR, MEMBER, STAR], [len(f) for f in found]),
                                      pa.int32())})


def _near_rows(names: list[str]):
    """Pairs that are in a star, or whose sketches leave a link possible."""
    def run(batches):
        for batch in batches:
            rows = batch.select(["kind", "n_a", "n_b", "data_a", "data_b"]).to_pylist()
            keep = [r["kind"] == STAR or 7 * differing_bits(r["data_a"], r["data_b"])
                    <= r["n_a"] + r["n_b"] for r in rows]
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)
    return run


def sketch_classes(size: np.ndarray, sketches: list[bytes]) -> list[int]:
    """Classes of sets under "the sketches leave a link possible", compared by
    size windows; a number of a member stands for its class."""
    forest = Forest(len(size))
    width = np.array([len(x) for x in sketches])
    bits = {}
    for w in np.unique(width).tolist():
        # Sketches of this width, and those twice as wide folded onto it.
        rows = np.zeros((len(size), w), np.uint8)
        for i in np.flatnonzero((width == w) | (width == 2 * w)).tolist():
            x = np.frombuffer(sketches[i], np.uint8)
            rows[i] = x if len(x) == w else x[:w] ^ x[w:]
        bits[w] = rows.view(np.uint64)
    order = np.argsort(size, kind="stable")
    ranked = size[order]
    for k, x in enumerate(order.tolist()):
        end = int(np.searchsorted(ranked, 4 * size[x] // 3, side="right"))
        others = order[k + 1:end]
        others = others[(width[others] == width[x]) | (width[others] == 2 * width[x])]
        if not len(others):
            continue
        rows = bits[int(width[x])]
        differ = np.bitwise_count(rows[others] ^ rows[x]).sum(axis=1, dtype=np.int64)
        for y in others[7 * differ <= size[others] + size[x]].tolist():
            forest.join(x, y)
    return [forest.find(x) for x in range(len(size))]


def _middle_region(key, table):
    root = sketch_classes(table.column("n").to_numpy(), table.column("data").to_pylist())
    node = table.column("node")
    at = pa.array(np.arange(len(root))[np.array(root) != np.arange(len(root))], pa.int64())
    return pa.table({"a": node.take(pa.array(root, pa.int64())).take(at), "b": node.take(at)})


# ---- inside a group ----------------------------------------------------------

class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


class Group:
    """Sets of one group, for distances from one to many."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        names, self.flat = np.unique(flat, return_inverse=True)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.mark = np.zeros(len(names), bool)
        #: Mean commonness of a set's shingles within the group.
        common = np.bincount(self.flat)
        self.central = np.add.reduceat(common[self.flat], self.start) / self.size

    def distances(self, x: int, others: np.ndarray) -> np.ndarray:
        mine = self.flat[self.start[x]:self.end[x]]
        self.mark[mine] = True
        n = self.size[others]
        ends = np.cumsum(n)
        where = np.arange(ends[-1]) + np.repeat(self.start[others] - (ends - n), n)
        both = np.add.reduceat(self.mark[self.flat[where]].astype(np.int64), ends - n)
        self.mark[mine] = False
        return both, self.size[x] + n - both


def linked(both, union):
    return 100 * both >= 75 * union


def resolve(sets: list[np.ndarray]) -> list[int]:
    """Class of each set under links, as the least number in it; exact."""
    forest = Forest(len(sets))
    if len(sets) < 2:
        return list(range(len(sets)))
    group = Group(sets)

    def roots(region):
        return np.array([forest.find(int(x)) for x in region])

    def compare_rest(region, known):
        """Members outside the largest class against all, where every known
        distance allows a link. ``known``: distances to pivots, a row each."""
        at = roots(region)
        names, count = np.unique(at, return_counts=True)
        largest = names[np.argmax(count)]
        for i in np.flatnonzero(at != largest).tolist():
            x = int(region[i])
            ok = np.array(roots(region) != forest.find(x))
            ok &= (4 * group.size[region] >= 3 * group.size[x]) & (
                4 * group.size[x] >= 3 * group.size[region])
            for d in known:
                ok &= np.abs(d - d[i]) <= 0.25 + 1e-9
            others = region[ok]
            if len(others):
                for y in others[linked(*group.distances(x, others))].tolist():
                    forest.join(x, y)

    stack = [(np.arange(len(sets)), 0)]
    while stack:
        region, depth = stack.pop()
        if len(region) < 2 or len(set(roots(region).tolist())) == 1:
            continue
        if len(region) <= LEAF:
            compare_rest(region, [])
            continue
        # The most central member first, then spread over the ranking.
        rank = region[np.argsort(-group.central[region], kind="stable")]
        picks = rank[np.unique(np.linspace(0, len(rank) - 1, PIVOTS).astype(int) if depth
                               else np.array([0, 1, 2, len(rank) // 2, len(rank) - 1]))]
        known = []
        for p in picks.tolist():
            both, union = group.distances(p, region)
            for y in region[linked(both, union)].tolist():
                forest.join(p, y)
            known.append(1 - both / union)
        if len(set(roots(region).tolist())) == 1:
            continue
        table = np.stack(known)
        near = table.min(axis=0)
        parts = [region[table[k] <= near + 0.5 + 1e-9] for k in range(len(picks))]
        if max(len(p) for p in parts) > 0.7 * len(region):
            compare_rest(region, known)  # borders everywhere: nothing to divide
        else:
            stack += [(p, depth + 1) for p in parts]
    return [forest.find(x) for x in range(len(sets))]


def _group_sets(texts: list[str], width: int) -> list[np.ndarray]:
    part = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    out = []
    for piece in cut(part):
        h, at = sets_of(piece, width)
        out += [h[a:b] for a, b in zip(at[:-1], at[1:])]
    return out


def _resolve_group(width: int, names: list[str]):
    """(node, root) for the members of a group (or of a chunk of one)."""
    def run(table):
        import zstandard
        node = table.column("node").to_pylist()
        press = zstandard.ZstdDecompressor()
        texts = [press.decompress(z).decode() for z in table.column("z").to_pylist()]
        root = resolve(_group_sets(texts, width))
        best: dict[int, object] = {}
        for x, r in zip(node, root):
            best[r] = min(best.get(r, x), x)
        kind = table.schema.field("node").type
        return pa.table([pa.array(node, kind), pa.array([best[r] for r in root], kind)],
                        names=names)
    return run


def _press_rows(names: list[str]):
    def run(batches):
        import zstandard
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [press.compress(t.encode()) for t in batch.column("text").to_pylist()]
            cols = {"z": pa.array(z, pa.binary())}
            yield pa.RecordBatch.from_arrays(
                [cols.get(c) if c in cols else batch.column(c) for c in names], names=names)
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the graph of ``edges(a, b)``; root is the least node reachable.

    Alternating large and small stars: every node's edges are moved to its
    least neighbour until nothing changes. Minima are partial aggregates and
    the joins may be split, so a hub needs no single task.
    """
    e = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"),
                                             F.greatest("a", "b").alias("b")).distinct(), "edges")
    last = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(
            F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), F.col("b")).unionByName(
            small.select(F.col("m").alias("a"), F.col("a").alias("b"))).filter(
            "a <> b").distinct()
        e = stored(small, "edges")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"),
                                                     F.lit(1 << 40)))).first()
        if mark == last:
            break
        last = mark
    return (e.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("root")))
            .distinct())


def candidate_groups(docs: DataFrame, profile: DataFrame, classes: DataFrame,
                     width: int) -> DataFrame:
    """(node, group): documents that may be linked, by level 0 and the sketches."""
    spark = docs.sparkSession
    n_buckets = 4 * partitions(spark)
    level = spark.sparkContext.broadcast(commonness(profile))
    names = ["bucket", "ids", "sizes", "pivots", "numbers"]
    windows = docs.mapInArrow(
        _window_rows(level, width, n_buckets, names),
        "bucket int, ids binary, sizes binary, pivots binary, numbers binary")
    found = stored(windows.groupBy("bucket").applyInArrow(
        _bucket_edges, "a bigint, b bigint, kind int").distinct(), "regions")
    side = lambda s: classes.select(
        F.col("sid").alias(s), F.col("node").alias(f"node_{s}"), F.col("n").alias(f"n_{s}"),
        F.col("data").alias(f"data_{s}"))
    kind = classes.schema["node"].dataType.simpleString()
    pairs = (found.filter(F.col("kind") != MEMBER).join(side("a"), "a").join(side("b"), "b")
             .mapInArrow(_near_rows(["node_a", "node_b"]), f"node_a {kind}, node_b {kind}")
             .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    middle = (found.filter(F.col("kind") == MEMBER)
              .join(classes.withColumnRenamed("sid", "b"), "b").select("a", "node", "n", "data")
              .groupBy("a").applyInArrow(_middle_region, f"a {kind}, b {kind}"))
    return stored(pairs.unionByName(middle), "candidates")


def _hot_roots(texts: DataFrame, degree: DataFrame, sizes: DataFrame, width: int,
               limit: int) -> DataFrame:
    """Links (a, b) inside groups of more than ``limit`` members."""
    spark = texts.sparkSession
    kind = texts.schema["node"].dataType.simpleString()
    names, schema = ["node", "root"], f"node {kind}, root {kind}"
    run = _resolve_group(width, names)
    hot = sizes.filter(F.col("members") > limit).withColumn(
        "chunks", F.ceil(F.col("members") * 2 / limit).cast("int"))
    deal = F.pmod(F.xxhash64("node"), F.col("chunks"))
    member = texts.join(hot, "group").withColumn("chunk", deal.cast("int"))
    member = stored(member.select("group", "chunk", "chunks", "node", "z"), "hot-members")
    # The pivots: members of highest degree, at most 32 a group, in every chunk.
    from pyspark.sql import Window
    first = Window.partitionBy("group").orderBy(F.desc("degree"), "node")
    pivots = (degree.join(hot, "group").withColumn("k", F.row_number().over(first))
              .filter("k <= 32").select("group", "node"))
    shared = (member.join(pivots, ["group", "node"])
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    cells = member.unionByName(shared).select("group", "chunk", "node", "z").dropDuplicates(
        ["group", "chunk", "node"])
    links = stored(cells.groupBy("group", "chunk").applyInArrow(
        lambda key, table: run(table), schema), "hot-links")
    label = components(links.select(F.col("root").alias("a"), F.col("node").alias("b")))
    labelled = member.join(label, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    weight = labelled.groupBy("group", "root").agg(F.count(F.lit(1)).alias("w"))
    top = weight.groupBy("group").agg(F.max_by("root", F.struct("w", "root")).alias("top"))
    rest = labelled.join(top, "group").filter(F.col("root") != F.col("top"))
    # What is outside the largest class, in blocks, meets every chunk.
    n_rest = rest.groupBy("group").agg(F.count(F.lit(1)).alias("n_rest")).withColumn(
        "blocks", F.ceil(F.col("n_rest") * 2 / limit).cast("int"))
    rest = rest.join(n_rest, "group").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    left = rest.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = (member.join(n_rest, "group")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    cols = ["group", "chunk", "block", "node", "z"]
    cross = (left.select(*cols).unionByName(right.select(*cols)).dropDuplicates(cols[:4])
             .groupBy("group", "chunk", "block").applyInArrow(
                 lambda key, table: run(table), schema))
    return links.unionByName(cross).select(F.col("root").alias("a"), F.col("node").alias("b"))


def link_components(docs: DataFrame, width: int = WIDTH,
                    group_docs: int = GROUP_DOCS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs(doc_id, text)``."""
    docs = need(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_id", "n", "sid", "data"]
    profile = stored(docs.mapInArrow(
        _profile_rows(width, names),
        f"block int, doc_id {kind}, n bigint, sid bigint, data binary"), "profile")
    rows = profile.filter("block IS NULL").select("doc_id", "n", "sid", "data")
    classes = (rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("sid")
               .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                    F.first("data").alias("data")))
    near = candidate_groups(docs, profile, classes, width)
    group = stored(components(near).withColumnRenamed("root", "group"), "groups")
    pressed = ["node", "group", "z"]
    texts = (docs.join(group, F.col("doc_id") == F.col("node")).select("node", "group", "text")
             .mapInArrow(_press_rows(pressed), f"node {kind}, group {kind}, z binary"))
    sizes = group.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    run = _resolve_group(width, ["node", "root"])
    usual = sizes.filter(F.col("members") <= group_docs)
    n_hot = sizes.filter(F.col("members") > group_docs).count()
    found = (texts.join(usual, "group", "left_semi").groupBy("group").applyInArrow(
        lambda key, table: run(table), f"node {kind}, root {kind}") if n_hot
        else texts.groupBy("group").applyInArrow(
            lambda key, table: run(table), f"node {kind}, root {kind}"))
    found = found.distinct()
    if n_hot:
        ends = near.select(F.col("a").alias("node")).unionByName(
            near.select(F.col("b").alias("node")))
        degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).join(group, "node")
        hot = components(_hot_roots(stored(texts, "texts"), degree, sizes, width, group_docs))
        found = found.unionByName(hot)
    found = stored(found.groupBy("node").agg(F.min("root").alias("root")), "roots")
    home = classes.select("sid", "node").join(found, "node", "left").select(
        "sid", F.coalesce("root", "node").alias("root"))
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), "sid")
            .join(home, "sid", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.when(
                F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id")))
                .alias("component_id")))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = doc_id GROUP BY ALL
"""
