"""Best-fit decreasing packing of documents into sequences, with certified bounds.

Every partition packs its own pieces by best-fit decreasing. Lower bounds
from dual-feasible functions tell how many sequences its pieces need at
least; a partition whose sequence count equals the bound is certified. The
bound over all pieces tells whether that is enough: where the partitions'
bounds add up to it, certified partitions are finished and only those with a
gap exchange pieces, else all do. The sequences with free room of those that
exchange (first the loose ones, then all, then also full ones of
small pieces) are unpacked, and larger groups run
best-fit decreasing again, until the bound is reached or the gap falls no more.
The sequences and bounds that are returned are those of the final packing.

Null and empty texts are one piece that holds the end id; repeated rows are
packed once each; ties are broken by place in the sorted order; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import need, offsets_of, slices, stored
from pawprint.llm.tokens import default_vocabulary, encoder

#: Bytes of text encoded at once.
STEP = 1 << 19
#: Pieces that one exchange group packs (about 50 bytes each).
GROUP_PIECES = 50_000
#: A sequence whose free share is larger gives up its pieces first.
LOOSE = 0.02
#: Rounds without a gain after which an exchange ends.
ROUNDS = 3
#: Fixed value: the packings that a sequence's id can name.
TURNS = 31


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, by dual-feasible functions.

    Two families: rounding ``u_k`` (x stays if (k+1)x is whole, else
    floor((k+1)x)/k) and thresholds (x > 1-e counts 1, x < e counts 0).
    """
    return bound_of_counts(np.bincount(sizes, minlength=capacity + 1), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of ``counts[x]`` pieces of every size x."""
    counts = counts.astype(np.int64)
    sizes = np.arange(capacity + 1)
    mass = np.cumsum(counts * sizes)
    number = np.cumsum(counts)
    best = -(-int(mass[-1]) // capacity)
    for k in range(1, 21):
        scaled = sizes * (k + 1)
        # k * capacity * f(x) in whole numbers.
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for e in np.flatnonzero(counts[:capacity // 2 + 1]).tolist():
        if e:
            large = int(number[-1] - number[capacity - e])
            middle = int(mass[capacity - e] - mass[e - 1])
            best = max(best, large - (-middle // capacity))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int):
    """Bin and offset of every piece, and the free room of every bin."""
    order = np.argsort(-sizes, kind="stable")
    where = np.zeros(len(sizes), np.int64)
    offset = np.zeros(len(sizes), np.int64)
    free: list[int] = []
    rooms: list[int] = []            # distinct free rooms, ascending
    bins: dict[int, list[int]] = {}  # bins by free room
    for i in order.tolist():
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = bins[room].pop()
            if not bins[room]:
                del rooms[at], bins[room]
        else:
            b, room = len(free), capacity
            free.append(capacity)
        where[i], offset[i] = b, capacity - room
        room -= size
        free[b] = room
        if room:
            if room in bins:
                bins[room].append(b)
            else:
                bins[room] = [b]
                insort(rooms, room)
    return where, offset, np.array(free, np.int64)


def _cut_rows(vocabulary: str, capacity: int, end_id: int, names: list[str]):
    def run(batches):
        for part in slices(batches, step=STEP):
            offs, data = offsets_of(part.column("text"))
            ids, rows = encoder(vocabulary).encode_rows(offs, data)
            ids = np.insert(ids, rows[1:], np.uint32(end_id)).astype("<u4")
            raw, lens = ids.tobytes(), np.diff(rows) + 1
            doc_at = np.cumsum(lens) - lens
            n_pieces = -(-lens // capacity)
            row = np.repeat(np.arange(len(lens)), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(lens[row] - start, capacity)
            lo = 4 * (doc_at[row] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(lo.tolist(), (lo + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=names)
        encoder(vocabulary).rest()
    return run


def cut_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 4096,
               end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end
    id, cut only where longer than ``capacity``."""
    docs = need(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return docs.mapInArrow(
        _cut_rows(vocabulary or default_vocabulary(), capacity, end_id, names),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def _pack_rows(capacity: int, turn: int, names: list[str]):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        sizes = table.column("length").to_numpy()
        where, offset, free = best_fit_decreasing(sizes, capacity)
        bound = lower_bound(sizes, capacity)
        n = len(sizes)
        keep = table.combine_chunks().select(names[:5])
        for col, value in (("sequence_id", where + (part << 28) + (turn << 58)),
                           ("offset", offset), ("free", free[where]),
                           ("part_sequences", np.full(n, len(free))),
                           ("part_bound", np.full(n, bound))):
            keep = keep.append_column(col, pa.array(value, pa.int64()))
        yield from keep.to_batches(max_chunksize=100_000)
    return run


def _part():
    """Names the partition and turn that packed a sequence."""
    return F.shiftright("sequence_id", 28)


def _standing(packed: DataFrame, room: int):
    """Sequences and bounds of all partitions, and pieces and sequences with more than
    ``room`` free: of all, and of the partitions with a gap."""
    first, free = (F.col("offset") == 0).cast("long"), (F.col("free") > room).cast("long")
    gap = F.col("s") > F.col("b")
    return (packed.groupBy(_part().alias("part"))
            .agg(F.max("part_sequences").alias("s"), F.max("part_bound").alias("b"),
                 F.sum(first).alias("n"), F.sum(free).alias("pieces"),
                 F.sum(free * first).alias("open"))
            .agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
                F.col("n"), F.col("b"), F.col("pieces"), F.col("open"),
                F.when(gap, F.col("pieces")), F.when(gap, F.col("open")))]).first())


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _sequences(frames: list[DataFrame]) -> int:
    return _union(frames).filter("offset = 0").count() if frames else 0


def _with_full(packed: DataFrame, gap: int) -> DataFrame:
    """``packed`` where the ``gap`` full sequences of the smallest pieces (and their equals)
    count as open, as far as their pieces fit into the largest free room."""
    each = packed.groupBy("sequence_id").agg(F.max("length").alias("m"), F.max("free").alias("f"))
    most = each.agg(F.max("f")).first()[0] or 0
    full = each.filter((F.col("f") == 0) & (F.col("m") <= most))
    limit, n = -1, 0
    for m, count in sorted(full.groupBy("m").count().collect()):
        if n < gap:
            limit, n = m, n + count
    chosen = full.filter(F.col("m") <= limit).select("sequence_id")
    return stored(packed.join(chosen, "sequence_id", "left_anti").unionByName(
        packed.join(chosen, "sequence_id", "left_semi").withColumn("free", F.lit(1).cast("long"))),
        "open")


def global_bound(pieces: DataFrame, capacity: int) -> int:
    """The bound over all pieces, from the number of pieces of every length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
    return bound_of_counts(counts, capacity)


def _certify_rows(capacity: int, names: list[str]):
    def run(key, table):
        counts = np.zeros(capacity + 1, np.int64)
        counts[table.column("length").to_numpy()] = table.column("n").to_numpy()
        return pa.table([pa.array([v], pa.int64()) for v in (
            key[0].as_py(), int(table.column("firsts").to_numpy().sum()),
            bound_of_counts(counts, capacity))], names=names)
    return run


def certified(packed: DataFrame, capacity: int) -> DataFrame:
    """part, part_sequences, part_bound of the sequences that each partition's packing has
    in ``packed`` (length, sequence_id, offset)."""
    return (packed.groupBy(_part().alias("part"), "length")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum((F.col("offset") == 0).cast("long")).alias("firsts"))
            .groupBy("part").applyInArrow(
                _certify_rows(capacity, ["part", "part_sequences", "part_bound"]),
                "part bigint, part_sequences bigint, part_bound bigint"))


def pack(pieces: DataFrame, capacity: int = 4096, rounds: int = ROUNDS,
         group: int = GROUP_PIECES, loose: float = LOOSE) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and
    offset, and per partition that packed them the number of its sequences and their bound."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = need(pieces, *names)
    schema = pieces.schema.simpleString()[7:-1] + (
        ", sequence_id bigint, offset bigint, free bigint, part_sequences bigint, "
        "part_bound bigint")
    goal = global_bound(pieces, capacity)

    def packing(pool, turn):
        return stored(pool.mapInArrow(_pack_rows(capacity, turn, names), schema), f"pack{turn}")

    # done: finished; aside: not loose, but with room for a later round.
    done, aside, n_done, turn, failed = [], [], 0, 1, 0
    last_gap = float("inf")
    room = int(capacity * loose)
    packed = packing(pieces, 0)
    while True:
        n, bounds, n_pieces, n_open, gap_pieces, gap_open = _standing(packed, room)
        if n_done + n <= goal or turn > TURNS:
            break
        gives = F.lit(True)
        if n_done + bounds <= goal and not aside:
            gives, n_pieces, n_open = F.expr("part_sequences > part_bound"), gap_pieces, gap_open
        if n_open < 2 or failed >= rounds:
            gap = n_done + n - goal
            if room:  # next, every sequence with any room
                packed = _union([packed, *aside])
            elif gap < last_gap:  # next, also full sequences of pieces that fit into rooms
                packed, last_gap = _with_full(_union([packed, *aside, *done]), gap), gap
                done = []
            else:
                break
            aside, n_done, room, failed = [], _sequences(done), 0, 0
            continue
        pool = packed.filter(gives & (F.col("free") > room))
        # Larger groups than partitions are; the pieces meet in groups of ``group``,
        # others every round, never in one task.
        groups = max(1, -(-n_pieces // group))
        again = packing(pool.select(*names).repartition(
            groups, F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn))), turn)
        turn += 1
        n_again = again.filter("offset = 0").count()
        failed = 0 if n_again < n_open else rounds if groups == 1 else failed + 1
        if n_again > n_open:
            continue
        stay = packed.filter(gives & (F.col("free") <= room))
        aside.append(stay.filter("free > 0"))
        done += [stay.filter("free = 0"), packed.filter(~gives)]
        n_done += n - n_open
        packed = again
    out = stored(_union([*done, *aside, packed]).drop("free", "part_sequences", "part_bound")
                 .withColumn("part", _part()), "packed")
    return out.join(stored(certified(out, capacity), "certified"), "part").drop("part")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = 4096,
                   end_id: int = 1) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` ids as the rounds reach."""
    return pack(stored(cut_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
