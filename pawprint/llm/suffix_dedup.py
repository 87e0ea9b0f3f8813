"""Removal of repeated 100-byte strings by a distributed merge sort of suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
earlier: in a document with a smaller id, or earlier in the same one.

Sorting every suffix of the corpus would need many times its size. Of each
100-byte window only the suffix at its anchor is sorted: the anchor is the
place of the least hash among the window's 32-byte strings (the leftmost of
equal ones), so equal windows have their anchors at equal offsets, and one
anchor serves all the windows that chose it, a segment of bytes around it.

1. Anchors whose 32 bytes occur once in the corpus are dropped: hashes are
   dealt over buckets and counted there. Cut hashes can only keep too many.
2. Documents with anchors left build sorted runs of segments. Segments equal
   to an earlier one of the run are removed at once and go no further.
3. Runs are cut at sampled splitters and exchanged front-coded (the length of
   the prefix shared with the suffix before, and the rest).
4. Every range merges its runs with a loser tree that keeps, for each loser,
   the length of the prefix it shares with the last winner: unequal lengths
   decide without looking at bytes, equal ones compare only what follows.
5. Neighbours that share the anchor's 32 bytes form a group; a window found
   in an earlier member is removed. Anchors that occur very often (a passage
   in a third of all documents) send 128-bit digests of their windows, each run
   a window once, to groups by the digest's value instead, packed, so no anchor's
   group is gathered in a task.

Null and empty texts have no bytes. Repeated rows (same id and text) are one
document and get the same result each; different texts under one id are
ordered by a hash of the text; rows with a null id come first. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import (byte_table, mix, need, offsets_of, partitions, powers, slices,
                                 stored)

LENGTH = 100
GRAM = 32
#: Occurrences (over all runs) from which an anchor takes the digest path.
HOT = 2_000
#: Documents whose anchors choose the splitters of the ranges; only the
#: balance of the ranges depends on them.
SPLITTER_DOCS = 2000


def anchors(offs: np.ndarray, data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of all windows: (hash, row, place, first window, last window), places in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none, none
    up, down = powers(len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_table(False)[data] * up)])
    grams = mix((total[gram:] - total[:-gram]) * down[:len(data) - gram + 1])
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, want = 1, length - gram + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if want > span:
        rest = want - span
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offs)
    # Windows inside one document only.
    ok = np.zeros(len(data) + 1, np.int8)
    long = sizes >= length
    np.add.at(ok, offs[:-1][long], 1)
    np.add.at(ok, offs[1:][long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(ok[:len(place)]) > 0)
    if not len(start):
        return none.astype(np.uint64), none, none, none, none
    place = place[start]
    cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    p = place[cut]
    first, last = start[cut], start[np.r_[cut[1:], len(start)] - 1]
    row = np.searchsorted(offs, p, side="right") - 1
    return grams[p], row, p, first, last


# ---- 1. anchors that occur more than once ------------------------------------

def _anchor_rows(n_buckets: int, names: list[str]):
    """Anchors of a slice of documents, dealt over buckets (four bytes of the hash,
    the document's number in the slice, the place), and the slice's documents in
    a row of a negative bucket."""
    def run(batches):
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        for part in slices(batches):
            offs, data = offsets_of(part.column("text"))
            h, row, p, _, _ = anchors(offs, data)
            p = p - offs[row]
            bucket = (h % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            h, row, p, bucket = h[order], row[order], p[order], bucket[order]
            h = (h // np.uint64(n_buckets)).astype("<u4")
            number = "<u2" if part.num_rows <= 65536 else "<u4"
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            used = np.flatnonzero(np.diff(cuts))
            ids = part.column("doc_id")
            n = len(used) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(used, -1 - name % n_buckets), pa.int32()),
                pa.array([name] * n, pa.int64()),
                pa.array([None] * (n - 1) + [ids.to_pylist()], pa.list_(ids.type)),
                pa.array([None] * (n - 1) + [part.column("mark").to_pylist()],
                         pa.list_(pa.int64())),
                *[pa.array([x[cuts[k]:cuts[k + 1]].astype(kind).tobytes() for k in used] + [None],
                           pa.binary()) for x, kind in ((h, "<u4"), (row, number), (p, "<u4"))]],
                names=names)
            name += 1
    return run


def _numbers(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _repeated(hot: int, names: list[str]):
    """Per slice the anchors that occur more than once; documents pass through."""
    def run(key, table):
        if key[0].as_py() < 0:
            nothing = pa.nulls(table.num_rows, pa.binary())
            return pa.table([table.column("slice"), table.column("ids"), table.column("marks"),
                             nothing, nothing, nothing], names=names)
        rows = table.select(["slice", "hashes", "numbers", "places"]).to_pylist()
        h = [np.frombuffer(r["hashes"], "<u4") for r in rows]
        ends = np.cumsum([len(x) for x in h])
        _, inverse, count = np.unique(np.concatenate(h), return_inverse=True, return_counts=True)
        count = count[inverse]
        out = []
        for r, end, own in zip(rows, ends.tolist(), h):
            c = count[end - len(own):end]
            keep = c > 1
            if keep.any():
                out.append((r["slice"], _numbers(r["numbers"], len(own))[keep].astype("<u4")
                            .tobytes(), np.frombuffer(r["places"], "<u4")[keep].tobytes(),
                            (c[keep] > hot).tobytes()))
        cols = list(zip(*out)) or [[], [], [], []]
        n = len(out)
        return pa.table([pa.array(cols[0], pa.int64()), pa.nulls(n, table.schema.field("ids").type),
                         pa.nulls(n, pa.list_(pa.int64())),
                         *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)
    return run


def _by_document(names: list[str]):
    """Of one slice, the repeated anchors of each document, the hot ones apart."""
    def run(key, table):
        kind = table.schema.field("ids").type.value_type
        ids, marks, number, place, hot = [], [], [], [], []
        for r in table.to_pylist():
            if r["ids"] is not None:
                ids, marks = r["ids"], r["marks"]
            else:
                place.append(np.frombuffer(r["places"], "<u4"))
                number.append(_numbers(r["numbers"], len(place[-1])))
                hot.append(np.frombuffer(r["hot"], bool))
        if not place:
            return pa.table([pa.array([], kind), pa.array([], pa.int64()),
                             pa.array([], pa.binary()), pa.array([], pa.binary())], names=names)
        number, place, hot = map(np.concatenate, (number, place, hot))
        order = np.argsort(number, kind="stable")
        number, place, hot = number[order], place[order], hot[order]
        docs, at = np.unique(number, return_index=True)
        ends = np.r_[at[1:], len(number)]
        some = [place[a:b][~hot[a:b]].tobytes() for a, b in zip(at, ends)]
        many = [place[a:b][hot[a:b]].tobytes() for a, b in zip(at, ends)]
        return pa.table([pa.array([ids[d] for d in docs], kind),
                         pa.array([marks[d] for d in docs], pa.int64()),
                         pa.array(some, pa.binary()), pa.array(many, pa.binary())], names=names)
    return run


def _press_rows(names: list[str]):
    def run(batches):
        import zstandard
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"),
                pa.array([press(t.encode()) for t in batch.column("text").to_pylist()],
                         pa.binary())], names=names)
    return run


def _opened(batches, step: int):
    """Batches of about ``step`` bytes of text, from compressed text in column z."""
    import zstandard
    open_ = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        others = [c for c in batch.schema.names if c != "z"]
        texts, size, first = [], 0, 0
        raw = batch.column("z").to_pylist()
        for i, z in enumerate(raw):
            texts.append(open_(z))
            size += len(texts[-1])
            if size >= step or i + 1 == len(raw):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, len(texts)) for c in others]
                    + [pa.array(texts, pa.binary()).cast(pa.string())], names=others + ["text"])
                texts, size, first = [], 0, i + 1


# ---- 2. and 3. runs ----------------------------------------------------------

def shared_prefix(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    x = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
    return m - ((x.bit_length() + 7) >> 3)


def front_code(keys: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Shared prefix lengths, key lengths (a byte each) and the rests of sorted keys."""
    shared, rests, last = bytearray(), [], b""
    for k in keys:
        n = shared_prefix(last, k)
        shared.append(n)
        rests.append(k[n:])
        last = k
    return bytes(shared), bytes(map(len, keys)), b"".join(rests)


def front_decode(shared: bytes, lens: bytes, rests: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for n, size in zip(shared, lens):
        last = last[:n] + rests[at:at + size - n]
        at += size - n
        out.append(last)
    return out


def _segments(part: pa.RecordBatch):
    """Segments of the wanted anchors: (key, left bytes, order, row, place, hot)."""
    offs, data = offsets_of(part.column("text"))
    raw = data.tobytes()
    _, row, p, first, last = anchors(offs, data)
    base = offs[row]
    some, many = part.column("some").to_pylist(), part.column("many").to_pylist()
    wanted = []
    for r in range(part.num_rows):
        for raws, hot in ((some[r], 0), (many[r], 1)):
            places = np.frombuffer(raws, "<u4").astype(np.int64)
            wanted.append((places + offs[r]) * 2 + hot)
    wanted = np.sort(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
    at = np.searchsorted(wanted // 2, p)
    have = (at < len(wanted)) & (wanted[np.minimum(at, len(wanted) - 1)] // 2 == p) \
        if len(wanted) else np.zeros(len(p), bool)
    ids, marks = part.column("doc_id").to_pylist(), part.column("mark").to_pylist()
    out = []
    for i in np.flatnonzero(have).tolist():
        r, q, a, b = int(row[i]), int(p[i]), int(first[i]), int(last[i])
        out.append((raw[q:b + LENGTH], raw[a:q],
                    ((ids[r] is not None, ids[r] if ids[r] is not None else 0), marks[r],
                     q - int(base[i])), r, int(wanted[at[i]]) & 1))
    return out


def _run_rows(splitters: list[bytes], names: list[str]):
    """Front-coded blocks per range; under negative ranges, which only spread them,
    spans that the run removed and digests of hot windows."""
    def run(batches):
        import zstandard
        from pyspark import TaskContext
        press = zstandard.ZstdCompressor(level=1).compress
        beside = -1 - TaskContext.get().partitionId() % (len(splitters) + 1)
        for part in _opened(batches, 2 << 20):
            kind = part.schema.field("doc_id").type
            found = _segments(part)
            found.sort()
            ids, marks = part.column("doc_id").to_pylist(), part.column("mark").to_pylist()
            spans: dict[int, list[int]] = {}
            blocks: dict[int, list] = {}
            digests, last = {}, None
            for key, left, order, r, hot in found:
                start = order[2] - len(left)
                if last == (key, left):
                    spans.setdefault(r, []).extend((start, order[2] + len(key)))
                    continue
                last = (key, left)
                if hot:
                    text = left + key
                    for j in range(len(text) - LENGTH + 1):
                        name = hashlib.blake2b(text[j:j + LENGTH], digest_size=16).digest()
                        here = (order[0], order[1], start + j, r)
                        if name in digests:  # only the earliest of a run goes on
                            here, late = sorted((here, digests[name]))
                            spans.setdefault(late[3], []).extend((late[2], late[2] + LENGTH))
                        digests[name] = here
                else:
                    blocks.setdefault(bisect_right(splitters, key), []).append(
                        (key, left, r, order[2]))
            out = []
            for k, block in sorted(blocks.items()):
                shared, lens, rests = front_code([x[0] for x in block])
                rows, number = np.unique([x[2] for x in block], return_inverse=True)
                out.append((k, [ids[r] for r in rows], [marks[r] for r in rows], shared, lens,
                            press(rests), bytes(len(x[1]) for x in block),
                            press(b"".join([x[1] for x in block])),
                            number.astype("<u4").tobytes(),
                            np.array([x[3] for x in block], "<u4").tobytes()))
            if spans:
                out.append((beside, [ids[r] for r in spans], [marks[r] for r in spans], b"",
                            np.array([len(v) for v in spans.values()], "<u4").tobytes(),
                            np.concatenate([*spans.values()]).astype("<u4").tobytes(),
                            b"", b"", b"", b""))
            # Digests go to groups of their own, by their value.
            groups: dict[int, list] = {}
            for name, here in digests.items():
                groups.setdefault(-1 - int.from_bytes(name[:4], "little") % (len(splitters) + 1),
                                  []).append((name, here))
            for k, group in sorted(groups.items()):
                rows, number = np.unique([h[3] for _, h in group], return_inverse=True)
                out.append((k, [ids[r] for r in rows], [marks[r] for r in rows], b"", b"",
                            b"".join([n for n, _ in group]), b"", b"",
                            number.astype("<u4").tobytes(),
                            np.array([h[2] for _, h in group], "<u4").tobytes()))
            for lo in range(0, len(out), 64):
                cols = list(zip(*out[lo:lo + 64]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.list_(kind)),
                     pa.array(cols[2], pa.list_(pa.int64())),
                     *[pa.array(c, pa.binary()) for c in cols[3:]]], names=names)
    return run


# ---- 4. the merge ------------------------------------------------------------

def merge_runs(runs: list[tuple[list[bytes], bytes]]):
    """(run, position, prefix shared with the one before) of all keys in order.

    ``runs``: sorted keys and, per key, the prefix it shares with the key
    before it in the run. A node of the tree keeps the loser of its game;
    ``known[r]`` is the prefix that run r's current key shares with the last
    winner. Of two current keys the one that shares more is the smaller; only
    on equal lengths are bytes compared, from there on.
    """
    n = len(runs)
    if not n:
        return
    keys = [r[0] for r in runs]
    at = [0] * n
    current = [k[0] for k in keys]
    known = [0] * n  # -1: the run has ended
    size = 1
    while size < n:
        size *= 2
    current += [b""] * (size - n)
    known += [-1] * (size - n)
    loser = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        a, b = known[x], known[y]
        if a != b:
            return (x, y) if a > b else (y, x)
        if a < 0:
            return x, y
        p, q = current[x], current[y]
        same = a + shared_prefix(p[a:], q[a:])
        if same == len(p) or (same < len(q) and p[same] < q[same]):
            known[y] = same
            return x, y
        known[x] = same
        return y, x

    winners = list(range(size))
    node = size
    while node > 1:
        node //= 2
        level = []
        for k in range(node):
            w, lose = play(winners[2 * k], winners[2 * k + 1])
            loser[node + k] = lose
            level.append(w)
        winners = level
    best = winners[0]
    while known[best] >= 0:
        yield best, at[best], known[best]
        at[best] += 1
        if at[best] < len(keys[best]):
            current[best] = keys[best][at[best]]
            known[best] = runs[best][1][at[best]]
        else:
            known[best] = -1
        node = (size + best) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def repeated_windows(members: list[tuple]) -> list[tuple[int, int, int]]:
    """Spans (member's reference, start, end) of windows found in an earlier member.

    ``members``: (order, key, left bytes, reference, start of the segment).
    """
    seen_segments: set = set()
    seen: set = set()
    out = []
    for _, key, left, ref, start in sorted(members, key=lambda m: m[0]):
        if (key, left) in seen_segments:
            out.append((ref, start, start + len(left) + len(key)))
            continue
        seen_segments.add((key, left))
        text = left + key
        for j in range(len(text) - LENGTH + 1):
            window = text[j:j + LENGTH]
            if window in seen:
                if out and out[-1][0] == ref and out[-1][1] <= start + j <= out[-1][2]:
                    out[-1] = (ref, out[-1][1], start + j + LENGTH)
                else:
                    out.append((ref, start + j, start + j + LENGTH))
            else:
                seen.add(window)
    return out


def _merge_range(names: list[str]):
    def run(key, table):
        import zstandard
        open_ = zstandard.ZstdDecompressor().decompress
        kind = table.schema.field("ids").type.value_type
        if key[0].as_py() < 0:
            return _beside(table, kind, names)
        runs, info, refs = [], [], []
        for r in table.to_pylist():
            runs.append((front_decode(r["shared"], r["lens"], open_(r["rests"])), r["shared"]))
            lefts, ends = open_(r["lefts"]), np.cumsum(np.frombuffer(r["left_lens"], np.uint8))
            lefts = [lefts[b - n:b] for b, n in zip(ends.tolist(), r["left_lens"])]
            base = len(refs)
            refs += list(zip(r["ids"], r["marks"]))
            info.append((lefts, (np.frombuffer(r["numbers"], "<u4") + base).tolist(),
                         np.frombuffer(r["places"], "<u4").tolist()))
        spans: dict[int, list[int]] = {}
        group: list[tuple] = []

        def close():
            if len(group) > 1:
                for ref, a, b in repeated_windows(group):
                    spans.setdefault(ref, []).extend((a, b))

        for which, at, same in merge_runs(runs):
            if same < GRAM:
                close()
                group = []
            lefts, numbers, places = info[which]
            ref, place, left = numbers[at], places[at], lefts[at]
            doc, mark = refs[ref]
            group.append((((doc is not None, doc if doc is not None else 0), mark, place),
                          runs[which][0][at], left, ref, place - len(left)))
        close()
        return pa.table([pa.array([refs[r][0] for r in spans], kind),
                         pa.array([refs[r][1] for r in spans], pa.int64()),
                         pa.array([v for v in spans.values()], pa.list_(pa.int64()))],
                        names=names)
    return run


def _late_windows(runs: list[dict]) -> dict[tuple, list[int]]:
    """Spans, by document, of windows whose digest an earlier window of these rows has."""
    refs = [x for r in runs for x in zip(r["ids"], r["marks"])]
    order = sorted(range(len(refs)), key=lambda i: (
        refs[i][0] is not None, refs[i][0] if refs[i][0] is not None else 0, refs[i][1]))
    rank = np.empty(len(refs), np.int64)
    rank[order] = np.arange(len(refs))
    base = np.cumsum([0] + [len(r["ids"]) for r in runs])
    digest = np.frombuffer(b"".join([r["rests"] for r in runs]), "<u8").reshape(-1, 2)
    start = np.concatenate([np.frombuffer(r["places"], "<u4") for r in runs]).astype(np.int64)
    doc = rank[np.concatenate([np.frombuffer(r["numbers"], "<u4").astype(np.int64) + n
                               for r, n in zip(runs, base)])]
    by = np.lexsort((start, doc, digest[:, 1], digest[:, 0]))
    late = np.zeros(len(by), bool)
    late[1:] = (digest[by[1:]] == digest[by[:-1]]).all(axis=1)
    doc, start = doc[by[late]], start[by[late]]
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    # Windows that touch are one span.
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + LENGTH)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(doc)) - 1
    out: dict[tuple, list[int]] = {}
    for i, a, b in zip(doc[at].tolist(), start[at].tolist(), start[last].tolist()) if len(at) else ():
        out.setdefault(refs[order[i]], []).extend((a, b + LENGTH))
    return out


def _beside(table, kind, names: list[str]):
    """Rows of a negative range: spans that runs removed, and those of late windows."""
    ids, marks, spans, runs = [], [], [], []
    for r in table.to_pylist():
        if not r["lens"]:
            runs.append(r)
            continue
        ids += r["ids"]
        marks += r["marks"]
        spans += [x.tolist() for x in np.split(
            np.frombuffer(r["rests"], "<u4").astype(np.int64),
            np.cumsum(np.frombuffer(r["lens"], "<u4"))[:-1])]
    for (doc, mark), found in (_late_windows(runs) if runs else {}).items():
        ids.append(doc)
        marks.append(mark)
        spans.append(found)
    return pa.table([pa.array(ids, kind), pa.array(marks, pa.int64()),
                     pa.array(spans, pa.list_(pa.int64()))], names=names)


def _splitters(wanted: DataFrame, n_ranges: int) -> list[bytes]:
    """Keys that cut the sorted segments of a bounded number of documents evenly.

    They are as long as an anchor's string, so no group lies on both sides of one."""
    one_in = max(1, wanted.count() // SPLITTER_DOCS)
    few = (wanted.filter(F.pmod(F.xxhash64("mark"), F.lit(one_in)) == 0)
           .select("doc_id", "mark", "z", "some", "many").limit(4 * SPLITTER_DOCS))

    def run(batches):
        for part in _opened(batches, 2 << 20):
            keys = sorted({s[0][:GRAM] for s in _segments(part)})
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(
                    keys[::max(1, len(keys) // (64 * part.num_rows))], pa.binary())],
                    names=["key"])

    keys = sorted(r[0] for r in few.mapInArrow(run, "key binary").collect())
    return sorted({bytes(keys[len(keys) * i // n_ranges]) for i in range(1, n_ranges)}
                  ) if keys else []


def _removed_rows(names: list[str]):
    def run(batches):
        for part in _opened(batches, 2 << 20):
            spans = part.column("spans").to_pylist()
            texts = part.column("text").to_pylist()
            cut, runs, shas, ends = [], [], [], []
            for text, groups in zip(texts, spans):
                raw = text.encode()
                marks = np.zeros(len(raw) + 1, np.int32)
                flat = np.array([x for g in groups for x in g], np.int64)
                np.add.at(marks, flat[::2], 1)
                np.add.at(marks, flat[1::2], -1)
                gone = np.cumsum(marks[:-1]) > 0
                edge = np.diff(np.r_[False, gone, False].astype(np.int8))
                cut.append(int(gone.sum()))
                runs.append(np.flatnonzero(edge == 1))
                ends.append(np.flatnonzero(edge == -1))
                shas.append(hashlib.sha256(
                    np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("mark"), pa.array(cut, pa.int64()),
                pa.array(runs, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
                pa.array(shas, pa.string())], names=names)
    return run


def find_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, mark (hash of the text), n_removed, starts and ends of the removed
    byte runs and the SHA-256 of the bytes left, for documents that lose any."""
    docs = need(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    n_parts = partitions(spark)
    names = ["bucket", "slice", "ids", "marks", "hashes", "numbers", "places"]
    docs_of = f"ids array<{kind}>, marks array<bigint>"
    entries = docs.filter(F.octet_length("text") >= LENGTH).mapInArrow(
        _anchor_rows(2 * n_parts, names),
        f"bucket int, slice bigint, {docs_of}, hashes binary, numbers binary, places binary")
    names = ["slice", "ids", "marks", "numbers", "places", "hot"]
    key = ["doc_id", "mark"]
    lists = (entries.groupBy("bucket").applyInArrow(
        _repeated(hot, names), f"slice bigint, {docs_of}, numbers binary, places binary, "
        "hot binary")
        .groupBy("slice").applyInArrow(
            _by_document(["id", "m", "some", "many"]),
            f"id {kind}, m bigint, some binary, many binary").dropDuplicates(["id", "m"]))
    pressed = docs.mapInArrow(_press_rows([*key, "z"]), f"doc_id {kind}, mark bigint, z binary")
    wanted = pressed.join(lists, pressed["doc_id"].eqNullSafe(lists["id"]) &
                          (pressed["mark"] == lists["m"])).drop("id", "m")
    wanted = stored(wanted.dropDuplicates(key), "repeated-docs")
    cols = ["range", "ids", "marks", "shared", "lens", "rests", "left_lens", "lefts", "numbers",
            "places"]
    runs = wanted.mapInArrow(
        _run_rows(_splitters(wanted, 2 * n_parts), cols),
        f"range int, {docs_of}, " + ", ".join(f"{c} binary" for c in cols[3:]))
    found = stored(runs.groupBy("range").applyInArrow(
        _merge_range([*key, "spans"]), f"doc_id {kind}, mark bigint, spans array<bigint>"), "found")
    spans = (found.groupBy(*key).agg(F.collect_list("spans").alias("spans"))
             .withColumnsRenamed({"doc_id": "id", "mark": "m"}))
    out = ["doc_id", "mark", "n_removed", "starts", "ends", "kept_sha256"]
    return (wanted.join(spans, wanted["doc_id"].eqNullSafe(spans["id"]) &
                        (wanted["mark"] == spans["m"]))
            .select("doc_id", "mark", "z", "spans")
            .mapInArrow(_removed_rows(out), f"doc_id {kind}, mark bigint, n_removed bigint, "
                        "starts array<bigint>, ends array<bigint>, kept_sha256 string"))


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    found = stored(find_repeats(docs, hot).select(
        F.col("doc_id").alias("id"), F.col("mark").alias("m"), "n_removed",
        F.size("starts").cast("long").alias("n_spans"), "kept_sha256"), "removed")
    text = F.coalesce("text", F.lit(""))
    all_docs = need(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64(text).alias("mark"), F.octet_length(text).cast("long").alias(
            "n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    return (all_docs.join(found, F.col("doc_id").eqNullSafe(F.col("id")) &
                          (F.col("mark") == F.col("m")), "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long"))
                    .alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long"))
                    .alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256")))
