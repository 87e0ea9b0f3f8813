"""Helpers shared by the operators: column checks, Arrow text access, hashing of words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pawprint.session import scratch_path

#: Bytes of text that one vectorised step handles; a longer text is one step.
STEP_BYTES = 2 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns never clash with an operator's own."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns {missing} are missing; there are {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a short lineage
    that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is heavy if it holds more than this part of all rows: there are fewer than so
#: many heavy keys, which bounds what is broadcast.
HEAVY_PARTS = 1000


def join_back(rows: DataFrame, table: DataFrame, key: list[str], count: str,
              how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row a key; ``count``: how many of ``rows`` have it).

    Heavy keys, fewer than ``HEAVY_PARTS``, are joined by broadcast, so no task of the
    other join gets more than a small part of all rows for one key. ``how`` is
    "inner" or "left"."""
    total = table.agg(F.sum(count)).first()[0] or 0
    heavy = table.filter(F.col(count) * HEAVY_PARTS > total)
    if heavy.isEmpty():
        return rows.join(table, key, how)
    few = F.broadcast(heavy)
    light = table.filter(F.col(count) * HEAVY_PARTS <= total)
    return rows.join(few, key).unionByName(
        rows.join(few, key, "left_anti").join(light, key, how))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Hand freed memory back to the system: a worker process stays when its task ends, and
    else keeps what its largest step took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def cut(batch: pa.RecordBatch, column: str = "text",
        step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut into pieces of about ``step`` bytes of text (never inside a row)."""
    if not batch.num_rows:
        return
    sizes = np.diff(offsets_of(batch.column(column))[0])
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + step, side="right")))
        yield batch.slice(at, end - at)
        at = end


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches of a task, each ``cut``.

    Memory that the steps of a batch have freed is given back after it. Task code is pickled
    by value, so what a worker's earlier tasks left in their modules is garbage in cycles."""
    gc.collect()
    for batch in batches:
        yield from cut(batch, column, step)
        del batch
        give_back()
    _POWERS.clear()
    give_back()


def offsets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (n + 1) and UTF-8 bytes of a string column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offs - offs[0], data[offs[0]:offs[-1]]


def texts_of(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


# ---- hashing ---------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def byte_table(lower: bool) -> np.ndarray:
    """A fixed pseudo-random 64-bit value per byte; with ``lower`` A-Z equal a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        table[65:91] = table[97:123]
    return table


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers (mod 2^64) of the hash base and of its inverse."""
    if len(_POWERS.get("base", ())) < max(n, 1):
        size = 1 << max(n - 1, 1).bit_length()
        for name, base in (("base", _BASE), ("inv", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["base"][:n], _POWERS["inv"][:n]


#: Byte classes: words of the survey of spaces, and words of letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True
ALNUM[128:] = True


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """Start and end (exclusive) of every maximal run of word bytes; runs end at row ends."""
    mask = is_word[data]
    before = np.empty(len(mask), bool)
    if len(mask):
        before[0] = False
        before[1:] = mask[:-1]
        inner = offs[:-1][offs[:-1] < len(mask)]
        before[inner] = False
        after = np.empty(len(mask), bool)
        after[-1] = False
        after[:-1] = mask[1:]
        ends_at = offs[1:] - 1
        after[ends_at[(ends_at >= 0)]] = False
        return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def word_hashes(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray, lower: bool = True):
    """(hash, row, start, end) of every word, in order.

    The hash is a 64-bit polynomial over pseudo-random byte values, so it
    depends on the word's bytes only, not on its place.
    """
    starts, ends = word_spans(data, offs, is_word)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), starts, ends
    table = byte_table(lower)
    table[~is_word] = 0
    up, down = powers(len(data))
    sums = np.add.reduceat(table[data] * up, starts)
    row = np.searchsorted(offs, starts, side="right") - 1
    return mix(sums * down[starts]), row, starts, ends


def shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, width: int):
    """(hash, row) of each run of ``width`` words within a row, and words per row.

    A row of fewer words (but not none) has one shingle: the whole sequence.
    """
    count = np.bincount(row, minlength=n_rows)
    first = np.cumsum(count) - count
    n = len(hashes)
    acc = np.zeros(n, np.uint64)
    mult = np.uint64(0xD6E8FEB86659FD93)
    for k in range(width):
        part = np.zeros(n, np.uint64)
        part[:n - k] = hashes[k:]
        acc = mix(acc * mult + part + np.uint64(k + 1))
    full = (np.arange(n) - first[row] + width) <= count[row] if n else np.zeros(0, bool)
    out_h, out_r = [acc[full]], [row[full]]
    for r in np.flatnonzero((count > 0) & (count < width)):
        h = np.uint64(count[r])
        for w in hashes[first[r]:first[r] + count[r]]:
            h = mix(np.array([h], np.uint64) * mult + w)[0]
        out_h.append(np.array([h], np.uint64))
        out_r.append(np.array([r]))
    return np.concatenate(out_h), np.concatenate(out_r).astype(np.int64), count
