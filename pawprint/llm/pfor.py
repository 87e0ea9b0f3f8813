"""Token ids written as patched frame-of-reference blocks, and read back.

A file row holds a run of whole documents. Their ids are cut into blocks of
``block`` ids; a block subtracts its minimum, packs the differences at the
width that holds a given share of them (``percentile``) and lists the
places and full differences of the rest as exceptions. ``block_at`` holds the
byte at which every block begins, so a reader can open any of them alone.

Block layout, little-endian: n uint32, minimum uint32, width uint8,
exceptions uint32, packed bits (low bits of every difference, padded to whole
bytes), exception places uint32 each, exception differences uint32 each.

Rows are in ascending document id order over shards and chunks; equal ids are
ordered by text, a null id comes first, a null or empty text has only the
end id. An empty table gives an empty file. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pawprint.llm.common import need, offsets_of, slices, stored
from pawprint.llm.tokens import default_vocabulary, encoder

HEAD = "<IIBI"
HEAD_BYTES = struct.calcsize(HEAD)


def pack_block(ids: np.ndarray, percentile: float = 95.0) -> bytes:
    """One block of ids (uint32, at least one)."""
    low = int(ids.min())
    diff = (ids - np.uint32(low)).astype(np.uint32)
    width = int(np.partition(diff, k := int((len(diff) - 1) * percentile / 100))[k]).bit_length()
    over = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = (diff[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    return b"".join((struct.pack(HEAD, len(ids), low, width, len(over)), packed.tobytes(),
                     over.astype("<u4").tobytes(), diff[over].astype("<u4").tobytes()))


def unpack_block(raw: bytes, at: int = 0) -> np.ndarray:
    n, low, width, n_over = struct.unpack_from(HEAD, raw, at)
    at += HEAD_BYTES
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), bitorder="little",
                         count=n * width).reshape(n, width)
    diff = np.zeros(n, np.uint32)
    for k in range(width):
        diff |= bits[:, k].astype(np.uint32) << np.uint32(k)
    at += size
    places = np.frombuffer(raw, "<u4", n_over, at)
    diff[places] = np.frombuffer(raw, "<u4", n_over, at + 4 * n_over)
    return diff + np.uint32(low)


def _write_rows(vocabulary: str, end_id: int, block: int, percentile: float, names: list[str]):
    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        chunk = 0
        for part in slices(batches):
            offs, data = offsets_of(part.column("text"))
            ids, rows = encoder(vocabulary).encode_rows(offs, data)
            # The end id goes behind each document's own.
            ids = np.insert(ids, rows[1:], np.uint32(end_id))
            blocks = [pack_block(ids[a:a + block], percentile) for a in range(0, len(ids), block)]
            sizes = np.cumsum([0] + [len(b) for b in blocks])
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()),
                pa.array([part.column("doc_id").to_pylist()],
                         pa.list_(part.schema.field("doc_id").type)),
                pa.array([np.diff(rows) + 1], pa.list_(pa.int64())),
                pa.array([sizes[:-1]], pa.list_(pa.int64())),
                pa.array([b"".join(blocks)], pa.binary())], names=names)
            chunk += 1
        encoder(vocabulary).rest()
    return run


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2,
              block: int = 4096, percentile: float = 95.0) -> None:
    """Write the ids of ``docs(doc_id, text)`` to ``path``, ascending by doc_id."""
    docs = need(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["shard", "chunk", "doc_ids", "lengths", "block_at", "payload"]
    schema = (f"shard int, chunk int, doc_ids array<{kind}>, lengths array<bigint>, "
              "block_at array<bigint>, payload binary")
    (docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_write_rows(vocabulary or default_vocabulary(), end_id, block, percentile,
                             names), schema)
     .write.parquet(path))


def _read_rows(names: list[str]):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.concatenate([unpack_block(row["payload"], at) for at in row["block_at"]])
                raw = ids.astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * n, pa.int32()),
                    pa.array([row["chunk"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                    pa.array(starts, pa.int64()), pa.array(row["lengths"], pa.int64()),
                    pa.array(crc, pa.int64())], names=names)
    return run


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files.

    ``start`` counts the ids of all documents before it: sums over chunks
    within a shard, and over the one row per shard.
    """
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["shard", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"]
    rows = (files.select("shard", "chunk", "doc_ids", "lengths", "block_at", "payload")
            .mapInArrow(_read_rows(names), f"shard int, chunk int, doc_id {kind}, at bigint, "
                        "n_tokens bigint, ids_crc32 bigint"))
    sizes = files.select("shard", "chunk", F.expr(
        "aggregate(lengths, 0L, (a, x) -> a + x)").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (sizes.groupBy("shard").agg(F.sum("n").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = (Window.partitionBy("shard").orderBy("chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = (sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
             .join(shards, "shard").select("shard", "chunk", (F.col("base") + F.col("inside"))
                                           .alias("base")))
    return rows.join(bases, ["shard", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
