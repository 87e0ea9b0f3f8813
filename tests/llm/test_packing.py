"""Which partitions exchange pieces, and the certificate of the final packing."""

import random

import numpy as np
import pytest

from pawprint.llm import packing
from tests.llm.test_tokens import check_packing

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def parts_of(spark, *parts):
    """One partition per list of lengths."""
    rows = [[(1000 * k + i, 0, 0, n, 1000 * k + i) for i, n in enumerate(p)]
            for k, p in enumerate(parts)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows))
                                 .flatMap(lambda r: r), SCHEMA)


def certificates(rows):
    """Sequences, and each partition's sequences, bound and lengths."""
    out = {}
    for r in rows:
        c = out.setdefault(r.sequence_id >> 28, [set(), set(), []])
        c[0].add(r.sequence_id)
        c[1].add((r.part_sequences, r.part_bound))
        c[2].append(r.length)
    return out


def test_short_pieces_fill_nearly_full_sequences(spark):
    long, short = [4016] * 200, [8] * 2000
    rows = packing.pack(parts_of(spark, long, short)).collect()
    assert len(rows) == 2200
    assert check_packing(rows, 4096) == 200 == packing.lower_bound(np.array(long + short), 4096)


def test_certified_partitions_are_finished_at_once(spark):
    # 3 x 60 needs three sequences of 100 by its bound; so does every partition together.
    rows = packing.pack(parts_of(spark, [60] * 3, [60] * 3, [60] * 3), capacity=100).collect()
    assert check_packing(rows, 100) == 9
    assert all(r.sequence_id >> 58 == 0 for r in rows)


@pytest.mark.parametrize("group", [200, 50_000])
def test_certificate_is_of_the_final_packing(spark, group):
    rng = random.Random(3)
    rows = packing.pack(parts_of(spark, *[[rng.randint(1, 100) for _ in range(150)]
                                          for _ in range(8)]), capacity=100, group=group).collect()
    assert len(rows) == 1200
    check_packing(rows, 100)
    for ids, figures, lengths in certificates(rows).values():
        assert figures == {(len(ids), packing.lower_bound(np.array(lengths), 100))}
