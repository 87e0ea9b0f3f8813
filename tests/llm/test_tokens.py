"""Token files and packing: against the tokenizer, round trips and bounds."""

import itertools
import random
import zlib

import numpy as np
import pytest

from pawprint.llm import packing, pfor
from pawprint.llm.tokens import WordEncoder, default_vocabulary
from pawprint.session import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_vocabulary())


def test_encoder_equals_tokenizer(tokenizer):
    rng = random.Random(3)
    letters = ([chr(c) for c in range(32, 600)] + list("̀́’“中\U0001f642")
               + list("Σςİ\t\n\x0b\x0c\r\x1c\x1d\x85\xa0 ​\x00\x7f")
               + ["'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "  "])
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["", " ", "plain words, here. Don't we'll", "ΑΣ ΣΑΣ"]
    enc = WordEncoder(default_vocabulary())
    got = [g for t in range(0, len(texts), 50) for g in enc.encode(texts[t:t + 50])]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    assert got == want


def test_encoder_forgets_and_still_agrees(tokenizer):
    enc = WordEncoder(default_vocabulary(), cap=5)
    texts = ["alpha beta gamma delta epsilon zeta", "eta theta alpha", "beta beta iota kappa"]
    for t in texts * 2:
        assert enc.encode([t])[0] == np.array(
            tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("ids", [[0], [7] * 100, [0, 2 ** 32 - 1], list(range(5000)),
                                 [5] * 4000 + [2 ** 31] * 3, [49407, 3, 3, 2 ** 20]])
@pytest.mark.parametrize("percentile", [0, 50, 95, 100])
def test_block_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    raw = b"xx" + pfor.pack_block(ids, percentile)
    assert (pfor.unpack_block(raw, 2) == ids).all()


def brute_ids(tokenizer, text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files(spark, edge_docs, edge_rows, no_docs, tokenizer):
    path = scratch_path(spark, "t")
    pfor.write_ids(edge_docs, path, block=64)
    got = sorted(pfor.read_documents(spark, path).collect(), key=lambda r: r.start)
    ordered = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None,
                                               r[1] or ""))
    at = 0
    assert len(got) == len(ordered)
    for row, (doc, text) in zip(got, ordered):
        ids = brute_ids(tokenizer, text, 2)
        assert (row.doc_id, row.start, row.n_tokens) == (doc, at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    path = scratch_path(spark, "t")
    pfor.write_ids(no_docs, path)
    assert pfor.read_documents(spark, path).count() == 0


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, edge_docs, edge_rows, no_docs, tokenizer):
    rows = packing.pack_documents(edge_docs).collect()
    n = check_packing(rows, 4096)
    total = sum(len(brute_ids(tokenizer, t, 1)) for _, t in edge_rows)
    assert sum(r.length for r in rows) == total
    assert n == -(-total // 4096)
    want = []
    for doc, text in edge_rows:
        ids = np.array(brute_ids(tokenizer, text, 1), "<u4")
        want += [(doc, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes()))
                 for k in range(0, len(ids), 4096)]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows),
                  key=key) == sorted(want, key=key)
    assert packing.pack_documents(no_docs).count() == 0


def test_exchange_closes_gaps(spark):
    rng = random.Random(1)
    rows = [(i, 0, 0, rng.randint(1, 100), i) for i in range(3000)]
    pieces = spark.createDataFrame(
        rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(40)
    packed = packing.pack(pieces, capacity=100, group=500).collect()
    n = check_packing(packed, 100)
    assert len(packed) == 3000
    bound = packing.lower_bound(np.array([r[3] for r in rows]), 100)
    assert bound <= n <= bound * 1.03


def test_lower_bound_is_a_bound():
    rng = random.Random(5)

    def optimum(sizes, capacity):
        best = len(sizes)

        def place(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(sizes):
                best = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + sizes[i] <= capacity:
                    place(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1:])
            place(i + 1, bins + [sizes[i]])

        place(0, [])
        return best

    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 7))), reverse=True)
        low = packing.lower_bound(np.array(sizes), 20)
        where, offset, free = packing.best_fit_decreasing(np.array(sizes), 20)
        assert low <= optimum(sizes, 20) <= len(free)
    assert packing.lower_bound(np.array([11] * 5), 20) == 5
    assert packing.lower_bound(np.zeros(0, int), 20) == 0
