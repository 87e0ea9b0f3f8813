"""Decontamination, Jaccard join and suffix removal against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from pawprint.llm import decontam, jaccard_join, suffix_dedup

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words10(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_hits(docs, items):
    out = []
    windows = []
    for item, text in items:
        w = words10(text)
        n = min(10, len(w))
        windows += [(item, tuple(w[i:i + n])) for i in range(len(w) - n + 1 if n else 0)]
    for doc, text in docs:
        w = words10(text)
        hit, found = set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add("" if item is None else str(item))
        out.append((doc, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "quick brown FOX jumps over the lazy dog, and runs! far away"), (2, "word1 of1"),
         (3, None), (4, "..."), (2, "word1 of1"), (None, "from here today"), (11, "été 日本語"),
         (12, "one")]


def test_decontamination(spark, edge_docs, edge_rows, no_docs, monkeypatch):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute_hits(edge_rows, ITEMS)
    got = sorted(map(tuple, decontam.decontaminate(edge_docs, bench).collect()), key=str)
    assert got == want
    monkeypatch.setattr(decontam, "PASS_WORDS", 5)  # several passes over the index
    got = sorted(map(tuple, decontam.decontaminate(edge_docs, bench).collect()), key=str)
    assert got == want
    assert decontam.decontaminate(no_docs, bench).count() == 0
    none = bench.limit(0)
    assert not any(r.n_hit for r in decontam.decontaminate(edge_docs, none).collect())


def test_proximity(spark):
    words = [f"w{i}" for i in range(10)]
    near = " ".join(["a b c"] + words[5:] + ["x"] + words[:5])
    far = " ".join(words[5:] + ["x"] * 60 + words[:5])
    docs = spark.createDataFrame([(1, near), (2, far)], "doc_id long, text string")
    from pawprint.session import scratch_path
    path = scratch_path(spark, "ix")
    decontam.build_index(docs, path)
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (r.items, r.near) for r in decontam.search(spark, path, bench).collect()}
    assert got == {1: ([], ["7"]), 2: ([], [])}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(docs):
    sets = [(d, shingle_set(t)) for d, t in docs if d is not None]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {(d, len(s), find(d)) for d, s in sets}


def near_copies(rng, n_groups, copies, size, edits):
    rows, doc = [], 0
    for g in range(n_groups):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 10 ** 6)}"
            rows.append((doc, " ".join(w)))
            doc += 1
    rng.shuffle(rows)
    return rows


def test_components_edge_cases(edge_docs, edge_rows, no_docs):
    got = jaccard_join.link_components(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert {(r[0], r[1], r[2]) for r in got if r[0] is not None} == brute_components(edge_rows)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.link_components(no_docs).count() == 0


@pytest.mark.parametrize("small,middle,limit", [(16, 2000, 20_000), (2, 6, 20_000), (2, 4, 12)])
def test_components_of_near_copies(spark, monkeypatch, small, middle, limit):
    """All paths: pairs, sketches of whole regions, stars, and groups dealt over chunks."""
    monkeypatch.setattr(jaccard_join, "SMALL_REGION", small)
    monkeypatch.setattr(jaccard_join, "MIDDLE_REGION", middle)
    rng = random.Random(small + limit)
    rows = near_copies(rng, 6, 25, 60, 5) + [(1000 + i, t) for i, (_, t) in enumerate(
        near_copies(rng, 30, 2, 12, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.link_components(docs, group_docs=limit).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


def test_resolve_equals_all_pairs():
    rng = random.Random(9)
    for trial in range(6):
        rows = near_copies(rng, 4, 60, 40, 4 + trial)
        names = {}
        sets = [np.unique([names.setdefault(s, len(names)) for s in shingle_set(t)]).astype(
            np.uint64) for _, t in rows]
        numbered = [(i, t) for i, (_, t) in enumerate(rows)]
        assert list(enumerate(jaccard_join.resolve(sets))) == sorted(
            (d, c) for d, _, c in brute_components(numbered))


def brute_removed(rows, length):
    seen, out = set(), []
    for doc, text in sorted({(d, t or "") for d, t in rows},
                            key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(b[i:i + length])
        edge = np.diff(np.r_[False, gone, False].astype(int))
        out.append((doc, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(
            bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return set(out)


@pytest.mark.parametrize("hot", [2_000, 1])
def test_removal(spark, edge_docs, edge_rows, no_docs, hot):
    got = suffix_dedup.remove_repeats(edge_docs, hot).collect()
    assert len(got) == len(edge_rows)
    assert {tuple(r) for r in got} == brute_removed(edge_rows, 100)
    assert suffix_dedup.remove_repeats(no_docs, hot).count() == 0


@pytest.mark.parametrize("hot", [2_000, 2])
def test_removal_of_passages(spark, hot):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (60, 99, 100, 101, 180, 400)]
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append("".join(rng.choice("xyzw\n") for _ in range(rng.randint(0, 80))))
            p = rng.choice(passages)
            cut = rng.randint(0, 30) if rng.random() < 0.4 else 0
            parts.append(p[cut:])
        rows.append((d, "".join(parts) + "a" * rng.choice([0, 0, 250])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = suffix_dedup.remove_repeats(docs, hot).collect()
    assert {tuple(r) for r in got} == brute_removed(rows, 100)


def test_merge_runs_is_a_sort():
    rng = random.Random(2)
    for _ in range(50):
        runs, every = [], []
        for _ in range(rng.randint(1, 9)):
            keys = sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode()
                          for _ in range(rng.randint(1, 30)))
            shared, lens, rests = suffix_dedup.front_code(keys)
            assert suffix_dedup.front_decode(shared, lens, rests) == keys
            runs.append((keys, shared))
            every += keys
        last, got = b"", []
        for r, i, same in suffix_dedup.merge_runs(runs):
            key = runs[r][0][i]
            assert same == suffix_dedup.shared_prefix(last, key)
            got.append(key)
            last = key
        assert got == sorted(every)
