"""op13: archives round trip, whatever the payload; revisits by brute force."""

import gzip
import hashlib
import re
from base64 import b32encode

import pytest

from conftest import SF001
from pawprint.llm import warc
from pawprint.session import scratch_path
from tests.llm.conftest import LONG, with_extra

NASTY = ["", "\r\n", "\r\n\r\n", "x\r\n", "x\r\n\r\n", "\r\n\r\nx", "\r\r\n\r\n\n", "a\r\n\r\n\r\n",
         "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
         "é" * 7 + "\r\n\r\n" + "日本" * 9, "\x00\x1f", "plain", "\n\n", "x\r\n\r", "\r\n\r\n\r"]
PAGES = ([(i, f"http://a.b/{i}?q=é ä%20", t) for i, t in enumerate(NASTY)] +
         [(100 + i, None, t) for i, t in enumerate(NASTY)] +
         [(50, "u", None), (51, "u", LONG), (52, "u", LONG), (52, "u", LONG), (40, "u", "dup"),
          (40, "u", "dup"), (None, "u", "dup"), (None, "u", "none"), (None, "u", "none"),
          (7, "again\r\nX: y", "other text")])


def expected(pages, least=0):
    raw = [(p, (t or "").encode()) for p, _, t in pages]
    out = []
    for p, t in raw:
        ids = [q for q, u in raw if u == t and q is not None]
        again = ids and len(t) >= least and p != min(ids)
        out.append((p, len(t), b32encode(hashlib.sha1(t).digest()).decode(),
                    "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk, least", [(1 << 20, 0), (3, 0), (1, 5), (64, 10 ** 9)])
def test_round_trip(spark, chunk, least):
    pages = PAGES if chunk > 100 else [p for p in PAGES if p[2] != LONG]
    df = with_extra(spark.createDataFrame(pages, "page_id long, url string, html string")
                    .repartition(3))
    path = scratch_path(spark, "warc-test")
    warc.write(df, path, min_revisit=least, chunk=chunk)
    assert result(warc.read(spark, path)) == expected(pages, least)


def test_chunks_give_the_payload_back(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    path = scratch_path(spark, "warc-test")
    warc.write(df, path, min_revisit=10 ** 9, chunk=1000)
    rows = warc.read_chunks(spark, path).collect()
    payloads = {}
    for r in sorted(rows, key=lambda r: r.chunk):
        payloads[r.page_id] = payloads.get(r.page_id, b"") + bytes(r.payload)
        assert len(r.payload) <= 1000
    for page, _, text in PAGES:
        if page not in (None, 7, 40, 52):
            assert payloads[str(page)] == (text or "").encode()
    assert max(r.chunk for r in rows) == -(-len(LONG) // 1000) - 1


def test_heavy_copies(spark, monkeypatch):
    import pawprint.llm.common as common
    rows = [(i, "u", "hot" if i % 3 == 0 else f"page {i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 3, 10 ** 9):
        monkeypatch.setattr(common, "HEAVY_PARTS", parts)
        path = scratch_path(spark, "warc-test")
        warc.write(df, path)
        assert result(warc.read(spark, path)) == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write(df, path)
    assert warc.read(spark, path).collect() == []


def test_files_are_records_of_the_format(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/pages.parquet").coalesce(1)
    path = str(tmp_path / "archives")
    warc.write(df, path, chunk=2000)
    raw = b"".join(gzip.open(f).read() for f in (tmp_path / "archives").glob("*.gz"))
    at = n = 0
    while at < len(raw):
        head, _, _ = raw[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        at += len(head) + 4 + size
        assert raw[at:at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n > df.count()


@pytest.mark.parametrize("change", [lambda r: r[:-9], lambda r: r.replace(b"<p>", b"<q>", 1),
                                    lambda r: r[r.index(b"WARC-Type: continuation") - 10:]])
def test_damage_is_found(spark, tmp_path, change):
    df = spark.createDataFrame([(1, "u", "<p>" + "text " * 100)],
                               "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "archives")
    warc.write(df, path, chunk=200)
    raw = b"".join(gzip.open(f).read() for f in (tmp_path / "archives").glob("*.gz"))
    bad = tmp_path / "bad"
    bad.mkdir()
    with gzip.open(bad / "part.txt.gz", "wb") as f:
        f.write(change(raw))
    with pytest.raises(Exception, match="damaged archive|substring not found"):
        warc.read(spark, str(bad)).collect()


def test_a_chunk_is_all_that_is_held(spark):
    reader = warc.Reader("f", False)
    data, row = (b"0123456789" * 30_000), {"page_id": 1, "url": "u", "refers_to": None,
                                           "record_type": "response",
                                           "sha1": hashlib.sha1(b"0123456789" * 30_000).digest()}
    import numpy as np
    most, last = 0, None
    for record in warc._records(row, np.frombuffer(data, np.uint8), 0, len(data), 1000):
        for last in reader.feed(record + b"\r\n\r\n"):
            most = max(most, len(reader.buffer))
    assert last["last"] and last["chunk"] == 299 and most <= 2000
