"""LPT sharding and the WARC normaliser."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
import zlib
from collections import defaultdict

import pytest

from __spark_entry__ import queries
from tripweave.llm import sharding, warc
from tripweave.sources.writers import shared_folder


def check_shards(rows, texts, shards=16):
    assert len(rows) == len(texts)
    slots, of_text = defaultdict(list), defaultdict(set)
    by_id = defaultdict(list)
    for doc_id, text in texts:
        by_id[doc_id].append(text or "")
    for r in rows:
        own = by_id[r.doc_id]
        assert (r["size"], r.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in own}
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append(r.slot)
        if len(set(own)) == 1:
            of_text[own[0]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_query_places_every_row(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries()["op7_lpt_sharding"](spark, sf_dir).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_shards(rows, texts)
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.001 * sum(load.values())


def test_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_by_bytes(odd_docs, shards=3).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], 3)
    assert sharding.shard_by_bytes(no_docs).count() == 0


def test_bundles_keep_groups_together(monkeypatch, docs_of):
    monkeypatch.setattr(sharding, "ITEMS", 64)
    rng = random.Random(1)
    texts = [(i, "t%d" % rng.randrange(900) * rng.randrange(1, 9)) for i in range(3000)]
    rows = sharding.shard_by_bytes(docs_of(*texts), shards=4).collect()
    check_shards(rows, texts, 4)
    load = defaultdict(int)
    for r in rows:
        load[r.shard] += r["size"]
    assert max(load.values()) < 1.1 * min(load.values())


def test_longest_first_to_the_least_loaded():
    sizes = [(0, 7), (1, 7), (2, 6), (3, 5), (4, 4), (5, 4), (6, 3)]
    load = defaultdict(int)
    for item, shard in sharding.least_loaded(sizes, 3):
        load[shard] += dict(sizes)[item]
    assert sorted(load.values()) == [11, 12, 13] or max(load.values()) - min(load.values()) <= 3
    assert sharding.least_loaded([], 3) == []


# archives


def expected(pages, min_bytes=0):
    top = {}
    for page_id, html in pages:
        if len((html or "").encode()) >= min_bytes:
            top[html or ""] = max(page_id if page_id is not None else -1, top.get(html or "", -1))
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        response = top.get(html or "", page_id)
        first = response in (page_id, -1)
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), sha, "response" if first else "revisit", None if first else response))
    return sorted(out, key=str)


def test_query_reads_back_what_was_written(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    rows = queries()["op8_warc_normaliser"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows), key=str) == expected(pages)


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_odd_pages(spark, min_bytes):
    rows = [(1, "http://a/é b\r\nX: 1", None, 1), (2, None, "", 2), (3, "u", "same", 3), (4, "u", "same", 4),
            (5, "u", "WARC/1.1\r\n\r\n" * 9, 5), (6, "u", "é" * 70_000, 6), (7, "u", "same", 7),
            (None, "u", "alone", 8), (8, "u", "ab", 9), (9, "u", "ab", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, records int")
    folder = shared_folder(spark)
    files = warc.write_monolithic(pages, folder, min_bytes, file_bytes=60_000)
    got = warc.read_files(spark, warc.normalise_files(files, folder), folder).collect()
    want = expected([(r[0], r[2]) for r in rows], min_bytes)
    assert sorted(map(tuple, got), key=str) == want


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_folder(spark)
    files = warc.write_monolithic(pages, folder)
    assert warc.read_files(spark, warc.normalise_files(files, folder), folder).count() == 0


def test_every_record_becomes_a_member():
    rng = random.Random(6)
    records = [warc.record(i, f"http://x/{i}", bytes(rng.randrange(256) for _ in range(n)), None, True)
               for i, n in enumerate([0, 1, 5000, 300_000, 2])]
    for source in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        out = io.BytesIO()
        index = warc.normalise(io.BytesIO(source), out)
        assert len(index) == len(records)
        for (at, size, name, kind), whole in zip(index, records):
            assert gzip.decompress(out.getvalue()[at : at + size]) == whole
            assert kind == "response" and name.startswith("<urn:page:")
        assert gzip.decompress(out.getvalue()) == b"".join(records)


def test_cut_off_streams_are_an_error():
    whole = gzip.compress(warc.record(1, "u", b"x" * 1000, None, True)[:-300])
    with pytest.raises(EOFError):
        warc.normalise(io.BytesIO(whole), io.BytesIO())
    assert warc.normalise(io.BytesIO(b""), io.BytesIO()) == []
