"""BPE by tree concatenation and wavelet-matrix shards, against the library itself."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tests_llm_paths import TOKENIZER
from tripweave.llm import bpe, wavelet
from tripweave.sources.writers import shared_folder

LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def digest(ids, text):
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(text.encode()).hexdigest(),
    )


def check_digests(rows, texts):
    for r in rows:
        ids = ids_of(texts[r.doc_id])
        whole = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digest(ids, whole)


def test_bpe_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries()["op9_bpe_tree"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    check_digests(rows, texts)


def test_short_leaves_give_the_same(spark, odd_docs, no_docs):
    def finish(ids, offsets):
        cut = zip(offsets.tolist(), offsets.tolist()[1:])
        return [pa.array([ids[a:b].tolist() for a, b in cut], pa.list_(pa.int64()))]

    rows = bpe.encoded(odd_docs, TOKENIZER, finish, "ids array<long>", leaf_chars=500).collect()
    texts = [(r.doc_id, ids_of(r.text)) for r in odd_docs.collect()]
    key = lambda x: (x[0] is None, x[0], x[1])
    assert sorted(((r.doc_id, r.ids) for r in rows), key=key) == sorted(texts, key=key)
    assert bpe.encoded(no_docs, TOKENIZER, finish, "ids array<long>").count() == 0


ODD = ["", "a", "\n\t x", "It's we'll 're 's foo's! don't...", "É́ K̄ ſ", "x̸≮y", "日本語テキスト",
       "<|endoftext|> hi", "ok<|startoftext|>no", "12345 6a7b", "a b c", "foo…. bar", "İstanbul", None,
       "ab\x0bcd\x0cef", "!̸a≠b", "ΑΣ ΣΑΣ", "a\r\nb", "'S 'LL we'LL"]


def test_words_of_odd_texts():
    encoder = bpe.WordEncoder(TOKENIZER)
    for texts in (ODD, [t for t in ODD if "<|" not in (t or "")]):
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[ends[i] : ends[i + 1]].tolist() == ids_of(t), t
        for t, out in zip(texts, bpe.decoded(TOKENIZER, ids, ends)):
            assert out.decode() == LIBRARY.decode(ids_of(t), skip_special_tokens=False)


def random_text(rng, n):
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(rng.choice("abcdefgh") for _ in range(n))
    if kind == 1:
        some = ["the", "ing", "Tion", "é", "ß", "日", "'s", "'ll", "12", " ", "\n", ".", "!!"]
        return "".join(rng.choice(some) for _ in range(n))
    if kind == 2:
        return "a" * n
    marks = [0x61, 0x301, 0x20, 0x65, 0x4E00, 0x1100, 0x1161, 0x27, 0x73]
    return "".join(chr(rng.choice(marks)) for _ in range(n))


@pytest.mark.parametrize("leaf", [5, 64, 200])
def test_joins_of_random_texts(leaf):
    rng = random.Random(leaf)
    for _ in range(150):
        text = random_text(rng, rng.randrange(1, 700))
        pieces = [bpe.whole(LIBRARY, t) for t in bpe.leaves(text, leaf)]
        assert bpe.concatenate(LIBRARY, pieces).ids == ids_of(text), text


def test_word_table_starts_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    encoder, rng = bpe.WordEncoder(TOKENIZER), random.Random(3)
    for _ in range(8):
        texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(30)) for _ in range(5)]
        ids, ends = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [ids_of(t) for t in texts]


def test_wavelet_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = sorted(queries()["op6_wavelet_shards"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_shards(rows, texts)


def check_shards(rows, texts):
    at = 0
    assert len(rows) == len(texts)
    order = sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or ""))
    for r, (doc_id, text) in zip(rows, order):
        ids = np.array([*ids_of(text), 2], "<u4")
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        folder = shared_folder(spark)
        wavelet.write_shards(docs, folder, TOKENIZER, shard_tokens=200)
        rows = sorted(wavelet.read_shards(spark, folder).collect(), key=lambda r: r.start)
        check_shards(rows, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("n, top", [(0, 1), (1, 5), (9, 1), (5000, 49408), (700_000, 300), (3000, 70_000)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % top).astype(np.uint32)
    matrix = wavelet.WaveletMatrix(wavelet.pack(ids, [3], np.array([n])))
    assert matrix.doc_ids == [3] and (matrix.ids() == ids).all()
    for _ in range(60 if n else 0):
        i, end = int(rng.integers(n)), int(rng.integers(n + 1))
        token = int(ids[rng.integers(n)])
        places = np.flatnonzero(ids == token)
        k = int(rng.integers(len(places)))
        assert matrix.access(i) == ids[i]
        assert matrix.rank(token, end) == (places < end).sum()
        assert matrix.select(token, k) == places[k]
    assert matrix.rank(1 << 30, n) == 0
    with pytest.raises(IndexError):
        matrix.access(n)
    with pytest.raises(IndexError):
        matrix.select(0, n)
