"""Alignment of two tokenizers against a plain comparison of all byte ranges."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers

from __spark_entry__ import queries
from tripweave.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute():
    a_side = tokenizers.Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = alignment.byte_of_sign()

    def tokens(text):
        """(ids, byte ranges) of both sides, or None."""
        out = []
        ids = a_side.encode(" " + text, add_special_tokens=False).ids
        out.append([(i, bytes(signs[c] for c in a_side.id_to_token(i))) for i in ids])
        raws = []
        for i in b_side.encode(text):
            piece = b_side.id_to_piece(i)
            is_byte = len(piece) == 6 and piece.startswith("<0x")
            raws.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
        out.append(raws)
        if any(b"".join(r for _, r in side) != b" " + text.encode() for side in out):
            return None
        ranged = []
        for side in out:
            at, own = 0, []
            for i, r in side:
                own.append((i, at, at + len(r)))
                at += len(r)
            ranged.append(own)
        return ranged

    def run(docs):
        parts, counts = [], {}
        for _, text in docs:
            sides = tokens(text) if text else None
            if sides is None:
                parts.append(None)
                continue
            a, b = sides
            links = []
            first = 0
            for i, s, e in a:
                while b[first][2] <= s:
                    first += 1
                j = first
                while j < len(b) and b[j][1] < e:
                    links.append((i, b[j][0]))
                    j += 1
            for pair in links:
                counts[pair] = counts.get(pair, 0) + 1
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, low = [], 0
            for high in cuts:
                inside = [[str(i) for i, s, e in side if low <= s and e <= high] for side in (a, b)]
                groups.append("|".join(",".join(ids) for ids in inside))
                low = high
            parts.append((a, b, links, groups))
        top = {}
        for (_, b_id), n in counts.items():
            top[b_id] = max(top.get(b_id, 0), n)
        rows = []
        for (doc_id, _), part in zip(docs, parts):
            if part is None:
                rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            a, b, links, groups = part
            best = sum(counts[p] == top[p[1]] for p in links)
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
            rows.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), sha))
        return rows

    return run


def key(row):
    return tuple((v is None, v) for v in row)


def test_query_equals_brute_force(spark, brute):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    docs = sorted(docs, key=lambda d: len(d[1] or ""))[:150]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = alignment.scored(alignment.summaries(frame, A, B))
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs))
    whole = queries()["op12_lockstep_alignment"](spark, sf_dir)
    assert whole.columns == got.columns and whole.count() == 200


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "<|endoftext|> is <s> plain </s> text <unk>"),
    (6, "holds ▁ itself"), (7, "日本語 and émigré ﬁne ́ \U0001f600"), (8, "a" * 3000), (9, "\n\t\r line \x00 nul"),
    (10, "<0x41> byte"), (5, "<|endoftext|> is <s> plain </s> text <unk>"), (None, "no id here"), (11, "x" * 1021 + " é" * 700),
]


def test_odd_texts_equal_brute_force(spark, brute):
    frame = spark.createDataFrame([(*d, "clash", 3) for d in ODD], "doc_id long, text string, row string, n_a int")
    for common in (0, 5, 1 << 18):
        got = alignment.scored(alignment.summaries(frame, A, B), common)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(ODD), key=key)
    zero = {r.doc_id for r in got.collect() if r.n_a == 0}
    assert {1, 2, 6} <= zero and 5 not in zero


def test_lanes_change_nothing():
    rng = random.Random(2)
    sizes = [0, 1, 7, 500, 3000]
    ends = [[], []]
    for side in ends:
        base = 0
        for size in sizes:
            inner = sorted(rng.sample(range(1, size), size // 3)) if size > 1 else []
            side += [base + e for e in [*inner, *([size] if size else [])]]
            base += size
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    a, b = (np.array(side) for side in ends)
    want = alignment.lockstep(a, b, bounds, lane=10_000)
    starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
    plain = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
    assert list(zip(want[0].tolist(), want[1].tolist())) == plain
    assert a[want[2]].tolist() == sorted(set(ends[0]) & set(ends[1])) == b[want[3]].tolist()
    for lane in (1, 2, 13, 512):
        for got, full in zip(alignment.lockstep(a, b, bounds, lane), want):
            assert got.tolist() == full.tolist()


def test_alignments_give_ids_cuts_and_links(spark):
    frame = spark.createDataFrame([(1, "tokenization of words"), (2, None)], "doc_id long, text string")
    one, none = sorted(alignment.alignments(frame, A, B).collect())
    assert len(one.a_links) == len(one.b_links) >= max(len(one.a_ids), len(one.b_ids))
    assert one.a_cuts[-1] == len(one.a_ids) - 1 and one.b_cuts[-1] == len(one.b_ids) - 1
    assert none.a_ids == none.b_links == []


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.scored(alignment.summaries(frame, A, B)).count() == 0
