"""Vector codes against a plain k-means over whole numbers."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries
from tripweave.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    """rows of (vec_id, vector, label), all of one size; codes, errors and codebooks."""
    whole = [(i, [int(np.floor(scale * float(x))) for x in v], y) for i, v, y in rows]
    width = len(whole[0][1]) // parts
    pieces = [[v[p * width : (p + 1) * width] for _, v, _ in whole] for p in range(parts)]
    first = sorted(range(len(whole)), key=lambda r: (whole[r][0] is None, whole[r][0] or 0, whole[r][1]))
    books = [[pieces[p][r] for r in first[:entries]] for p in range(parts)]

    def assign():
        out = []
        for p in range(parts):
            x, b = np.array(pieces[p]), np.array(books[p])
            d = np.stack([((x - e) ** 2).sum(axis=1) for e in b], axis=1)
            out.append((d.argmin(axis=1), d.min(axis=1)))
        return out

    for _ in range(rounds):
        for p, (near, _) in enumerate(assign()):
            for e in range(len(books[p])):
                own = [pieces[p][r] for r in np.flatnonzero(near == e)]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    final = assign()
    codes = ["".join(f"{final[p][0][r]:02x}" for p in range(parts)) for r in range(len(whole))]
    errors = [int(sum(final[p][1][r] for p in range(parts))) for r in range(len(whole))]
    flat = ",".join(str(c) for b in books for e in b for c in e)
    return codes, errors, hashlib.sha256(flat.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()]
    codes, errors, sha = brute(rows)
    labels = {}
    for (_, _, y), e in zip(rows, errors):
        labels[y] = labels.get(y, 0) + e
    want = sorted((i, c, e, labels[y], sha) for (i, _, y), c, e in zip(rows, codes, errors))
    got = queries()["op13_value_dictionaries"](spark, sf_dir)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(set(codes)) > 100 and sum(errors) > 0


def test_ties_repeated_rows_and_few_entries(spark):
    rng = random.Random(3)
    rows = [(i // 2 if i % 7 else None, [rng.randrange(-3, 4) / 1024 for _ in range(8)], None if i % 3 else i % 2)
            for i in range(300)]
    coded, books = codebooks.compressed(spark.createDataFrame(rows, SCHEMA), entries=5, rounds=3)
    codes, errors, sha = brute(rows, entries=5, rounds=3)
    assert codebooks.digest(books) == sha
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = [(r.vec_id, r.code, r.error) for r in coded.collect()]
    assert sorted(got, key=key) == sorted(((i, c, e) for (i, _, _), c, e in zip(rows, codes, errors)), key=key)
    sums = {r.label: r.label_error for r in codebooks.label_errors(coded).collect()}
    assert None in sums
    assert sums[None] == sum(e for (_, _, y), e in zip(rows, errors) if y is None)


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], 0) for i in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA)
    one, books = codebooks.compressed(frame.repartition(1), entries=16)
    many, other = codebooks.compressed(frame.repartition(7), entries=16)
    assert (books == other).all()
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [1.0, None, 0.0, 0.0], 0), (3, [nan, 0.0, 0.0, 0.0], 0), (4, [inf, 0.0, 0.0, 0.0], 0),
        (5, [], 1), (6, [0.5, -0.5, 0.25, 0.0], 1), (7, [1.0] * 8, 1), (8, [0.5], None), (6, [0.5, -0.5, 0.25, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA + ", code string, row int")
    coded, books = codebooks.compressed(frame)
    got = sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=str)
    assert got == sorted([(5, None, None), (6, "00000000", 0), (6, "00000000", 0), (7, None, None), (8, None, None)], key=str)
    assert books.shape == (4, 2, 1)


def test_negative_components_go_down(spark):
    rows = [(1, [-0.0001, 0.0, 0.0, 0.0], 0)]
    _, books = codebooks.compressed(spark.createDataFrame(rows, SCHEMA))
    assert books[0, 0, 0] == -1


def test_empty_table(spark):
    coded, books = codebooks.compressed(spark.createDataFrame([], SCHEMA))
    assert books is None
    assert codebooks.label_errors(coded).columns == ["vec_id", "label", "code", "error", "label_error"]
    assert coded.count() == 0


def test_components_beyond_exact_range_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e9] * 4, 0)], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        codebooks.compressed(frame)
