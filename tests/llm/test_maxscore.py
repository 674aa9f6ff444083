"""Exact top-k search against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripweave.llm import maxscore

SCHEMA = "vec_id long, embedding array<double>, score int"


def brute(rows, step, k, scale=256):
    vectors = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(scale * x)) for x in v]
        vectors[i] = min(vectors.get(i, whole), whole)
    want = []
    for q, a in vectors.items():
        if q % step == 0:
            others = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors.items()
                      if i != q and len(a) == len(b)]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(want)


def got(spark, rows, step, k, **sizes):
    df = maxscore.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % step == 0, k, **sizes)
    return sorted(tuple(r) for r in df.collect())


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25, 0.125], i) for i in range(30)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0, None, 2.0], 1), (103, [nan, 1.0, 1.0], 1),
             (104, [1.0, inf, 1.0], 1), (105, [1.0, 2.0], 1), (110, [9.0, 9.0], 1), (None, [1.0, 1.0, 1.0], 1),
             (7, [0.5, -0.25, 0.125], 7), (8, [3.0, 1.0, -1.0], 8), (200, [-1e4, 5.5, 0.1], 0)]
    for step in (5, 10):
        assert got(spark, rows, step, 5) == brute(rows, step, 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vectors_over_many_pieces(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 1, 16).round(1).tolist(), 0) for i in rng.permutation(400)]
    assert got(spark, rows, 10, 7, shard=60, block=9) == brute(rows, 10, 7)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0], 0), (50, [2.0], 0), (51, [-1.0], 0)]
    assert got(spark, rows, 50, 5) == brute(rows, 50, 5)
    assert got(spark, [(0, [1.0], 0)], 50, 5) == []
    assert got(spark, [], 50, 5) == []


def test_pruning_skips_work_and_loses_nothing():
    rng = np.random.default_rng(4)
    matrix = rng.integers(-200, 200, (3000, 32))
    ids = rng.permutation(3000)
    queries = rng.integers(-200, 200, (20, 32))
    found = list(maxscore.best_of_shard(queries, list(range(5000, 5020)), matrix, ids, 4))
    for n, q in enumerate(queries):
        scores = matrix @ q
        order = np.lexsort((ids, -scores))[:4]
        want = [(5000 + n, int(ids[i]), int(scores[i])) for i in order]
        assert [x for x in found if x[0] == 5000 + n] == want


def test_thresholds_and_norms_spare_products():
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()
    matrix = np.floor(256 * np.array([r["embedding"] for r in table], np.float64)).astype(np.int64)
    ids = np.array([r["vec_id"] for r in table])
    asked = np.flatnonzero(ids % 50 == 0)
    scores = matrix[asked] @ matrix.T
    scores[ids[asked][:, None] == ids[None, :]] = -(10**9)
    limits = np.sort(scores[:, : maxscore.SEED], axis=1)[:, -5].astype(float)
    work: list[int] = []
    found = list(maxscore.best_of_shard(matrix[asked], ids[asked].tolist(), matrix, ids, 5, limits, work))
    want = [
        (int(ids[q]), int(ids[i]), int(own[i]))
        for q, own in zip(asked, scores)
        for i in np.lexsort((ids, -own))[:5]
    ]
    assert found == want
    assert sum(work) < 0.55 * matrix.size * len(asked)


def test_limits_from_elsewhere_lose_no_tie():
    rng = np.random.default_rng(6)
    matrix, queries = rng.integers(-3, 4, (500, 8)), rng.integers(-3, 4, (30, 8))
    ids = rng.permutation(500)
    scores = queries @ matrix.T
    limits = np.sort(scores, axis=1)[:, -6].astype(float)
    found = list(maxscore.best_of_shard(queries, [None] * 30, matrix, ids, 6, limits))
    want = [(None, int(ids[i]), int(own[i])) for own in scores for i in np.lexsort((ids, -own))[:6]]
    assert found == want


def test_every_shard_is_sent_once(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0, 1, 4).tolist(), 0) for i in range(300)]
    df = maxscore.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 3 == 0, 2, shard=50, block=20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(shard") == 3 and "NestedLoop" not in plan  # two dealt, one to pack


def test_components_beyond_exact_range_are_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        got(spark, [(0, [1e9, 1.0], 0), (1, [1.0, 1.0], 0)], 1, 1)
