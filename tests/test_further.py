"""Joins along time, sweeps, sessions, sketches, exact quantiles, runs, snapshots, axes and
JSON fields at their edges, against plain Python on small tables."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.operators import (
    asof,
    axes,
    concurrency,
    overlaps,
    quantiles,
    runs,
    semistructured,
    sessions,
    sketches,
    snapshots,
    timeline,
)

DAY = datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else DAY + timedelta(seconds=seconds)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# As-of join


def asof_tables(spark, n=400, seed=1):
    """Key 1 holds half of all rows; times repeat, and some values are null."""
    rng = random.Random(seed)

    def key():
        return rng.choice([1, 1, 1, 2, 3, None, 4])

    left = [(key(), at(rng.choice([None, *[rng.randrange(2000)] * 9])), i) for i in range(n)]
    right = [(key(), at(rng.choice([None, *[rng.randrange(2000)] * 9])), rng.randrange(5), i) for i in range(n)]
    return (
        spark.createDataFrame(left, "k int, t timestamp_ntz, i int"),
        spark.createDataFrame(right, "k int, u timestamp_ntz, v int, j int"),
        left,
        right,
    )


def asof_plain(left, right, strict=False, within=None):
    out = []
    for k, t, i in left:
        best = None
        for rk, u, v, j in right:
            if None in (k, t, rk, u) or rk != k or not (u < t if strict else u <= t):
                continue
            if within is not None and (t - u).total_seconds() > within:
                continue
            best = max(best or (u, v, j), (u, v, j))
        out.append((k, t, i, *(best or (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [None, 1, 37, 600, 10**6])
def test_asof_join_equals_plain(spark, width):
    left, right, own, other = asof_tables(spark)
    got = asof.asof_join(left, right, ["k"], "t", "u", ["u", "v", "j"], width=width)
    assert sorted(map(tuple, got.collect()), key=str) == asof_plain(own, other)


def test_asof_join_options(spark):
    left, right, own, other = asof_tables(spark, seed=2)
    got = asof.asof_join(left, right, ["k"], "t", "u", ["u", "v", "j"], strict=True, within_seconds=60, width=100)
    want = asof_plain(own, other, strict=True, within=60)
    assert sorted(map(tuple, got.collect()), key=str) == want
    inner = asof.asof_join(left, right, ["k"], "t", "u", ["u", "v", "j"], inner=True)
    assert inner.count() == sum(r[3] is not None for r in asof_plain(own, other))
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(left, right, ["k"], "t", "u", ["k"])


def test_asof_join_of_empty_sides(spark):
    left, right, own, _ = asof_tables(spark, n=20)
    none = asof.asof_join(left, right.limit(0), ["k"], "t", "u", ["v"])
    assert none.count() == 20 and none.filter("v is not null").isEmpty()
    assert asof.asof_join(left.limit(0), right, ["k"], "t", "u", ["v"]).isEmpty()


def test_asof_join_neither_loops_nor_holds_a_key_in_one_window(spark):
    left, right, *_ = asof_tables(spark)
    plan = plan_of(asof.asof_join(left, right, ["k"], "t", "u", ["v"], width=60))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    hot = left.filter("k = 1 and t is not null")
    assert timeline.slice_width(hot, ["k"], "t", at_most=20) <= 2000 // (hot.count() // 20)


# Overlapping intervals


@pytest.mark.parametrize("width, piece", [(None, 4096), (1, 2), (50, 3), (10**6, 5)])
def test_overlapping_pairs_equal_plain(spark, width, piece):
    rng = random.Random(3)
    rows = []
    for i in range(160):
        start = rng.choice([None, *[rng.randrange(900)] * 15])
        end = None if start is None else start + rng.choice([-5, 0, 1, 30, 30, 200, None or 60])
        rows.append((rng.choice([1, 1, 2, None]), at(start), at(end), i % 40))
    rows += rows[:10]
    frame = spark.createDataFrame(rows, "k int, s timestamp_ntz, e timestamp_ntz, v int")
    want = []
    usable = [r for r in rows if None not in r[:3] and r[1] < r[2]]
    for i, a in enumerate(usable):
        for b in usable[i + 1 :]:
            first, second = sorted((a, b), key=lambda r: (r[1], r[2], r[3]))
            if a[0] == b[0] and second[1] < first[2]:
                shared = (min(first[2], second[2]) - second[1]).total_seconds() / 60
                want.append((a[0], first[3], second[3], round(shared, 6)))
    got = overlaps.overlapping_pairs(frame, ["k"], "s", "e", ["v"], width=width, piece=piece)
    assert sorted((r.k, r.first_v, r.second_v, round(r.overlap_minutes, 6)) for r in got.collect()) == sorted(want)


def test_overlaps_have_no_nested_loop_and_allow_empty_tables(spark):
    frame = spark.createDataFrame([], "k int, s timestamp_ntz, e timestamp_ntz, v int")
    found = overlaps.overlapping_pairs(frame, ["k"], "s", "e", ["v"])
    assert found.columns == ["k", "first_v", "second_v", "overlap_minutes"] and found.isEmpty()
    plan = plan_of(overlaps.overlapping_pairs(frame, ["k"], "s", "e", ["v"], width=60))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("run", [1, 3, 64])
def test_overlapping_pairs_of_cut_runs_with_ties_equal_plain(spark, monkeypatch, run):
    monkeypatch.setattr(overlaps, "RUN", run)
    rng = random.Random(5)
    rows = [(1, at(s), at(s + rng.choice([1, 3, 40])), rng.choice([None, 1, 2])) for s in (rng.randrange(12) for _ in range(90))]
    frame = spark.createDataFrame(rows, "k int, s timestamp_ntz, e timestamp_ntz, v int")
    want = []
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            first, second = sorted((a, b), key=lambda r: (r[1], r[2], r[3] or 0))
            if second[1] < first[2]:
                want.append((first[3], second[3], round((min(first[2], second[2]) - second[1]).total_seconds() / 60, 6)))
    for width, piece in ((10**6, 4096), (5, 4)):
        got = overlaps.overlapping_pairs(frame, ["k"], "s", "e", ["v"], width=width, piece=piece)
        assert sorted(((r.first_v, r.second_v, round(r.overlap_minutes, 6)) for r in got.collect()), key=str) == sorted(want, key=str)


def joined_rows(df):
    """Rows that the joins of a plan that has run gave out."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if "Join" in kind:
            found += node.metrics().apply("numOutputRows").value()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_overlapping_pairs_are_no_rows_of_a_join(spark):
    n = 1000
    frame = spark.createDataFrame([(1, at(i), at(i + 2 * n), i) for i in range(n)], "k int, s timestamp_ntz, e timestamp_ntz, v int")
    found = overlaps.overlapping_pairs(frame, ["k"], "s", "e", ["v"], width=10**6).agg(F.count("*").alias("n"))
    assert found.collect()[0].n == n * (n - 1) // 2
    assert 0 < joined_rows(found) <= 10 * n


# Under way at once


@pytest.mark.parametrize("width", [None, 1, 60, 10**6])
def test_under_way_equals_plain(spark, width):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 2, None]), s, s + rng.choice([-1, 0, 5, 90])) for s in (rng.randrange(300) for _ in range(120))]
    frame = spark.createDataFrame([(k, at(s), at(e)) for k, s, e in rows] + [(1, None, at(9))], "k int, s timestamp_ntz, e timestamp_ntz")
    live = [r for r in rows if r[1] < r[2]]
    want = {
        (k, at(m)): sum(o == k and s <= m < e for o, s, e in live)
        for k, *ends in live
        for m in ends
    }
    got = concurrency.under_way(frame, ["k"], "s", "e", width=width)
    assert {(r.k, r.moment): r.under_way for r in got.collect()} == want
    peaks = {r.k: (r.most, r.first_at) for r in concurrency.peaks(got, ["k"]).collect()}
    for k in {1, 2, None}:
        most = max(n for (o, _), n in want.items() if o == k)
        assert peaks[k] == (most, min(m for (o, m), n in want.items() if o == k and n == most))


def test_under_way_of_nothing(spark):
    frame = spark.createDataFrame([], "k int, s timestamp_ntz, e timestamp_ntz")
    assert concurrency.under_way(frame, ["k"], "s", "e").isEmpty()


# Sessions


def sessions_plain(rows):
    out = []
    for key in {r[0] for r in rows if r[0] is not None}:
        own = sorted((r for r in rows if r[0] == key and r[1] is not None and r[2]), key=lambda r: r[1])
        current = None
        for _, t, gap, v in own:
            if current and t <= current["end"]:
                current["last"], current["n"] = t, current["n"] + 1
                current["end"] = max(current["end"], t + timedelta(seconds=gap))
            else:
                current = {"start": t, "last": t, "end": t + timedelta(seconds=gap), "n": 1}
                out.append((key, current))
    return sorted((k, c["start"], c["last"], c["end"], c["n"]) for k, c in out)


def test_sessions_with_gaps_by_row_equal_plain(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 2, None]), at(rng.choice([None, *[rng.randrange(4000)] * 9])), rng.choice([0, 5, 20, 60, None]), 1.0)
            for _ in range(300)]
    frame = spark.createDataFrame(rows, "k int, t timestamp_ntz, gap int, v double")
    got = sessions.sessions(frame, ["k"], "t", F.col("gap"), "v")
    assert sorted(tuple(r)[:5] for r in got.collect()) == sessions_plain(rows)
    late = got.filter(F.col("session_end") <= F.lit(at(2000)))
    assert sorted(tuple(r)[:5] for r in late.collect()) == [s for s in sessions_plain(rows) if s[3] <= at(2000)]
    assert sessions.sessions(frame.limit(0), ["k"], "t", F.col("gap"), "v").isEmpty()


# Sketches


def test_sketches_answer_any_range_of_days(spark):
    rng = random.Random(7)
    rows = [(date(2024, 1, 1 + i % 20), rng.randrange(3000), rng.expovariate(0.1)) for i in range(30_000)]
    rows += [(date(2024, 1, 3), None, None)]
    daily = sketches.by_day(spark.createDataFrame(rows, "d date, k long, x double"), "d", F.col("k"), F.col("x"))
    for first, last in [(1, 1), (4, 9), (1, 20)]:
        days = F.col("d").between(date(2024, 1, first), date(2024, 1, last))
        row = sketches.over(daily.filter(days), [], {"low": 0.1, "mid": 0.5, "high": 0.95}).first()
        own = [r for r in rows if first <= r[0].day <= last]
        exact = len({k for _, k, _ in own if k is not None})
        assert row.n == len(own) and abs(row.n_distinct - exact) <= max(1, exact * sketches.DISTINCT_BOUND)
        values = np.array([x for *_, x in own if x is not None])
        for q, estimate in ((0.1, row.low), (0.5, row.mid), (0.95, row.high)):
            assert abs((values <= estimate).mean() - q) <= sketches.RANK_BOUND


# Exact quantiles


@pytest.mark.parametrize("buckets", [2, 16, 2048])
def test_exact_quantiles_equal_numpy(spark, monkeypatch, buckets):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    rng = random.Random(8)
    values = [1e300, -1e300, 0.0, 1e-9, 5.0, 5.0, 5.0]
    rows = [(1, x) for x in values] + [(2, 3.0)] + [(3, None), (3, float("nan")), (3, float("inf"))]
    rows += [(None, rng.gauss(0, 1)) for _ in range(60)] + [(4, 7.0)] * 9
    frame = spark.createDataFrame(rows, "k int, x double")
    got = {r.k: r for r in quantiles.exact_quantiles(frame, ["k"], F.col("x"), {"a": 0.0, "b": 0.3, "c": 1.0}).collect()}
    assert set(got) == {1, 2, None, 4}
    for k, r in got.items():
        own = [x for o, x in rows if o == k]
        assert r.n == len(own)
        for q, v in ((0.0, r.a), (0.3, r.b), (1.0, r.c)):
            assert v == pytest.approx(np.quantile(own, q), rel=1e-9, abs=1e-12)
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(frame, ["k"], F.col("x"), {"a": 1.5})
    assert quantiles.exact_quantiles(frame.limit(0), ["k"], F.col("x"), {"a": 0.5}).isEmpty()


def test_robust_scores_are_not_moved_by_outliers(spark):
    rows = [(1, float(x)) for x in range(1, 100)] + [(1, 1e6)] + [(2, 5.0)] * 4
    frame = spark.createDataFrame(rows, "k int, x double")
    got = {r.k: r for r in quantiles.robust_outliers(frame, ["k"], "x").collect()}
    assert (got[1].median, got[1].mad, got[1].n_outliers) == (50.5, 25.0, 1)
    assert (got[2].mad, got[2].n_outliers) == (0.0, 0)


# Runs and gaps


def test_runs_and_gaps(spark):
    counts = {1: 3, 2: 4, 3: 9, 4: 9, 6: 10, 7: 11, 8: 12, 12: 1}
    rows = [(1, date(2024, 1, d)) for d, n in counts.items() for _ in range(n)] + [(2, date(2024, 1, 5)), (1, None)]
    daily = runs.daily_counts(spark.createDataFrame(rows, "k int, d date"), ["k"], "d")
    rises = {r.k: tuple(r)[1:] for r in runs.longest_rises(daily, ["k"], "d").collect()}
    assert rises[1] == (date(2024, 1, 1), date(2024, 1, 3), 3, 3, 9)
    assert rises[2] == (date(2024, 1, 5), date(2024, 1, 5), 1, 1, 1)
    gaps = sorted(tuple(r) for r in runs.gaps(daily, ["k"], "d").collect())
    assert gaps == [(1, date(2024, 1, 5), date(2024, 1, 5), 1), (1, date(2024, 1, 9), date(2024, 1, 11), 3)]


# Snapshots


def test_snapshots_as_multisets(spark):
    schema = "k int, a string, b double"
    before = [(1, "x", 1.0), (1, "x", 1.0), (2, None, None), (3, "", 1.0), (None, "n", 0.0), (5, "gone", 1.0), (6, "a", 1.0)]
    after = [(1, "x", 1.0), (2, None, None), (3, None, 1.0), (None, "n", 0.0), (None, "n", 0.0), (7, "new", 1.0), (6, "b", 2.0), (6, "c", 2.0)]
    old, new = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema).select("b", "a", "k")
    changes = snapshots.key_changes(old, new, ["k"])
    got = {r.k: tuple(r)[1:] for r in changes.collect()}
    assert got == {
        1: (0, 1, 0, 1, 0), 2: (0, 0, 0, 1, 0), 3: (0, 0, 1, 0, 0), None: (1, 0, 0, 1, 1),
        5: (0, 1, 0, 0, 0), 6: (1, 0, 1, 0, 0), 7: (1, 0, 0, 0, 0),
    }
    assert tuple(snapshots.summary(changes).first()) == (7, 6, 3, 2, 2, 3, 1)
    moved = snapshots.differing_rows(old, changes, ["k"])
    assert sorted((r.k for r in moved.collect()), key=str) == sorted([1, 1, 3, None, 5, 6], key=str)
    empty = old.limit(0)
    assert snapshots.summary(snapshots.key_changes(empty, empty, ["k"])).first().n_keys == 0
    with pytest.raises(ValueError, match="different columns"):
        snapshots.key_changes(old, new.drop("b"), ["k"])


def test_snapshots_tell_microseconds_and_borders_apart(spark):
    schema = "k int, t timestamp_ntz, a string, b string"
    one = datetime(2024, 1, 1, 0, 0, 0, 1)
    old = spark.createDataFrame([(1, one, "ab", "c"), (2, one, "x", "y")], schema)
    new = spark.createDataFrame([(1, one, "a", "bc"), (2, one + timedelta(microseconds=1), "x", "y")], schema)
    assert snapshots.summary(snapshots.key_changes(old, new, ["k"])).first().changed == 2


# Axes


def test_principal_axes_equal_numpy(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3)) @ np.array([[3.0, 1, 0], [0, 1, 0.5], [0, 0, 0.1]]) + 1e6
    rows = [(*map(float, r), 4.0) for r in x] + [(None, 1.0, 1.0, 4.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, same double")
    got = axes.principal_axes(frame, ["a", "b", "c", "same"])
    values, vectors = np.linalg.eigh(np.corrcoef(x.T))
    assert np.allclose(got.shares[:3], values[::-1] / 3)
    for own, v in zip(got.loadings, vectors.T[::-1]):
        assert np.allclose(np.abs(own[:3]), np.abs(v), atol=1e-6) and own[np.argmax(np.abs(own) > 1e-9)] > 0
    scores = np.array([tuple(r) for r in axes.projected(frame, got, 2).select("axis_1", "axis_2").collect()][:300])
    assert np.allclose(scores.var(axis=0, ddof=1), got.shares[:2] * 3)
    scaled = axes.scaled(frame, ["a", "same"]).first()
    assert scaled.scaled_same is None and scaled.scaled_a is not None
    assert axes.axis_table(frame.limit(0), ["a", "b"]).count() == 2


# JSON fields


def test_json_fields_and_broken_texts(spark):
    texts = ['{"k": 1, "s": "x"}', '{"k": "no number"}', "{broken", None, "", "[1, 2]", '{"k": 2, "more": {"y": 1.5}}']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = semistructured.fields(frame, "t", {"k": ("$.k", "int"), "y": ("$.more.y", "double")})
    assert [(r.k, r.y) for r in got.orderBy("i").collect()] == [
        (1, None), (None, None), (None, None), (None, None), (None, None), (None, None), (2, 1.5),
    ]
    assert sorted(r.i for r in semistructured.broken(frame, "t").collect()) == [2, 4]
    report = semistructured.report(frame, "t").first()
    assert (report.n_rows, report.n_null, report.n_broken) == (7, 1, 2)
