"""Ride sharing against known vectors and a plain-Python count."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.operators import sharing
from tripweave.operators.cleaning import prepare


def at(text: str) -> dict:
    return {"tpep_pickup_datetime": datetime.fromisoformat(text)}


def test_bucket_and_spread(trips_of):
    trips = prepare(trips_of(at("2024-01-17 15:35:14"), at("2024-01-17 15:39:56")))
    row = sharing.share_groups(trips).first()
    assert (row.time_window, row.n_trips, row.spread_minutes) == (5685019, 2, 4.7)
    trips = prepare(trips_of(at("2024-01-15 08:30:42"), at("2024-01-15 08:34:40")))
    row = sharing.share_groups(trips).first()
    assert row.time_window == 5684358
    assert row.spread_minutes == pytest.approx(3.9666666)


def test_bucket_edges_split_groups(trips_of):
    trips = prepare(trips_of(at("2024-01-15 08:04:59"), at("2024-01-15 08:05:00")))
    assert sharing.share_groups(trips).count() == 0
    assert sharing.share_groups(trips, minutes=10).count() == 1


def test_only_short_trips_with_zones(trips_of):
    trips = prepare(
        trips_of({}, {"trip_distance": 6.3}, {"PULocationID": None}, {"DOLocationID": None})
    )
    assert sharing.candidates(trips).count() == 1
    rate = sharing.candidate_rate(trips).first()
    assert (rate.n_trips, rate.n_candidates, rate.pct_candidates) == (4, 1, 25.0)


@pytest.mark.parametrize("n, shared, saved", [(2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 3, 2)])
def test_savings(trips_of, n, shared, saved):
    groups = sharing.share_groups(prepare(trips_of(*[{}] * n)))
    row = sharing.savings(groups).first()
    assert (row.shared_trips, row.saved_trips) == (shared, saved)
    assert row.money_saved == pytest.approx(n * 10 - shared * 10 * 1.1)
    assert row.minutes_saved == pytest.approx(saved * 10)


def test_scenarios_charge_no_detour(trips_of):
    groups = sharing.share_groups(prepare(trips_of(*[{}] * 5)))
    two, three = sharing.scenarios(groups).collect()
    assert (two.scenario, two.saved_trips, two.money_saved) == ("2 passengers/taxi", 2, 20.0)
    assert (three.scenario, three.saved_trips, three.money_saved) == ("3 passengers/taxi", 3, 30.0)


@pytest.mark.parametrize("minutes", [0, -5])
def test_width_is_positive(trips_of, minutes):
    with pytest.raises(ValueError):
        sharing.share_groups(prepare(trips_of({})), minutes=minutes)


@pytest.mark.parametrize("minutes", [7, 45, 120])
def test_any_width_forms_groups(trips_of, minutes):
    times = [datetime(2024, 1, 15, 8) + timedelta(minutes=11 * i) for i in range(30)]
    trips = prepare(trips_of(*({"tpep_pickup_datetime": t} for t in times)))
    want = defaultdict(int)
    for t in times:
        want[int((t - datetime(1970, 1, 1)).total_seconds()) // (60 * minutes)] += 1
    got = {r.time_window: r.n_trips for r in sharing.share_groups(trips, minutes).collect()}
    assert got == {k: n for k, n in want.items() if n > 1}


def test_hours_and_days_need_nested_buckets(trips_of):
    groups = sharing.share_groups(prepare(trips_of({}, {})), minutes=120)
    with pytest.raises(ValueError):
        sharing.by_hour(groups, minutes=120)
    assert sharing.by_day(groups, minutes=120).first().n_trips == 2
    with pytest.raises(ValueError):
        sharing.by_day(groups, minutes=7)


def test_no_groups_at_all(trips_of):
    trips = prepare(trips_of({}))
    total = sharing.savings_total(sharing.trip_groups(sharing.candidates(trips))).first()
    assert (total.n_groups, total.n_candidates, total.saved_trips) == (0, 1, None)


def test_a_crowded_group_is_folded_before_the_shuffle(spark, trips_of):
    row = prepare(trips_of({})).first()
    many = spark.range(0, 300_000, numPartitions=6).select(
        "id",
        *(F.lit(row[c]).alias(c) for c in sharing.CANDIDATE_COLUMNS if c != "DOLocationID"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id")).cast("int").alias("DOLocationID"),
    )
    crowd = sharing.shareable(sharing.trip_groups(many))
    rows = crowd.collect()
    assert [(r.DOLocationID, r.n_trips, r.total_passengers) for r in rows] == [(2, 100_001, 100_001)]
    plan = crowd._jdf.queryExecution().executedPlan().toString()
    partial = [i for i, x in enumerate(plan.splitlines()) if "partial_count(1)" in x]
    shuffle = [i for i, x in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in x]
    assert shuffle and partial and min(partial) > min(shuffle)


one = st.tuples(
    st.integers(0, 3600), st.integers(1, 2), st.integers(1, 2), st.integers(1, 6), st.integers(5, 40)
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(one, min_size=1, max_size=60))
def test_against_plain_python(trips_of, rows):
    start = datetime(2024, 1, 15, 23, 30)
    trips = prepare(
        trips_of(
            *(
                {
                    "tpep_pickup_datetime": start + timedelta(seconds=s),
                    "PULocationID": o,
                    "DOLocationID": d,
                    "passenger_count": p,
                    "fare_amount": float(f),
                }
                for s, o, d, p, f in rows
            )
        )
    )
    want = defaultdict(list)
    for s, o, d, p, f in rows:
        epoch = int((start + timedelta(seconds=s) - datetime(1970, 1, 1)).total_seconds())
        want[epoch // 300, o, d].append((epoch, p, f))
    want = {k: v for k, v in want.items() if len(v) > 1}
    all_groups = sharing.trip_groups(sharing.candidates(trips))
    groups = sharing.shareable(all_groups)
    got = {(r.time_window, r.PULocationID, r.DOLocationID): r for r in groups.collect()}
    assert set(got) == set(want)
    for key, members in want.items():
        row, times = got[key], [m[0] for m in members]
        assert row.n_trips == len(members)
        assert row.total_passengers == sum(m[1] for m in members)
        assert row.avg_fare == pytest.approx(sum(m[2] for m in members) / len(members))
        assert row.spread_minutes == pytest.approx((max(times) - min(times)) / 60)
    total = sharing.savings_total(all_groups).first()
    assert total.n_candidates == len(rows)
    assert (total.saved_trips or 0) == sum(len(v) - math.ceil(len(v) / 2) for v in want.values())
    by_hour = sharing.by_hour(groups).collect()
    assert sum(r.n_groups for r in by_hour) == len(want)
    assert {r.hour for r in by_hour} == {k[0] * 300 // 3600 % 24 for k in want}
    by_day = sharing.by_day(groups).collect()
    assert sum(r.n_trips for r in by_day) == sum(len(v) for v in want.values())
