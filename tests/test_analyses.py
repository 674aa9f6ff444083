"""Zones, anomalies, segments, charts: edge cases and invariants."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from tripweave.operators import anomalies, profiling, segments, sharing, zones
from tripweave.operators.cleaning import clean_report, prepare
from tripweave.operators.grouping import describe, top_rows
from tripweave.plans import charts
from tripweave.plans.reports import (
    BAND_REPORTS,
    REPORTS,
    all_reports,
    band_part,
    fold,
    report,
    time_part,
    time_totals,
)
from tripweave.sources import driver_tables


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return driver_tables.raw_trips(spark, sf_dir)


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return driver_tables.prepared_trips(spark, sf_dir)


@pytest.fixture(scope="module")
def zone_table(spark, sf_dir):
    return driver_tables.zones(spark, sf_dir)


# zones


def test_unknown_zone_keeps_the_trip_and_text_na_counts(trips_of, zones_of):
    table = zones_of((1, "N/A", "N/A"), (2, "Queens", "Corona"))
    trips = prepare(trips_of({}, {"PULocationID": 99}, {"PULocationID": None}))
    joined = zones.join_zones(trips, table)
    assert joined.count() == 3
    assert joined.filter("pickup_zone IS NULL").count() == 2
    rate = zones.match_rate(trips, table).first()
    assert (rate.n_trips, rate.n_matched) == (3, 1)
    stats = zones.borough_stats(trips, table, "pickup").collect()
    assert [(r.pickup_borough, r.n) for r in stats] == [("N/A", 1)]
    assert stats[0].pct == pytest.approx(100 / 3)


def test_ids_with_one_name_merge(trips_of, zones_of):
    table = zones_of((1, "Queens", "Corona"), (2, "Queens", "Corona"), (3, "Queens", "Astoria"))
    trips = prepare(
        trips_of(
            {"PULocationID": 1, "fare_amount": 10.0},
            {"PULocationID": 2, "fare_amount": 40.0},
            {"PULocationID": 2, "fare_amount": 40.0},
            {"PULocationID": 3},
        )
    )
    top = zones.top_zones(trips, table, "pickup").collect()
    assert [(r.pickup_zone, r.n, r.avg_fare) for r in top] == [("Corona", 3, 30.0), ("Astoria", 1, 10.0)]


@pytest.mark.parametrize("end", ["pickup", "dropoff"])
def test_totals_per_id_equal_the_row_level_join(trips, zone_table, end):
    direct = (
        zones.join_zone(trips, zone_table, end)
        .filter(F.col(f"{end}_zone").isNotNull())
        .groupBy(f"{end}_borough", f"{end}_zone")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("fare_amount").alias("avg_fare"))
    )
    want = {tuple(r)[:2]: (r.n, r.avg_fare) for r in direct.collect()}
    got = zones.top_zones(trips, zone_table, end, n=1000).collect()
    assert len(got) == len(want)
    for r in got:
        n, fare = want[tuple(r)[:2]]
        assert r.n == n and r.avg_fare == pytest.approx(fare)


def test_ties_are_cut_by_name(trips_of, zones_of):
    table = zones_of(*((i, "Queens", name) for i, name in enumerate("dbca")))
    trips = prepare(trips_of(*({"PULocationID": i} for i in range(4))))
    assert [r.pickup_zone for r in zones.top_zones(trips, table, "pickup", 2).collect()] == ["a", "b"]


# profile


def test_missing_counts_empty_text(trips_of):
    df = trips_of({"store_and_fwd_flag": ""}, {"store_and_fwd_flag": None}, {"passenger_count": None}, {})
    got = {r["column"]: (r.nulls, r.pct) for r in profiling.missing_values(df).collect()}
    assert got["store_and_fwd_flag"] == (2, 50.0)
    assert got["passenger_count"] == (1, 25.0)
    assert got["fare_amount"] == (0, 0.0)


def test_profiles_of_an_empty_table(trips_of):
    empty = trips_of({}).filter("false")
    assert profiling.row_count(empty).first().n == 0
    assert {r.n for r in profiling.outliers(empty).collect()} == {0}
    assert {r.pct for r in profiling.outliers(empty).collect()} == {None}
    assert clean_report(empty).first().pct_removed is None
    assert [r["count"] for r in describe(empty, ["fare_amount"]).collect()] == [0]
    assert report(prepare(empty), "hourly_distribution").count() == 0
    assert anomalies.rate(prepare(empty)).first().n_anomalies == 0


def test_unknown_codes_have_no_label(trips_of):
    df = trips_of({"RatecodeID": 99}, {"RatecodeID": None}, {"RatecodeID": 2})
    got = {r.RatecodeID: r.rate_label for r in profiling.ratecode_labelled(df).collect()}
    assert got == {99: None, None: None, 2: "JFK"}


def test_describe_equals_builtin(trips):
    builtin = {r.summary: float(r.fare_amount) for r in trips.select("fare_amount").describe().collect()}
    row = describe(trips, ["fare_amount"]).first().asDict()
    for name, value in builtin.items():
        assert row[name] == pytest.approx(value)


# reports


def test_counts_and_percentages_add_up(trips):
    n = trips.count()
    whole = [name for name, r in REPORTS.items() if r.where is None]
    assert len(whole) > 20
    for name in whole:
        assert report(trips, name).agg(F.sum("n")).first()[0] == n, name
    for name in (name for name, r in REPORTS.items() if r.share):
        assert report(trips, name).agg(F.sum("pct")).first()[0] == pytest.approx(100), name


def test_short_and_long_payments_split_the_trips(trips):
    parts = [report(trips, f"payment_{part}").agg(F.sum("n")).first()[0] for part in ("short", "long")]
    assert sum(parts) == trips.count()


def test_report_groups_of_the_same_size_keep_their_order(trips_of):
    trips = prepare(trips_of({"payment_type": 2}, {"payment_type": 1}, {"payment_type": 3}))
    labels = [r.payment_type_label for r in report(trips, "payment_distribution").collect()]
    assert labels == ["Credit card", "Cash", "No charge"]


# totals


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9)
    return a == b


def assert_same(direct, merged, name):
    assert direct.dtypes == merged.dtypes, name
    ours, theirs = direct.collect(), merged.collect()
    assert len(ours) == len(theirs), name
    for a, b in zip(ours, theirs):
        assert all(map(close, a, b)), (name, a, b)


def test_reports_from_totals_equal_reports_from_trips(spark, trips, tmp_path):
    fold(trips).write.parquet(str(tmp_path / "totals"))
    folded = spark.read.parquet(str(tmp_path / "totals"))
    merged = all_reports(time_part(folded), band_part(folded))
    assert set(merged) == set(REPORTS) and set(BAND_REPORTS) < set(REPORTS)
    alone = time_totals(trips)
    assert_same(alone.orderBy(*alone.columns), time_part(folded).select(alone.columns).orderBy(*alone.columns), "time")
    for name, df in merged.items():
        assert_same(report(trips, name), df, name)


def test_rankings_from_totals_equal_rankings_from_trips(spark, trips, zone_table, tmp_path):
    zones.zone_totals(trips).write.parquet(str(tmp_path / "totals"))
    merged = zones.all_rankings(spark.read.parquet(str(tmp_path / "totals")), zone_table)
    assert len(merged) == 10
    assert_same(zones.match_rate(trips, zone_table), merged["zone_match_rate"], "match")
    assert_same(zones.borough_flows(trips, zone_table), merged["borough_flows"], "flows")
    for end in ("pickup", "dropoff"):
        assert_same(zones.top_zones(trips, zone_table, end), merged[f"top_{end}_zones"], end)
        assert_same(zones.borough_stats(trips, zone_table, end), merged[f"{end}_borough_stats"], end)
        for short, word in ((True, "short"), (False, "long")):
            direct = zones.top_zones_by_length(trips, zone_table, end, short)
            assert_same(direct, merged[f"{word}_top_{end}"], word + end)


# anomalies


def test_constant_columns_are_no_anomalies(trips_of):
    scored = anomalies.scores(prepare(trips_of({}, {}, {}))).collect()
    assert {r.z_dist for r in scored} == {None}
    assert anomalies.rate(prepare(trips_of({}, {}, {}))).first().n_anomalies == 0


def test_far_values_are_flagged_on_both_sides_by_type(trips_of):
    common = [{"fare_amount": 10.0 + i % 3} for i in range(60)]
    far = [{"fare_amount": 200.0}, {"trip_distance": 28.0, "minutes": 60}]
    trips = prepare(trips_of(*common, *far))
    flagged = anomalies.anomalies(trips)
    got = {r.anomaly_type: r.n for r in anomalies.types(flagged).collect()}
    assert got == {"Abnormal fare": 1, "Excessive distance": 1}
    assert anomalies.top(flagged, 1).first().trip_distance_km == pytest.approx(28 * 1.60934)


def test_baseline_is_computed_once(spark, trips):
    df = anomalies.anomalies(trips).agg(F.count(F.lit(1)))
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("\n+- == Initial Plan ==")[0]
    assert len(set(re.findall(r"Subquery (subquery#\d+)", final))) == 1


# segments


@pytest.mark.parametrize(
    "km, minutes, profile",
    [
        (4.9, 14, "Short and fast"),
        (4.9, 15, "Short but slow"),
        (5.1, 10, "Long and fluid"),
        (5.1, 11, "Long and congested"),
    ],
)
def test_profiles(trips_of, km, minutes, profile):
    trips = prepare(trips_of({"trip_distance": km / 1.60934, "minutes": minutes}))
    assert segments.categorize(trips).first().trip_profile == profile


@pytest.mark.parametrize(
    "fare, tip, revenue, tip_class",
    [
        (9.99, 0.0, "Low revenue", "Low tip"),
        (10.0, 1.0, "Medium revenue", "Standard tip"),
        (25.0, 5.0, "Good revenue", "Generous tip"),
        (50.0, 50.0, "Excellent revenue", "Generous tip"),
    ],
)
def test_revenue_and_tip_classes(trips_of, fare, tip, revenue, tip_class):
    row = segments.categorize(prepare(trips_of({"fare_amount": fare, "tip_amount": tip}))).first()
    assert (row.revenue_category, row.tip_category) == (revenue, tip_class)


def test_correlation_equals_ml(trips):
    ml = Correlation.corr(segments.feature_vectors(trips), "features").first()[0].toArray()
    got = {(r.var_a, r.var_b): r.r for r in segments.correlation_matrix(trips).collect()}
    for i, a in enumerate(segments.FEATURES):
        for j, b in enumerate(segments.FEATURES):
            assert got[a, b] == pytest.approx(ml[i][j], abs=1e-9)
            assert got[a, b] == got[b, a]


def test_correlation_drops_rows_with_a_gap(trips_of):
    rows = [{"trip_distance": float(i), "fare_amount": 5.0 * i, "tip_amount": None if i == 4 else 1.0 * i}
            for i in range(1, 5)]
    rows[3]["fare_amount"] = 400.0
    trips = prepare(trips_of(*rows))
    got = {(r.var_a, r.var_b): r.r for r in segments.correlation_matrix(trips).collect()}
    assert got["trip_distance_km", "fare_amount"] == pytest.approx(1.0)
    assert got["trip_distance_km", "passenger_count"] is None
    assert got["passenger_count", "passenger_count"] == 1.0


def test_efficiency(trips_of):
    row = segments.efficiency(prepare(trips_of({}))).first()
    km = 2 * 1.60934
    assert row.revenue_per_km == pytest.approx(10 / km)
    assert row.revenue_per_minute == pytest.approx(1.0)
    assert row.efficiency_score == pytest.approx(10 / (km + 1))


# charts


def test_pivot_fills_absent_labels_with_zero(trips_of):
    row = charts.payment_pivot(prepare(trips_of({}, {}))).first()
    assert (row["Credit card"], row["Cash"], row["Voided"]) == (2, 0, 0)


def test_absent_categories_stay(trips_of):
    got = charts.category_ordered(prepare(trips_of({}))).collect()
    assert [r.n for r in got] == [0, 1, 0, 0, 0]
    assert got[0].avg_fare is None


def test_date_range_is_closed(trips_of):
    from datetime import datetime

    trips = prepare(trips_of(*({"tpep_pickup_datetime": datetime(2024, 1, d, 23, 59)} for d in range(7, 12))))
    got = charts.payment_by_date_range(trips, date(2024, 1, 8), date(2024, 1, 10)).collect()
    assert [r.trip_date.day for r in got] == [8, 9, 10]


def test_vendor_gaps_are_not_counted(trips_of):
    row = charts.payment_counts(prepare(trips_of({}, {"VendorID": None}))).first()
    assert row.n == 1


def test_dashboard_agrees_with_its_parts(trips):
    board = charts.kpi_dashboard(trips).first()
    assert board.n_trips == trips.count()
    assert board.n_share_groups == sharing.share_groups(trips).count()
    assert board.peak_hour == charts.peak_hours(report(trips, "hourly_distribution"), 1).first().hour


def test_share_hours_cover_all_groups(trips):
    groups = sharing.share_groups(trips)
    assert sharing.by_hour(groups).agg(F.sum("n_groups")).first()[0] == groups.count()
    two, three = sharing.scenarios(groups).collect()
    assert 0 <= two.saved_trips <= three.saved_trips


def test_top_rows_break_ties_by_all_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'b'), (1, 'a'), (2, 'z'), (1, CAST(NULL AS STRING)) t(x, y)")
    assert [tuple(r) for r in top_rows(df, [F.desc("x")], 3).collect()] == [(2, "z"), (1, None), (1, "a")]
