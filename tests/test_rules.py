"""Cleaning, enrichment and band rules at their edges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from support import NOON
from tripweave.functions.columns import band_order, banded, bucket_of, bucket_start
from tripweave.functions.labels import ENGLISH, FRENCH, Bands
from tripweave.operators.cleaning import clean, clean_report, plausible, prepare
from tripweave.operators.enrichment import DERIVED, enrich
from tripweave.sources.schemas import PREPARED, TRIPS

KM = 1.60934


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": 199.9}, True),
        ({"trip_distance": 200.0}, False),
        ({"trip_distance": None}, False),
        ({"fare_amount": 0.0}, False),
        ({"fare_amount": -3.0}, False),
        ({"fare_amount": 500.0}, False),
        ({"total_amount": 0.0}, False),
        ({"total_amount": 600.0}, False),
        ({"passenger_count": 0}, False),
        ({"passenger_count": 6}, True),
        ({"passenger_count": 7}, False),
        ({"passenger_count": None}, False),
        ({"minutes": 0}, False),
        ({"minutes": -1}, False),
        ({"tpep_dropoff_datetime": None}, False),
        ({"payment_type": None}, True),
    ],
)
def test_validity(trips_of, change, kept):
    assert clean(trips_of(change)).count() == int(kept)


def test_missing_pickup_is_invalid(trips_of):
    assert clean(trips_of({"tpep_pickup_datetime": None, "tpep_dropoff_datetime": NOON})).count() == 0


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"minutes": 299}, True),
        ({"minutes": 300}, False),
        ({"trip_distance": 100.0 / KM, "minutes": 31}, True),
        ({"trip_distance": 110.0 / KM, "minutes": 30}, False),
    ],
)
def test_plausibility(trips_of, change, kept):
    assert plausible(enrich(trips_of(change))).count() == int(kept)


def test_clean_report_adds_up(trips_of):
    rows = [{}, {"fare_amount": -1.0}, {"trip_distance": 0.0}, {"minutes": 301}]
    got = clean_report(trips_of(*rows)).first()
    assert (got.n_raw, got.n_valid, got.n_final, got.n_removed) == (4, 2, 1, 2)
    assert got.pct_removed == 50.0


def test_derived_columns(trips_of):
    row = enrich(trips_of({"trip_distance": 10.0, "minutes": 20})).first()
    assert row.trip_duration_minutes == 20.0
    assert row.trip_distance_km == pytest.approx(16.0934)
    assert row.average_speed_kmh == pytest.approx(16.0934 * 3)
    assert (row.hour, row.day_of_week, row.day_name) == (12, 4, "Wednesday")
    assert row.trip_date == date(2024, 1, 17)
    assert row.tip_percentage == 20.0
    assert row.trip_category == "Medium (10-20 km)"
    assert (row.is_short_trip, row.is_weekend) == (False, False)


def test_prepared_schema_is_the_declared_one(trips_of):
    df = prepare(trips_of({}))
    assert df.columns == TRIPS.names + list(DERIVED)
    assert [f.dataType for f in df.schema] == [f.dataType for f in PREPARED]


def test_null_inputs_fall_to_the_last_label(trips_of):
    gone = {"tpep_pickup_datetime": None, "tpep_dropoff_datetime": None}
    row = enrich(
        trips_of(gone | {"trip_distance": None, "payment_type": None, "fare_amount": None})
    ).first()
    assert row.day_name == "Saturday"
    assert row.time_period == "Night (23h-5h)"
    assert row.trip_category == "Very long (> 50 km)"
    assert row.payment_type_label == "Voided"
    assert (row.is_short_trip, row.is_weekend) == (False, False)
    assert (row.average_speed_kmh, row.tip_percentage) == (0.0, 0.0)


def test_periods(trips_of):
    starts = [{"tpep_pickup_datetime": datetime(2024, 1, 17, h)} for h in range(24)]
    got = {r.hour: r.time_period.split()[0] for r in enrich(trips_of(*starts)).collect()}
    want = {5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon", 17: "Afternoon"}
    want |= {18: "Evening", 22: "Evening", 23: "Night", 0: "Night"}
    assert {h: got[h] for h in want} == want


def test_days_and_weekend(trips_of):
    sunday = datetime(2024, 1, 14, 9)
    rows = [{"tpep_pickup_datetime": sunday + timedelta(days=i)} for i in range(7)]
    got = sorted(
        (r.day_of_week, r.day_name, r.is_weekend) for r in enrich(trips_of(*rows)).collect()
    )
    assert [d for _, d, _ in got] == list(ENGLISH.days)
    assert [w for _, _, w in got] == [True] + [False] * 5 + [True]


@pytest.mark.parametrize(
    "code, label",
    [(1, "Credit card"), (2, "Cash"), (5, "Unknown"), (6, "Voided"), (0, "Voided"), (None, "Voided")],
)
def test_payment_labels(trips_of, code, label):
    assert enrich(trips_of({"payment_type": code})).first().payment_type_label == label


def test_wording_changes_texts_only(trips_of):
    trips = trips_of({}, {"trip_distance": 40.0, "minutes": 60})
    english, french = enrich(trips, ENGLISH).collect(), enrich(trips, FRENCH).collect()
    assert [r.trip_category for r in french] == ["Court (3-10 km)", "Très long (> 50 km)"]
    assert french[0].payment_type_label == "Carte de crédit"
    assert [r.average_speed_kmh for r in english] == [r.average_speed_kmh for r in french]


def test_band_edges_belong_to_the_upper_band(spark):
    bands = Bands((3, 10), ("low", "mid", "high"))
    df = spark.sql("SELECT * FROM VALUES (2.99D), (3.0D), (9.99D), (10.0D), (CAST(NULL AS DOUBLE)) t(x)")
    got = df.select(banded(F.col("x"), bands), band_order(F.col("x"), bands)).collect()
    assert [r[0] for r in got] == ["low", "mid", "mid", "high", "high"]
    assert [r[1] for r in got] == [0, 1, 1, 2, 2]


def test_bands_must_fit():
    with pytest.raises(ValueError):
        Bands((1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        Bands((2, 1), ("a", "b", "c"))


def test_buckets(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-17 15:35:14'), "
        "(TIMESTAMP_NTZ'2024-01-15 08:34:59'), (TIMESTAMP_NTZ'2024-01-15 08:35:00'), "
        "(TIMESTAMP_NTZ'1969-12-31 23:59:59') t(ts)"
    )
    bucket = bucket_of(F.col("ts"), 5)
    got = df.select(bucket.alias("b"), bucket_start(bucket, 5).alias("s")).collect()
    assert [r.b for r in got] == [5685019, 5684358, 5684359, -1]
    assert got[0].s == datetime(2024, 1, 17, 15, 35)
    assert got[3].s == datetime(1969, 12, 31, 23, 55)


def test_session_zone_does_not_move_trips(spark, trips_of):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = enrich(trips_of({"tpep_pickup_datetime": datetime(2024, 3, 10, 2, 30)})).first()
        assert (row.hour, row.trip_duration_minutes) == (2, 10.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
