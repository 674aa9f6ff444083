"""Declared schemas, so no read spends a pass on inference."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Names and types of the public yellow-taxi trip record.
_TRIP_FIELDS = (
    ("VendorID", IntegerType()),
    ("tpep_pickup_datetime", TimestampNTZType()),
    ("tpep_dropoff_datetime", TimestampNTZType()),
    ("passenger_count", LongType()),
    ("trip_distance", DoubleType()),
    ("RatecodeID", LongType()),
    ("store_and_fwd_flag", StringType()),
    ("PULocationID", IntegerType()),
    ("DOLocationID", IntegerType()),
    ("payment_type", LongType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("Airport_fee", DoubleType()),
)
TRIPS = StructType([StructField(name, kind) for name, kind in _TRIP_FIELDS])

_DERIVED_FIELDS = (
    ("trip_duration_minutes", DoubleType()),
    ("trip_distance_km", DoubleType()),
    ("average_speed_kmh", DoubleType()),
    ("hour", IntegerType()),
    ("day_of_week", IntegerType()),
    ("day_name", StringType()),
    ("trip_date", DateType()),
    ("time_period", StringType()),
    ("tip_percentage", DoubleType()),
    ("trip_category", StringType()),
    ("is_short_trip", BooleanType()),
    ("payment_type_label", StringType()),
    ("is_weekend", BooleanType()),
)
PREPARED = StructType(
    TRIPS.fields + [StructField(name, kind) for name, kind in _DERIVED_FIELDS]
)

ZONES = StructType(
    [
        StructField("LocationID", IntegerType()),
        StructField("Borough", StringType()),
        StructField("Zone", StringType()),
        StructField("service_zone", StringType()),
    ]
)
