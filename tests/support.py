"""Literal trips to test rules on."""

from __future__ import annotations

from datetime import datetime, timedelta

NOON = datetime(2024, 1, 17, 12, 0, 0)


def trip(**changes) -> dict:
    """A valid ten-minute card trip of two miles; ``minutes`` sets the dropoff."""
    minutes = changes.pop("minutes", 10)
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": NOON,
        "passenger_count": 1,
        "trip_distance": 2.0,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 1,
        "DOLocationID": 2,
        "payment_type": 1,
        "fare_amount": 10.0,
        "extra": 0.0,
        "mta_tax": 0.5,
        "tip_amount": 2.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 15.0,
        "congestion_surcharge": 2.5,
        "Airport_fee": 0.0,
    } | changes
    if "tpep_dropoff_datetime" not in row:
        row["tpep_dropoff_datetime"] = row["tpep_pickup_datetime"] + timedelta(minutes=minutes)
    return row
