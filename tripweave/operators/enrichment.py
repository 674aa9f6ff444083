"""The thirteen derived trip columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import banded, labelled, minutes_between
from tripweave.sources.schemas import PREPARED, TRIPS

DERIVED = tuple(f.name for f in PREPARED.fields if f.name not in TRIPS.names)


def calendar_labels(wording: L.Wording = L.ENGLISH) -> dict[str, Column]:
    """Columns that follow from ``day_of_week``, ``hour`` and ``payment_type`` alone."""
    day = F.col("day_of_week")
    return {
        "day_name": labelled(day, wording.days),
        "time_period": banded(F.col("hour"), wording.period_bands),
        "is_weekend": F.coalesce(day.isin(1, 7), F.lit(False)),
        "payment_type_label": labelled(F.col("payment_type"), wording.payments),
    }


def enrich(trips: DataFrame, wording: L.Wording = L.ENGLISH) -> DataFrame:
    """Add duration, metric distance, speed, calendar, tip and label columns.

    Columns that feed others come first, so the whole step is two projections and
    a report that reads three columns pays for those three only.
    """
    pickup = F.col("tpep_pickup_datetime")
    km, minutes = F.col("trip_distance_km"), F.col("trip_duration_minutes")
    fare = F.col("fare_amount")
    measured = trips.withColumns(
        {
            "trip_duration_minutes": minutes_between(pickup, F.col("tpep_dropoff_datetime")),
            "trip_distance_km": F.col("trip_distance") * L.KM_PER_MILE,
            "hour": F.hour(pickup),
            "day_of_week": F.dayofweek(pickup),
            "trip_date": F.to_date(pickup),
            "tip_percentage": F.when(fare > 0, F.col("tip_amount") / fare * 100).otherwise(0.0),
        }
    )
    named = measured.withColumns(
        {
            "average_speed_kmh": F.when(minutes > 0, km / minutes * 60).otherwise(0.0),
            "trip_category": banded(km, wording.category_bands),
            "is_short_trip": F.coalesce(km < L.SHORT_TRIP_KM, F.lit(False)),
        }
        | calendar_labels(wording)
    )
    return named.select(*trips.columns, *DERIVED)
