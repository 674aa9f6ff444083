"""Which trips count as valid, before and after enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import percent, rows
from tripweave.operators.enrichment import enrich
from tripweave.operators.grouping import OneRow


def is_valid() -> Column:
    """Raw-column rule. Columns stay un-cast, so Parquet scans can use the bounds;
    a null in any compared column makes the rule null and the row is dropped."""

    def inside(name: str, top: float) -> Column:
        return (F.col(name) > 0) & (F.col(name) < top)

    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return (
        inside("trip_distance", L.MAX_DISTANCE_MILES)
        & inside("fare_amount", L.MAX_FARE)
        & inside("total_amount", L.MAX_TOTAL)
        & (F.col("passenger_count") > 0)
        & (F.col("passenger_count") <= L.MAX_PASSENGERS)
        & pickup.isNotNull()
        & dropoff.isNotNull()
        & (dropoff > pickup)
    )


def is_plausible() -> Column:
    """Rule on derived columns: a believable speed and duration."""
    speed, minutes = F.col("average_speed_kmh"), F.col("trip_duration_minutes")
    return speed.between(0, L.MAX_SPEED_KMH) & (minutes > 0) & (minutes < L.MAX_MINUTES)


def clean(trips: DataFrame) -> DataFrame:
    return trips.filter(is_valid())


def plausible(enriched: DataFrame) -> DataFrame:
    return enriched.filter(is_plausible())


def prepare(trips: DataFrame, wording: L.Wording = L.ENGLISH) -> DataFrame:
    """Raw trips to the table all analyses read."""
    return plausible(enrich(clean(trips), wording))


def validity() -> OneRow:
    """Rows in, kept and removed by each rule, over enriched trips."""
    parts = {
        "n_raw": rows(),
        "n_valid": F.count_if(is_valid()),
        "n_final": F.count_if(is_valid() & is_plausible()),
    }
    removed = F.col("n_raw") - F.col("n_valid")
    return OneRow(
        parts,
        lambda one: one.withColumn("n_removed", removed).withColumn(
            "pct_removed", percent(F.col("n_removed"), F.col("n_raw"))
        ),
    )


def clean_report(trips: DataFrame) -> DataFrame:
    """The counts of ``validity`` in one pass over raw trips."""
    return validity().of(enrich(trips))
