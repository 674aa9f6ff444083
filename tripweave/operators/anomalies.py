"""Trips far from the mean distance, fare or speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import percent, rows
from tripweave.operators.grouping import OneRow, grouped, top_rows

SCORED = {
    "dist": "trip_distance_km",
    "fare": "fare_amount",
    "speed": "average_speed_kmh",
}
# The columns of the ranking.
TOP_COLUMNS = (
    "tpep_pickup_datetime",
    "trip_distance_km",
    "fare_amount",
    "average_speed_kmh",
    "trip_duration_minutes",
    "z_dist",
    "z_fare",
    "z_speed",
)


def base_figures() -> OneRow:
    """Mean and sample deviation of the scored columns, as one row."""
    parts = {}
    for short, source in SCORED.items():
        parts |= {f"mean_{short}": F.avg(source), f"std_{short}": F.stddev_samp(source)}
    return OneRow(parts)


def baseline(trips: DataFrame) -> DataFrame:
    return base_figures().of(trips)


def scores(
    trips: DataFrame, limit: float = L.Z_LIMIT, base: DataFrame | None = None
) -> DataFrame:
    """Absolute z-scores and the anomaly flag.

    The baseline enters as a scalar subquery: one extra aggregate, no join, and its
    six figures are constants inside the generated code. A column that never varies
    scores null rather than dividing by zero. A stored ``base`` saves the aggregate.
    """
    base = baseline(trips) if base is None else base
    known = base.select(F.struct(*base.columns)).scalar()
    z = {
        f"z_{short}": F.abs(
            F.try_divide(F.col(source) - known[f"mean_{short}"], known[f"std_{short}"])
        )
        for short, source in SCORED.items()
    }
    return trips.withColumns(z).withColumn("is_anomaly", _beyond(limit))


def _beyond(limit: float) -> Column:
    far = [F.col(f"z_{short}") > limit for short in SCORED]
    return far[0] | far[1] | far[2]


def anomalies(
    trips: DataFrame, limit: float = L.Z_LIMIT, base: DataFrame | None = None
) -> DataFrame:
    return scores(trips, limit, base).filter("is_anomaly")


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pct_anomalies", percent(F.col("n_anomalies"), F.col("n_trips")))


def rate(trips: DataFrame, limit: float = L.Z_LIMIT) -> DataFrame:
    flagged = F.count_if("is_anomaly").alias("n_anomalies")
    return _with_rate(scores(trips, limit).agg(rows().alias("n_trips"), flagged))


def rate_from_stored(flagged: DataFrame, by_time: DataFrame) -> DataFrame:
    """The same from stored anomalies and time totals."""
    n_trips = by_time.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    counts = flagged.agg(rows().alias("n_anomalies"))
    return _with_rate(counts.select(n_trips.alias("n_trips"), "n_anomalies"))


def top(flagged: DataFrame, n: int = 10) -> DataFrame:
    """Anomalies farthest from the mean distance."""
    return top_rows(flagged.select(*TOP_COLUMNS), [F.desc("z_dist")], n)


def types(
    flagged: DataFrame, limit: float = L.Z_LIMIT, wording: L.Wording = L.ENGLISH
) -> DataFrame:
    """Anomalies by the first score beyond the limit: distance, then fare, then speed."""
    *named, other = wording.anomaly_types
    kind = F.coalesce(
        *(
            F.when(F.col(f"z_{short}") > limit, F.lit(label))
            for short, label in zip(SCORED, named)
        ),
        F.lit(other),
    )
    return grouped(
        flagged.withColumn("anomaly_type", kind),
        ["anomaly_type"],
        {
            "avg_km": F.avg("trip_distance_km"),
            "avg_fare": F.avg("fare_amount"),
            "avg_speed": F.avg("average_speed_kmh"),
        },
        order=[F.desc("n"), F.asc("anomaly_type")],
    )
