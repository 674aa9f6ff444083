"""Trip segments, earning efficiency and correlation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import banded
from tripweave.operators.grouping import OneRow, describe, top_rows

# The correlated features, the efficiency figures and the ranking's columns.
FEATURES = (
    "trip_distance_km",
    "fare_amount",
    "tip_amount",
    "trip_duration_minutes",
    "average_speed_kmh",
    "passenger_count",
)
EFFICIENCY = ("revenue_per_km", "revenue_per_minute", "efficiency_score")
TOP_COLUMNS = (
    "tpep_pickup_datetime",
    "trip_distance_km",
    "trip_duration_minutes",
    "fare_amount",
    *EFFICIENCY,
)


def categorize(trips: DataFrame, wording: L.Wording = L.ENGLISH) -> DataFrame:
    """Profile by length and pace, fare class and tip class."""
    km, minutes = F.col("trip_distance_km"), F.col("trip_duration_minutes")
    speed = F.col("average_speed_kmh")
    fast, slow, fluid, congested, other = wording.profiles
    near = F.when(minutes < L.PROFILE_MINUTES, fast).when(minutes >= L.PROFILE_MINUTES, slow)
    far = F.when(speed > L.PROFILE_KMH, fluid).when(speed <= L.PROFILE_KMH, congested)
    profile = F.when(km < L.PROFILE_KM, near).when(km >= L.PROFILE_KM, far)
    return trips.withColumns(
        {
            "trip_profile": F.coalesce(profile, F.lit(other)),
            "revenue_category": banded(F.col("fare_amount"), wording.revenue_bands),
            "tip_category": banded(F.col("tip_percentage"), wording.tip_bands),
        }
    )


def with_rush_hour(trips: DataFrame, hours: Sequence[int] = L.RUSH_HOURS) -> DataFrame:
    return trips.withColumn("is_rush_hour", F.col("hour").isin(*hours))


def efficiency(trips: DataFrame) -> DataFrame:
    """Fare per km, per minute, and per unit of distance and time combined."""
    km, minutes = F.col("trip_distance_km"), F.col("trip_duration_minutes")
    fare = F.col("fare_amount")
    effort = {
        "revenue_per_km": km,
        "revenue_per_minute": minutes,
        "efficiency_score": km + minutes / L.EFFICIENCY_MINUTES,
    }
    return trips.withColumns({name: F.try_divide(fare, by) for name, by in effort.items()})


def efficiency_stats(scored: DataFrame) -> DataFrame:
    return describe(scored, list(EFFICIENCY))


def efficiency_top(scored: DataFrame, n: int = 10) -> DataFrame:
    """Trips that earn most for their distance and time."""
    return top_rows(scored.select(*TOP_COLUMNS), [F.desc("efficiency_score")], n)


def correlation_matrix(trips: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return correlations(features).of(trips)


def correlations(features: Sequence[str] = FEATURES) -> OneRow:
    """Pearson matrix in long form (var_a, var_b, r) over rows with all features.

    All pairs come from one aggregate that leaves one row per partition to merge. A
    feature that never varies has no correlation: its pairs are null, where
    ``F.corr`` would stop on a division by zero.
    """
    value = {f: F.col(f).cast("double") for f in features}
    whole = reduce(and_, (c.isNotNull() & ~F.isnan(c) for c in value.values()))
    known = {f: F.when(whole, c) for f, c in value.items()}
    pairs = list(combinations(features, 2))
    parts = {f"std {f}": F.stddev_samp(known[f]) for f in features}
    parts |= {f"{a} {b}": F.covar_samp(known[a], known[b]) for a, b in pairs}
    cells = {
        (a, b): F.try_divide(F.col(f"`{a} {b}`"), F.col(f"`std {a}`") * F.col(f"`std {b}`"))
        for a, b in pairs
    }
    cells |= {(b, a): c for (a, b), c in cells.items()}
    cells |= {(f, f): F.lit(1.0) for f in features}
    entries = [
        F.struct(
            F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), cells[a, b].alias("r")
        )
        for a in features
        for b in features
    ]
    return OneRow(parts, lambda one: one.select(F.inline(F.array(*entries))))


def feature_vectors(trips: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with all features present, assembled into one ML vector column."""
    from pyspark.ml.feature import VectorAssembler

    known = trips.select(*features).dropna()
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(known)
