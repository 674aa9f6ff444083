"""Ride sharing: short trips that start in the same few minutes between the same
two zones, and what sharing them would save.

``trip_groups`` is the only shuffle of trips here. Its partial aggregation folds a
crowded (bucket, origin, destination) before the shuffle, so one hot key costs one
row per map task. Everything later works on groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import (
    bucket_of,
    bucket_start,
    minutes_between,
    percent,
    rows,
)
from tripweave.operators.grouping import describe, stacked, top_rows

GROUP_KEYS = ("time_window", "PULocationID", "DOLocationID")
# The columns of a candidate.
CANDIDATE_COLUMNS = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance_km",
    "fare_amount",
    "trip_duration_minutes",
    "passenger_count",
)


def _check_width(minutes: int, nested_in: int | None = None) -> None:
    if minutes <= 0:
        raise ValueError("a bucket is at least a minute wide")
    if nested_in and nested_in % minutes:
        raise ValueError(f"buckets of {minutes} minutes do not nest in {nested_in} minutes")


def _is_candidate() -> Column:
    return (
        F.col("is_short_trip")
        & F.col("PULocationID").isNotNull()
        & F.col("DOLocationID").isNotNull()
    )


def candidates(trips: DataFrame) -> DataFrame:
    """Short trips with both zone ids known."""
    return trips.filter(_is_candidate()).select(*CANDIDATE_COLUMNS)


def candidate_rate(trips: DataFrame) -> DataFrame:
    return _with_rate(
        trips.agg(rows().alias("n_trips"), F.count_if(_is_candidate()).alias("n_candidates"))
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("pct_candidates", percent(F.col("n_candidates"), F.col("n_trips")))


def candidate_rate_from_zones(zone_totals: DataFrame) -> DataFrame:
    """The same from totals that keep both zone ids and the length flag."""
    counts = zone_totals.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_trips"),
        F.coalesce(F.sum(F.when(_is_candidate(), F.col("n"))), F.lit(0)).alias("n_candidates"),
    )
    return _with_rate(counts)


def time_buckets(short_trips: DataFrame, minutes: int = L.BUCKET_MINUTES) -> DataFrame:
    """Number and start of the interval each pickup falls in."""
    _check_width(minutes)
    bucket = bucket_of(F.col("tpep_pickup_datetime"), minutes)
    return short_trips.withColumn("time_window", bucket).withColumn(
        "window_start", bucket_start(F.col("time_window"), minutes)
    )


def trip_groups(short_trips: DataFrame, minutes: int = L.BUCKET_MINUTES) -> DataFrame:
    """Trips folded by bucket, origin and destination, single trips included."""
    return time_buckets(short_trips, minutes).groupBy(*GROUP_KEYS).agg(*measures())


def measures() -> list[Column]:
    """What is kept of a group of trips."""
    pickup = F.col("tpep_pickup_datetime")
    return [
        rows().alias("n_trips"),
        F.avg("trip_distance_km").alias("avg_km"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_duration_minutes").alias("avg_minutes"),
        F.sum("passenger_count").alias("total_passengers"),
        F.min(pickup).alias("first_pickup"),
        F.max(pickup).alias("last_pickup"),
    ]


def shareable(groups: DataFrame, at_least: int = L.MIN_GROUP) -> DataFrame:
    """Groups large enough to share, with the time between first and last pickup."""
    spread = minutes_between(F.col("first_pickup"), F.col("last_pickup"))
    return groups.filter(F.col("n_trips") >= at_least).withColumn("spread_minutes", spread)


def share_groups(
    trips: DataFrame, minutes: int = L.BUCKET_MINUTES, at_least: int = L.MIN_GROUP
) -> DataFrame:
    return shareable(trip_groups(candidates(trips), minutes), at_least)


def group_stats(groups: DataFrame) -> DataFrame:
    return describe(groups, ["n_trips", "avg_km", "avg_fare", "avg_minutes", "spread_minutes"])


def top_groups(groups: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(groups, [F.desc("n_trips")], n)


def top_origins(groups: DataFrame, n: int = 10) -> DataFrame:
    return (
        groups.groupBy("PULocationID")
        .agg(
            F.sum("n_trips").alias("n_trips"),
            rows().alias("n_groups"),
            F.avg("n_trips").alias("avg_trips"),
        )
        .orderBy(F.desc("n_trips"), "PULocationID")
        .limit(n)
    )


def _cars(riders: int) -> Column:
    """Cars that carry a group's trips when each car takes ``riders`` of them."""
    return F.ceil(F.col("n_trips") / riders)


def savings(groups: DataFrame, riders: int = 2, detour: float = L.DETOUR_FACTOR) -> DataFrame:
    """Trips, money and minutes saved per group when ``riders`` trips share a car
    and each shared trip costs ``detour`` times the mean fare."""
    n, fare = F.col("n_trips"), F.col("avg_fare")
    sized = groups.withColumns(
        {
            "individual_trips": n,
            "shared_trips": _cars(riders).cast("int"),
            "current_cost": n * fare,
        }
    ).withColumns(
        {
            "saved_trips": n - F.col("shared_trips"),
            "shared_cost": F.col("shared_trips") * fare * detour,
        }
    )
    money = F.col("current_cost") - F.col("shared_cost")
    return sized.withColumns(
        {
            "money_saved": money,
            "money_saved_pct": F.try_divide(money, F.col("current_cost")) * 100,
            "minutes_saved": F.col("saved_trips") * F.col("avg_minutes"),
        }
    )


def savings_total(
    all_groups: DataFrame,
    at_least: int = L.MIN_GROUP,
    riders: int = 2,
    detour: float = L.DETOUR_FACTOR,
    n_candidates: Column | None = None,
) -> DataFrame:
    """Totals over shareable groups. Takes the groups of every size, so the number
    of candidate trips comes from the same pass as the savings; with ``n_candidates``
    known, the shareable groups suffice."""
    counted = F.col("n_trips") >= at_least

    def total(name: str) -> Column:
        return F.sum(F.when(counted, F.col(name)))

    summed = savings(all_groups, riders, detour).agg(
        F.count_if(counted).alias("n_groups"),
        F.sum("n_trips").alias("n_candidates"),
        total("saved_trips").alias("saved_trips"),
        total("money_saved").alias("money_saved"),
        total("minutes_saved").alias("minutes_saved"),
    )
    if n_candidates is not None:
        summed = summed.withColumn("n_candidates", n_candidates)
    return (
        summed.withColumn("hours_saved", F.col("minutes_saved") / 60)
        .withColumn("reduction_pct", percent(F.col("saved_trips"), F.col("n_candidates")))
    )


# The columns of the savings ranking.
SAVINGS_COLUMNS = (
    "PULocationID",
    "DOLocationID",
    "n_trips",
    "shared_trips",
    "saved_trips",
    "money_saved",
    "money_saved_pct",
    "minutes_saved",
)


def top_savings(group_savings: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(group_savings.select(*SAVINGS_COLUMNS), [F.desc("money_saved")], n)


def by_hour(groups: DataFrame, minutes: int = L.BUCKET_MINUTES) -> DataFrame:
    """Groups and trips per hour. Buckets must nest in hours, so that any pickup of a
    group tells its hour and the groups need not be formed again."""
    _check_width(minutes, nested_in=60)
    return (
        groups.groupBy(F.hour("first_pickup").alias("hour"))
        .agg(
            rows().alias("n_groups"),
            F.sum("n_trips").alias("n_trips"),
            F.avg("n_trips").alias("avg_trips"),
        )
        .orderBy("hour")
    )


def by_day(groups: DataFrame, minutes: int = L.BUCKET_MINUTES) -> DataFrame:
    """Groups and trips per day of the week; buckets must nest in days."""
    _check_width(minutes, nested_in=1440)
    return (
        groups.groupBy(F.dayofweek("first_pickup").alias("day_of_week"))
        .agg(rows().alias("n_groups"), F.sum("n_trips").alias("n_trips"))
        .orderBy("day_of_week")
    )


def scenarios(
    groups: DataFrame,
    riders: Sequence[int] = L.RIDERS_PER_CAR,
    wording: L.Wording = L.ENGLISH,
) -> DataFrame:
    """Trips and fares saved for several car sizes, all in one pass. No detour cost
    is charged here, unlike in ``savings``."""
    named = {}
    for k in riders:
        saved = F.col("n_trips") - _cars(k)
        named[f"by_{k}"] = F.struct(
            F.sum(saved).alias("saved_trips"),
            F.sum(saved * F.col("avg_fare")).alias("money_saved"),
            F.avg(saved).alias("avg_saved_trips"),
            F.lit(wording.scenario.format(k)).alias("scenario"),
        )
    return stacked(groups.agg(*(c.alias(a) for a, c in named.items())), list(named))
