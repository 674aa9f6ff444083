"""Zone names on trips, and rankings by zone and borough.

The rankings aggregate by zone id before they look up names: what meets the zone
table is one row per id, not one per trip. A busy zone is folded by map-side
partial aggregation, and no row-level join is left that could skew.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import percent
from tripweave.operators.grouping import with_share
from tripweave.operators.totals import merged_count, merged_mean, totals

ENDS = {"pickup": "PULocationID", "dropoff": "DOLocationID"}
MEASURED = ("fare_amount", "trip_distance_km", "trip_duration_minutes")


def _names(zones: DataFrame, end: str) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias(ENDS[end]),
        F.col("Borough").alias(f"{end}_borough"),
        F.col("Zone").alias(f"{end}_zone"),
    )


def join_zone(trips: DataFrame, zones: DataFrame, end: str) -> DataFrame:
    """Borough and zone name of one trip end; unknown ids keep the trip with nulls.
    No hint: Spark broadcasts the zone table when its measured size allows, and
    otherwise joins by shuffle with skewed ids split."""
    return trips.join(_names(zones, end), ENDS[end], "left")


def join_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return join_zone(join_zone(trips, zones, "pickup"), zones, "dropoff")


def zone_totals(
    trips: DataFrame,
    ends: Iterable[str] = tuple(ENDS),
    columns: Iterable[str] = MEASURED,
    by_hour: bool = False,
) -> DataFrame:
    """Mergeable totals per zone id of the given ends, apart for short and long trips.
    With the defaults, one stored table that answers every ranking below. ``by_hour``
    keeps the hour and the vendor-stamped trips too."""
    keys = [*(ENDS[e] for e in ends), "is_short_trip"]
    if not by_hour:
        return totals(trips, keys, columns)
    stamped = F.count("VendorID").alias("n_vendor")
    return totals(trips, [*keys, "hour"], columns, stamped)


def by_names(
    trips: DataFrame,
    zones: DataFrame,
    ends: tuple[str, ...],
    names: tuple[str, ...],
    means: Mapping[str, str],
    folded: bool = False,
) -> DataFrame:
    """Count and means per zone names: totals per id first, then names, then a merge
    (several ids may share one name). With ``folded``, here and below, ``trips`` are
    stored ``zone_totals``."""
    out = trips if folded else zone_totals(trips, ends, means.values())
    for end in ends:
        out = join_zone(out, zones, end)
    return out.groupBy(*names).agg(
        merged_count().alias("n"), *(merged_mean(c).alias(m) for m, c in means.items())
    )


def match_rate(trips: DataFrame, zones: DataFrame, folded: bool = False) -> DataFrame:
    """Trips whose both ends are in the zone table."""
    pairs = trips if folded else zone_totals(trips, columns=())
    found = F.col("pickup_zone").isNotNull() & F.col("dropoff_zone").isNotNull()
    return (
        join_zones(pairs, zones)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_trips"),
            F.coalesce(F.sum(F.when(found, F.col("n"))), F.lit(0)).alias("n_matched"),
        )
        .withColumn("pct_matched", percent(F.col("n_matched"), F.col("n_trips")))
    )


def top_zones(
    trips: DataFrame,
    zones: DataFrame,
    end: str,
    n: int = 20,
    means: Mapping[str, str] | None = None,
    folded: bool = False,
) -> DataFrame:
    """Busiest named zones of one trip end."""
    if means is None:
        means = {"avg_fare": "fare_amount", "avg_km": "trip_distance_km"}
    borough, zone = f"{end}_borough", f"{end}_zone"
    return (
        by_names(trips, zones, (end,), (borough, zone), means, folded)
        .filter(F.col(zone).isNotNull())
        .orderBy(F.desc("n"), borough, zone)
        .limit(n)
    )


def top_zones_by_length(
    trips: DataFrame, zones: DataFrame, end: str, short: bool, n: int = 3, folded: bool = False
) -> DataFrame:
    return top_zones(trips.filter(F.col("is_short_trip") == short), zones, end, n, {}, folded)


def borough_stats(
    trips: DataFrame, zones: DataFrame, end: str, folded: bool = False
) -> DataFrame:
    """Trips, mean fare and percentage of all trips per borough; trips without a
    known zone count in the total only."""
    borough = f"{end}_borough"
    groups = by_names(trips, zones, (end,), (borough,), {"avg_fare": "fare_amount"}, folded)
    return with_share(groups).filter(F.col(borough).isNotNull()).orderBy(F.desc("n"), borough)


def borough_flows(
    trips: DataFrame, zones: DataFrame, n: int = 10, folded: bool = False
) -> DataFrame:
    """Busiest borough-to-borough flows, within-borough trips included."""
    names = ("pickup_borough", "dropoff_borough")
    means = {"avg_fare": "fare_amount", "avg_minutes": "trip_duration_minutes"}
    return (
        by_names(trips, zones, ("pickup", "dropoff"), names, means, folded)
        .dropna(subset=list(names))
        .orderBy(F.desc("n"), *names)
        .limit(n)
    )


def all_rankings(totals_table: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    """Every zone table, from stored ``zone_totals``."""
    out = {
        "zone_match_rate": match_rate(totals_table, zones, folded=True),
        "borough_flows": borough_flows(totals_table, zones, folded=True),
    }
    for end in ENDS:
        out[f"top_{end}_zones"] = top_zones(totals_table, zones, end, folded=True)
        out[f"{end}_borough_stats"] = borough_stats(totals_table, zones, end, folded=True)
        for name, short in (("short", True), ("long", False)):
            ranked = top_zones_by_length(totals_table, zones, end, short, folded=True)
            out[f"{name}_top_{end}"] = ranked
    return out
