"""Result tables shaped for charts and dashboards."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import percent, rows
from tripweave.operators import sharing
from tripweave.operators.totals import merged_count, merged_mean, merged_sum, totals
from tripweave.plans.reports import report


def peak_hours(hourly: DataFrame, n: int = 5) -> DataFrame:
    """Busiest rows of an hourly table."""
    return hourly.orderBy(F.desc("n"), "hour").limit(n)


def top15_zones(top20: DataFrame) -> DataFrame:
    """Fifteen busiest of the twenty stored pickup zones, ascending for bar charts."""
    names = ("pickup_borough", "pickup_zone")
    best = top20.orderBy(F.desc("n"), *names).limit(15)
    return best.orderBy(F.asc("n"), *(F.desc(c) for c in names))


def between_days(df: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Rows of a closed range of days; a bound that is not given does not limit. On a
    table stored by ``trip_date`` only the folders of these days are read."""
    if first is not None:
        df = df.filter(F.col("trip_date") >= F.lit(first))
    if last is not None:
        df = df.filter(F.col("trip_date") <= F.lit(last))
    return df


def payment_by_date_range(trips: DataFrame, first: date, last: date) -> DataFrame:
    return report(between_days(trips, first, last), "payment_by_date")


def top20_savings(group_savings: DataFrame) -> DataFrame:
    return sharing.top_rows(group_savings, [F.desc("money_saved")], 20)


def export_tables(
    results: Mapping[str, DataFrame], first: date | None = None, last: date | None = None
) -> dict[str, DataFrame]:
    """The six small chart inputs, shaped from stored results and sorted anew, since
    files keep no order."""
    kinds = [F.desc("n"), F.asc("payment_type_label")]
    by_date = between_days(results["payment_by_date"], first, last)
    return {
        "hourly_distribution": results["hourly_distribution"].orderBy("hour"),
        "top_pickup_zones": top15_zones(results["top_pickup_zones"]),
        "payment_distribution": results["payment_distribution"].orderBy(*kinds),
        "payment_by_date": by_date.orderBy("trip_date", *kinds),
        "ridesharing_hourly": results["share_by_hour"].orderBy("hour"),
        "savings_summary": top20_savings(results["share_savings"]),
    }


def payment_pivot(
    trips: DataFrame, wording: L.Wording = L.ENGLISH, count: Column | None = None
) -> DataFrame:
    """One row per day, one count column per payment label, zero where absent. Rows may
    be totals with a ``count`` of their own."""
    labels = list(wording.payments)
    return (
        trips.groupBy("trip_date")
        .pivot("payment_type_label", labels)
        .agg(rows() if count is None else count)
        .fillna(0, subset=labels)
        .orderBy("trip_date")
    )


def hourly_peak_zone(trips: DataFrame) -> DataFrame:
    """Vendor-stamped trips, mean distance and the count of the busiest single pickup
    zone, per hour."""
    stamped = F.count("VendorID").alias("n_vendor")
    return hourly_peak_from_totals(
        totals(trips, ["hour", "PULocationID"], ["trip_distance_km"], stamped)
    )


def hourly_peak_from_totals(folded: DataFrame) -> DataFrame:
    """The same from totals by hour, pickup zone and perhaps more."""
    by_zone = folded.groupBy("hour", "PULocationID").agg(
        merged_count().alias("n"),
        F.sum("n_vendor").alias("n_vendor"),
        merged_sum("trip_distance_km").alias("km"),
        F.sum("n_trip_distance_km").alias("n_km"),
    )
    known = F.when(F.col("PULocationID").isNotNull(), F.col("n"))
    return (
        by_zone.groupBy("hour")
        .agg(
            F.sum("n_vendor").alias("n"),
            F.coalesce(F.max(known), F.lit(0)).alias("max_zone_n"),
            F.try_divide(F.sum("km"), F.sum("n_km")).alias("avg_km"),
        )
        .orderBy("hour")
    )


def hourly_counts(trips: DataFrame) -> DataFrame:
    """Vendor-stamped trips, mean fare and mean speed per hour."""
    means = {"avg_fare": "fare_amount", "avg_speed": "average_speed_kmh"}
    return _stamped(trips, "hour", means).orderBy("hour")


def payment_counts(trips: DataFrame, folded: bool = False) -> DataFrame:
    """Vendor-stamped trips and mean total per payment label."""
    counted = _stamped(trips, "payment_type_label", {"avg_total": "total_amount"}, folded)
    return counted.orderBy(F.desc("n"), "payment_type_label")


def _stamped(
    trips: DataFrame, key: str, means: Mapping[str, str], folded: bool = False
) -> DataFrame:
    """Trips with a vendor, and means over all; ``folded``: from time totals."""
    n = F.sum("n_vendor") if folded else F.count("VendorID")
    mean = merged_mean if folded else F.avg
    return trips.groupBy(key).agg(n.alias("n"), *(mean(c).alias(m) for m, c in means.items()))


def category_ordered(
    trips: DataFrame, wording: L.Wording = L.ENGLISH, folded: bool = False
) -> DataFrame:
    """Distance categories in order of length, with their vendor-stamped trips; a
    category without trips stays, with count zero."""
    entries = [
        F.struct(F.lit(i).alias("band_order"), F.lit(label).alias("trip_category"))
        for i, label in enumerate(wording.categories)
    ]
    bands = trips.sparkSession.range(1).select(F.inline(F.array(*entries)))
    means = {"avg_fare": "fare_amount", "avg_km": "trip_distance_km"}
    found = _stamped(trips, "trip_category", means, folded)
    return bands.join(found, "trip_category", "left").fillna(0, ["n"]).orderBy("band_order")


def kpi_dashboard(trips: DataFrame, minutes: int = L.BUCKET_MINUTES) -> DataFrame:
    """Six headline figures in one row: two aggregates, one over trips by hour and
    one over share groups, met through scalar subqueries."""
    by_hour = trips.groupBy("hour").agg(
        rows().alias("n"), F.count_if(F.col("payment_type") == L.CARD).alias("card")
    )
    groups = sharing.trip_groups(sharing.candidates(trips), minutes)
    return _board(by_hour, sharing.savings_total(groups))


def kpi_from_totals(folded: DataFrame, total: DataFrame) -> DataFrame:
    """The same from time totals and the stored total of savings."""
    card = F.when(F.col("payment_type") == L.CARD, F.col("n"))
    by_hour = folded.groupBy("hour").agg(
        merged_count().alias("n"), F.coalesce(F.sum(card), F.lit(0)).alias("card")
    )
    return _board(by_hour, total)


def _board(by_hour: DataFrame, total: DataFrame) -> DataFrame:
    board = by_hour.agg(
        F.sum("n").alias("n_trips"),
        F.max_by("hour", F.struct("n", -F.col("hour"))).alias("peak_hour"),
        percent(F.sum("card"), F.sum("n")).alias("card_pct"),
    )
    shown = total.select(F.struct("n_groups", "money_saved", "reduction_pct")).scalar()
    return board.select(
        "n_trips",
        shown["n_groups"].alias("n_share_groups"),
        shown["money_saved"].alias("money_saved"),
        shown["reduction_pct"].alias("reduction_pct"),
        "peak_hour",
        "card_pct",
    )
