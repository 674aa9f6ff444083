"""Registered queries beyond the reports: streams, as-of and overlap joins, sweeps,
sessions, sketches, exact quantiles, runs, snapshots, axes and JSON fields."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators import (
    asof,
    axes,
    concurrency,
    overlaps,
    quantiles,
    runs,
    semistructured,
    sessions,
    sketches,
    snapshots,
)
from tripweave.operators.segments import FEATURES
from tripweave.sources.writers import landed, shared_folder
from tripweave.streaming import share_groups

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
SLICES = 4
LATE_MINUTES = 50
SNAPSHOT_COLUMNS = (PICKUP, "PULocationID", "DOLocationID", "passenger_count", "payment_type", "fare_amount")


def arrivals(rows: DataFrame, time: str, late: Column, folder: str):
    """Append ``rows`` to a folder in ``SLICES`` steps by the time they arrive, some of them
    late, and yield after each, as a feed would fill it."""
    arrived = rows.withColumn("_arrived", F.timestamp_add("MINUTE", F.when(late, LATE_MINUTES).otherwise(0), time))
    span = arrived.agg(F.min("_arrived").alias("low"), F.max("_arrived").alias("high")).first()
    if span.low is None:
        rows.limit(0).write.parquet(folder)
        yield
        return
    step = (span.high - span.low) / SLICES + timedelta(microseconds=1)
    kind = rows.schema[time].dataType
    for i in range(SLICES):
        low, high = (F.lit(span.low + step * k).cast(kind) for k in (i, i + 1))
        part = arrived.filter((F.col("_arrived") >= low) & (F.col("_arrived") < high))
        part.drop("_arrived").write.mode("append").parquet(folder)
        yield


def stream_share_groups(raw: DataFrame) -> DataFrame:
    """Trips arrive in files, one of ten 50 minutes late; a run after each batch of files
    goes on from the checkpoint of the one before."""
    spark, base = raw.sparkSession, shared_folder(raw.sparkSession)
    late = F.pmod(F.xxhash64(PICKUP, "fare_amount"), F.lit(10)) == 0
    for _ in arrivals(raw, PICKUP, late, f"{base}/arrived"):
        share_groups.append_groups(spark, f"{base}/arrived", f"{base}/groups", f"{base}/checkpoint")
    return share_groups.final_groups(spark, f"{base}/groups")


def session_gap() -> Column:
    """A purchase keeps a session open for two days, anything else for one."""
    return F.when(F.col("event_type") == "purchase", 172_800).otherwise(86_400)


def user_sessions(events: DataFrame) -> DataFrame:
    return sessions.sessions(events, ["user_id"], "ts", session_gap(), "value")


def stream_user_sessions(events: DataFrame) -> DataFrame:
    spark, base = events.sparkSession, shared_folder(events.sparkSession)
    for _ in arrivals(events, "ts", F.col("event_id") % 10 == 0, f"{base}/arrived"):
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/arrived")
        found = sessions.streamed_sessions(stream, ["user_id"], "ts", session_gap(), "value", "1 hour")
        found.writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", f"{base}/checkpoint"
        ).trigger(availableNow=True).start(f"{base}/sessions").awaitTermination()
    return spark.read.parquet(f"{base}/sessions")


def _zone_events(events: DataFrame) -> DataFrame:
    """Events at zones; zone 12 has about half of them."""
    zone = F.least(F.col("user_id") % 25, F.lit(12)).cast("int")
    return events.select(zone.alias("PULocationID"), F.col("ts").alias("event_at"), "event_type", "event_id")


def last_event(trips: DataFrame, events: DataFrame, **options) -> DataFrame:
    """Each trip with the latest event at its pickup zone before it starts."""
    left = trips.select(PICKUP, "PULocationID", "fare_amount")
    columns = ["event_at", "event_type", "event_id"]
    return asof.asof_join(left, _zone_events(events), ["PULocationID"], PICKUP, "event_at", columns, **options)


def overlaps_by_route(trips: DataFrame) -> DataFrame:
    """Pairs of trips under way together between the same two zones."""
    pairs = overlaps.overlapping_pairs(trips, ["PULocationID", "DOLocationID"], PICKUP, DROPOFF, ["fare_amount"])
    return pairs.groupBy("PULocationID", "DOLocationID").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg("overlap_minutes").alias("avg_overlap"),
        F.max("overlap_minutes").alias("max_overlap"),
        F.avg(F.abs(F.col("first_fare_amount") - F.col("second_fare_amount"))).alias("avg_fare_gap"),
    )


def zone_peaks(trips: DataFrame) -> DataFrame:
    keys = ["PULocationID"]
    return concurrency.peaks(concurrency.under_way(trips, keys, PICKUP, DROPOFF), keys)


def overall_peak(trips: DataFrame) -> DataFrame:
    return concurrency.peaks(concurrency.under_way(trips, [], PICKUP, DROPOFF), [])


def sketched_weeks(trips: DataFrame) -> DataFrame:
    """Weeks from stored days, beside the exact figures and whether they lie in the bounds."""
    cents = F.floor(F.col("fare_amount") * 100)
    days = landed(sketches.by_day(trips, "trip_date", cents, F.col("fare_amount")), "days")
    week = F.weekofyear("trip_date")
    merged = landed(sketches.over(days, [week.alias("week")], {"median": 0.5}), "weeks")
    seen = trips.select(week.alias("week"), cents.alias("cents"), "fare_amount").join(merged, "week")
    fare, middle = F.col("fare_amount"), F.col("median")
    exact = seen.groupBy("week").agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count_distinct("cents").alias("exact_distinct"),
        F.avg((fare < middle).cast("double")).alias("_below"),
        F.avg((fare <= middle).cast("double")).alias("_upto"),
    )
    bound = sketches.RANK_BOUND
    return exact.join(merged, "week").select(
        "week",
        "n",
        "n_trips",
        "exact_distinct",
        sketches.within(F.col("n_distinct"), F.col("exact_distinct")).alias("distinct_within"),
        ((F.col("_below") <= 0.5 + bound) & (F.col("_upto") >= 0.5 - bound)).alias("median_within"),
    )


def fare_quantiles(trips: DataFrame) -> DataFrame:
    wanted = {"q25": 0.25, "q50": 0.5, "q90": 0.9}
    return quantiles.exact_quantiles(trips, ["PULocationID"], F.col("fare_amount"), wanted)


def robust_fares(trips: DataFrame) -> DataFrame:
    return quantiles.robust_outliers(trips, ["PULocationID"], "fare_amount")


def zone_rises(trips: DataFrame) -> DataFrame:
    keys = ["PULocationID"]
    return runs.longest_rises(runs.daily_counts(trips, keys, "trip_date"), keys, "trip_date")


def route_gaps(trips: DataFrame) -> DataFrame:
    keys = ["PULocationID", "DOLocationID"]
    return runs.gaps(runs.daily_counts(trips, keys, "trip_date"), keys, "trip_date")


def snapshots_of(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips before and after some of them were removed, corrected and entered twice."""
    before = raw.select(*SNAPSHOT_COLUMNS)
    gone = (F.col("passenger_count") == 3) & (F.col("payment_type") == 2)
    fare = F.col("fare_amount") + F.when(F.col("passenger_count") == 5, 1.0).otherwise(0.0)
    kept = before.filter(~F.coalesce(gone, F.lit(False))).withColumn("fare_amount", fare)
    return before, kept.unionByName(kept.filter("payment_type = 4"))


def snapshot_changes(raw: DataFrame) -> DataFrame:
    return snapshots.key_changes(*snapshots_of(raw), [PICKUP, "PULocationID"])


def scaled_features(trips: DataFrame) -> DataFrame:
    return axes.scaled(trips, FEATURES).select(*(f"scaled_{f}" for f in FEATURES))


def _texts(events: DataFrame) -> DataFrame:
    """Properties as a careless feed sends them: some cut short, some missing."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    text = F.when(F.col("event_id") % 11 == 0, F.lit(None)).when(F.col("event_id") % 7 == 0, cut)
    return events.select("event_id", text.otherwise(F.col("props")).alias("props"))


def props_fields(events: DataFrame) -> DataFrame:
    return semistructured.fields(_texts(events), "props", {"k": ("$.k", "int"), "other": ("$.other", "string")})


def props_report(events: DataFrame) -> DataFrame:
    return semistructured.report(_texts(events), "props")


ROW_LEVEL = {
    "asof_last_event": lambda t: last_event(t.trips, t.events),
    "asof_event_within_hour": lambda t: last_event(
        t.trips, t.events, within_seconds=3600, inner=True, strict=True
    ),
    "under_way_by_zone": lambda t: concurrency.under_way(t.trips, ["PULocationID"], PICKUP, DROPOFF),
    "under_way_zone_peaks": lambda t: zone_peaks(t.trips),
    "under_way_peak": lambda t: overall_peak(t.trips),
    "zone_longest_rises": lambda t: zone_rises(t.trips),
    "route_gaps": lambda t: route_gaps(t.trips),
    "snapshot_changes": lambda t: snapshot_changes(t.raw),
    "snapshot_summary": lambda t: snapshots.summary(snapshot_changes(t.raw)),
    "props_fields": lambda t: props_fields(t.events),
    "props_report": lambda t: props_report(t.events),
    "sketched_weeks": lambda t: sketched_weeks(t.trips),
}

AGGREGATED = {
    "stream_share_groups": lambda t: stream_share_groups(t.raw),
    "user_sessions": lambda t: user_sessions(t.events),
    "stream_user_sessions": lambda t: stream_user_sessions(t.events),
    "overlaps_by_route": lambda t: overlaps_by_route(t.trips),
    "fare_quantiles_by_zone": lambda t: fare_quantiles(t.trips),
    "robust_fares_by_zone": lambda t: robust_fares(t.trips),
    "scaled_features": lambda t: scaled_features(t.trips),
    "principal_axes": lambda t: axes.axis_table(t.trips),
}

#: SQL has no eigenvectors; tests compare this one with a plain computation.
WITHOUT_SQL = {"principal_axes"}
