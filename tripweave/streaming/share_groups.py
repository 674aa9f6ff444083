"""Share groups of trips that are still arriving, by Structured Streaming.

Trips are read from a folder that grows, cleaned and enriched row by row, and folded into
share groups per bucket, origin and destination. A watermark follows the latest pickup at
a distance of ``late``: a group is given out, once and for good, when the watermark has
passed its bucket's end. A trip that arrives later than that is left out and counted in the
progress of its run. The state holds the groups of the buckets still open; trips are folded
before the shuffle, so a crowded group is one row per task and batch.

The sink is Parquet files with a checkpoint: a run that was broken off, or a new one on the
same checkpoint, goes on where the last one committed, so no group is lost or repeated.
On a cluster set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider
where open buckets do not fit into memory; the number of state partitions is the
``spark.sql.shuffle.partitions`` of the first run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import bucket_of
from tripweave.operators.cleaning import prepare
from tripweave.operators.sharing import candidates, measures, shareable
from tripweave.sources.schemas import TRIPS

PICKUP = "tpep_pickup_datetime"
LATE = "1 hour"


@dataclass(frozen=True)
class Run:
    """What one run has read, and how many folded rows came too late to count."""

    batches: int
    rows_read: int
    rows_too_late: int


def stream_groups(
    trips: DataFrame,
    minutes: int = L.BUCKET_MINUTES,
    at_least: int = L.MIN_GROUP,
    late: str = LATE,
) -> DataFrame:
    """Raw trips, streamed or not, to share groups with the columns of the batch operator.
    The watermark follows the short trips with both zones known."""
    # A watermark needs an instant; this one is free of the session's time zone.
    event = F.timestamp_seconds(F.unix_timestamp(PICKUP))
    short = candidates(prepare(trips)).withColumn("_event", event).withWatermark("_event", late)
    window = F.window("_event", f"{minutes} minutes")
    groups = short.groupBy(window.alias("_window"), "PULocationID", "DOLocationID").agg(*measures())
    start = F.col("_window.start")
    named = groups.select(
        bucket_of(start, minutes).alias("time_window"), *(c for c in groups.columns if c != "_window")
    )
    return shareable(named, at_least)


def append_groups(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    minutes: int = L.BUCKET_MINUTES,
    at_least: int = L.MIN_GROUP,
    late: str = LATE,
    files_per_batch: int | None = None,
) -> Run:
    """Work off all files of ``source`` that are new to the checkpoint and append the groups
    that became final to ``out``. Trips of one batch may be in any order; between batches
    they may be late by ``late`` at most, so limit ``files_per_batch`` only where files
    arrive in order."""
    reader = spark.readStream.schema(TRIPS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        stream_groups(reader.parquet(source), minutes, at_least, late)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    progress = query.recentProgress
    return Run(
        len({p["batchId"] for p in progress}),
        sum(p["numInputRows"] for p in progress),
        sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]),
    )


def final_groups(spark: SparkSession, out: str) -> DataFrame:
    """The groups given out so far."""
    return spark.read.parquet(out)
