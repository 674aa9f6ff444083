"""Runs and gaps of daily counts.

Trips are folded to one row per key and day before anything is ordered, so a window holds
the days of a key, never its trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_counts(rows: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """keys, day, n for the days that have rows; null days are left out."""
    dated = rows.filter(F.col(day).isNotNull())
    return dated.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n"))


def longest_rises(counts: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """keys, first_day, last_day, n_days, n_first, n_last: the longest stretch of days in a
    row on which the count rose each day (ties: the earliest). A single day is a stretch."""
    order = Window.partitionBy(*keys).orderBy(day)
    rises = (F.date_diff(day, F.lag(day).over(order)) == 1) & (F.col("n") > F.lag("n").over(order))
    breaks = F.when(F.coalesce(rises, F.lit(False)), 0).otherwise(1)
    islands = counts.withColumn("_break", breaks).withColumn("_run", F.sum("_break").over(order))
    runs = islands.groupBy(*keys, "_run").agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
        F.min("n").alias("n_first"),
        F.max("n").alias("n_last"),
    )
    best = Window.partitionBy(*keys).orderBy(F.desc("n_days"), "first_day")
    return runs.withColumn("_at", F.row_number().over(best)).filter("_at = 1").drop("_run", "_at")


def gaps(counts: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """keys, first_day, last_day, n_days: stretches without rows between a key's first and
    last day."""
    order = Window.partitionBy(*keys).orderBy(day)
    found = counts.withColumn("_next", F.lead(day).over(order)).filter(F.date_diff("_next", day) > 1)
    return found.select(
        *keys,
        F.date_add(day, 1).alias("first_day"),
        F.date_sub("_next", 1).alias("last_day"),
        (F.date_diff("_next", day) - 1).cast("long").alias("n_days"),
    )
