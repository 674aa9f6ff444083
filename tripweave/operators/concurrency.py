"""Trips under way at once: a sweep over starts and ends with a distributed prefix sum.

Starts count +1 and ends -1. They are folded per key and instant before the shuffle, so a
crowded minute is a few rows. Running sums are taken inside slices of time (``timeline``)
and lifted by what all earlier slices sum up to, carried over one row per key and slice. So
neither a hot key nor the total over all keys is a window in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.operators import timeline


def under_way(
    rows: DataFrame, keys: Sequence[str], start: str, end: str, width: int | None = None
) -> DataFrame:
    """keys, moment, under_way: the number of intervals [start, end) that hold each instant at
    which it changes or might. Null keys are a key. Rows with a null start or end, and
    intervals that are empty or turned round, count nowhere. With no keys, all in one."""
    usable = rows.filter(F.col(start) < F.col(end))
    steps = usable.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("moment"), F.lit(1).alias("step")),
                F.struct(F.col(end).alias("moment"), F.lit(-1).alias("step")),
            )
        ).alias("s"),
    ).select(*keys, "s.moment", "s.step")
    if width is None:
        width = timeline.slice_width(steps, keys, "moment")
    folded = steps.groupBy(*keys, "moment").agg(F.sum("step").alias("step"))
    sliced = folded.withColumn("_s", timeline.slice_of(F.col("moment"), width))
    per_slice = (
        steps.withColumn("_s", timeline.slice_of(F.col("moment"), width))
        .groupBy(*keys, "_s")
        .agg(F.sum("step").alias("_sum"))
    )
    lifted = timeline.carried(per_slice, keys, "_s", F.sum("_sum"), "_before").select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_s").alias("_slice"), "_before"
    )
    inside = Window.partitionBy(*keys, "_s").orderBy("moment")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col("_s") == F.col("_slice")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        sliced.withColumn("_inside", F.sum("step").over(inside))
        .join(lifted, same)
        .select(*keys, "moment", (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias("under_way"))
    )


def peaks(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, most, first_at: the most intervals under way at once and the first instant."""
    best = F.max_by("moment", F.struct("under_way", -timeline.micros(F.col("moment"))))
    return counts.groupBy(*keys).agg(F.max("under_way").alias("most"), best.alias("first_at"))
