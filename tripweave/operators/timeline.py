"""Work along a time axis, cut into slices so that no key is one window in one task.

A slice is a numbered stretch of ``width`` seconds. What a slice hands on to the next one
(a last value, a sum) is folded per key and slice first, before any shuffle, and carried
forward over these folded rows; rows themselves only meet rows of their own slice. A key
with half of all rows is so spread over as many tasks as it has slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a slice of the busiest key holds on average.
SLICE_ROWS = 50_000
#: Slices that the time covered is cut into at most, so carried rows are few per key.
MOST_SLICES = 20_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970, free of any session time zone where the column is."""
    fraction = F.date_part(F.lit("SECOND"), ts) % 1 * 1_000_000
    return F.unix_timestamp(ts) * 1_000_000 + fraction.cast("long")


def slice_of(ts: Column, width: int) -> Column:
    return F.floor(micros(ts) / (width * 1_000_000))


def slice_width(rows: DataFrame, keys: Sequence[str], time: str, at_most: int = SLICE_ROWS) -> int:
    """Seconds of a slice, so that the busiest key has about ``at_most`` rows in one: from
    its count and the time covered, folded before the shuffle."""
    per_key = rows.groupBy(*keys).agg(
        F.count(time).alias("n"), F.min(time).alias("low"), F.max(time).alias("high")
    )
    span = F.unix_timestamp(F.max("high")) - F.unix_timestamp(F.min("low"))
    found = per_key.agg(F.max("n").alias("n"), span.alias("span")).first()
    if not found.n or not found.span:
        return 1
    wanted = min(-(-found.n // at_most), MOST_SLICES)
    return max(1, -(-(found.span + 1) // wanted))


def carried(folded: DataFrame, keys: Sequence[str], slice_col: str, value: Column, name: str) -> DataFrame:
    """``folded`` (a row per key and slice) with what all earlier slices of the key hand on.
    ``value`` is an aggregate; the window holds slices, ``MOST_SLICES`` a key at most where
    the width comes from the data, and not rows."""
    before = Window.partitionBy(*keys).orderBy(slice_col)
    return folded.withColumn(name, value.over(before.rowsBetween(Window.unboundedPreceding, -1)))
