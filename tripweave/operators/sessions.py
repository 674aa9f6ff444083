"""Sessions: runs of rows of a key that follow one another within a gap.

The gap may depend on the row: a row keeps its session open for ``gap`` seconds, and a later
row belongs to it if it comes no later than that. Rows are first folded into cells, the rows
of a key and gap that fall into the same stretch of that gap's length; these are one session
whatever lies between. So a key with half of all rows is reduced before any shuffle, to a
few cells per stretch of time, and Spark's session window merges cells, not rows.

A stream takes the same session window directly, with a watermark: its state holds open
sessions only, and a session is given out once the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.timeline import micros


def _usable(rows: DataFrame, keys: Sequence[str], time: str, gap: Column) -> DataFrame:
    known = rows.withColumn("_gap", gap.cast("long")).filter(F.col("_gap") > 0)
    return known.filter(F.col(time).isNotNull()).dropna(subset=list(keys))


def _interval(microseconds: Column) -> Column:
    return F.make_interval(secs=microseconds.cast("decimal(20,0)") / F.lit(1_000_000))


def _end(last: Column) -> Column:
    """The session's end as an aggregate: a filter on the window's own end would be pushed
    below the merging and take single rows out of their sessions."""
    return F.max(last + F.make_dt_interval(secs=F.col("_gap").cast("decimal(18,6)")))


def sessions(
    rows: DataFrame, keys: Sequence[str], time: str, gap: Column, value: str
) -> DataFrame:
    """keys, session_start, last_at, session_end (the last moment that another row could
    have joined), n_rows and total of ``value``. Rows with a null key or time, or without a
    positive gap, belong to no session; null values count as rows and add nothing."""
    usable = _usable(rows, keys, time, gap)
    cell = F.floor(micros(F.col(time)) / (F.col("_gap") * 1_000_000))
    cells = usable.groupBy(*keys, "_gap", cell.alias("_cell")).agg(
        F.min(time).alias("_first"),
        F.max(time).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(value).alias("_total"),
    )
    # A cell's own gap: from its first row to the last moment its last row waits for.
    open_for = micros(F.col("_last")) - micros(F.col("_first")) + F.col("_gap") * 1_000_000
    window = F.session_window("_first", _interval(open_for))
    merged = cells.groupBy(*keys, window.alias("_session")).agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("last_at"),
        F.sum("_n").alias("n_rows"),
        F.sum("_total").alias("total"),
        _end(F.col("_last")).alias("session_end"),
    )
    return merged.select(*keys, "session_start", "last_at", "session_end", "n_rows", "total")


def streamed_sessions(
    stream: DataFrame, keys: Sequence[str], time: str, gap: Column, value: str, late: str
) -> DataFrame:
    """The same of a stream; rows later than ``late`` behind the latest are left out, as are
    sessions that the watermark has not passed."""
    # A watermark needs an instant; this one is free of the session's time zone.
    event = F.timestamp_micros(micros(F.col(time)))
    marked = stream.withColumn("_event", event).withWatermark("_event", late)
    window = F.session_window("_event", _interval(F.col("_gap") * 1_000_000))
    return (
        _usable(marked, keys, time, gap)
        .groupBy(*keys, window.alias("_session"))
        .agg(
            F.min(time).alias("session_start"),
            F.max(time).alias("last_at"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(value).alias("total"),
            _end(F.col(time)).alias("session_end"),
        )
        .select(*keys, "session_start", "last_at", "session_end", "n_rows", "total")
    )
