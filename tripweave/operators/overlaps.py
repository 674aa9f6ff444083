"""Interval overlap join: pairs of rows of equal keys whose time intervals overlap.

Two intervals [start, end) overlap just if the later start lies in the earlier interval. So
every interval is laid over the time bins it touches, every start lies in one bin, and a
pair meets in exactly one place: the bin of its later start. That is an equi-join on keys
and bin; nothing has to be made distinct afterwards and no condition is looped over.

What intervals are joined with are not single starts but runs of them: a row of arrays,
sorted by start, so a run that lies outside an interval is passed over as a whole. Pairs are
laid out from the arrays afterwards, so the join moves a row per interval and run and
not one per pair.

Bins are as wide as the mean interval, so an interval touches two bins or three. A bin of
more than ``piece`` starts is cut: its starts are dealt over pieces by hash and its
intervals are sent to each, so no task has to hold a hot bin's starts together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.timeline import micros
from tripweave.sources.writers import landed

#: Starts of a key and bin that stay together.
PIECE = 4096
#: Starts of a piece that are paired at once.
RUN = 256
#: Bins that one interval is laid over at most, on average.
SPREAD = 64


def bin_seconds(rows: DataFrame, start: str, end: str) -> int:
    """The mean length of the intervals, at least a second; wider where some are so long
    that they would touch too many bins in all."""
    length = F.unix_timestamp(end) - F.unix_timestamp(start)
    found = rows.agg(F.avg(length).alias("mean"), F.avg(length * length).alias("square")).first()
    if not found.mean or found.mean <= 0:
        return 1
    return max(1, int(found.mean), int((found.square**0.5) / SPREAD))


def overlapping_pairs(
    rows: DataFrame,
    on: Sequence[str],
    start: str,
    end: str,
    columns: Sequence[str],
    width: int | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """The keys, ``first_`` and ``second_`` of the given columns, and overlap_minutes, once
    for every two rows under way together. The first starts earlier (ties: ends earlier,
    then by the columns). Rows with a null in keys, start or end, and intervals that are
    empty or turned round, take no part; rows that repeat are rows of their own."""
    width = width or bin_seconds(rows, start, end)
    usable = rows.filter(F.col(start) < F.col(end)).dropna(subset=list(on))
    step = width * 1_000_000
    table = usable.select(
        *on,
        micros(F.col(start)).alias("_start"),
        micros(F.col(end)).alias("_end"),
        F.struct(*columns).alias("_row"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # Written, so its row numbers are the same on both sides of the join.
    table = landed(table, "intervals")
    first_bin = F.floor(F.col("_start") / step)
    starts = table.withColumn("_bin", first_bin)
    crowded = (
        starts.groupBy(*on, "_bin")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > piece)
        .select(*on, "_bin", F.ceil(F.col("_n") / piece).cast("int").alias("_pieces"))
    )
    deal = F.pmod(F.xxhash64("_id"), F.coalesce("_pieces", F.lit(1))).cast("int")
    places = [*on, "_bin", "_piece"]
    later = starts.join(crowded, [*on, "_bin"], "left").withColumn("_piece", deal)
    last_bin = F.floor((F.col("_end") - 1) / step)
    pieces = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    earlier = (
        table.withColumn("_bin", F.explode(F.sequence(first_bin, last_bin)))
        .join(crowded, [*on, "_bin"], "left")
        .withColumn("_piece", F.explode(pieces))
        .drop("_pieces")
    )
    near = (F.col("_least") < F.col("_end")) & (F.col("_most") >= F.col("_start"))
    # Written, or Spark would lay out the runs anew for each condition on them.
    runs = landed(_runs(later, places, columns), "runs")
    met = earlier.join(runs, places).filter(near)
    met = met.select("*", F.posexplode("_starts").alias("_place", "_later"))
    second = [F.get(f"_second_{i}", "_place") for i in range(len(columns))]
    until = F.get("_ends", "_place")
    row = F.struct(*(v.alias(c) for v, c in zip(second, columns)))
    tied = F.struct("_end", "_row", "_id") < F.struct(until, row, F.get("_ids", "_place"))
    in_order = (F.col("_later") > F.col("_start")) | ((F.col("_later") == F.col("_start")) & tied)
    shared = F.least("_end", until) - F.col("_later")
    return met.filter((F.col("_later") < F.col("_end")) & in_order).select(
        *on,
        *(F.col("_row").getField(c).alias(f"first_{c}") for c in columns),
        *(v.alias(f"second_{c}") for v, c in zip(second, columns)),
        (shared / 60_000_000).alias("overlap_minutes"),
    )


def _runs(starts: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of each of ``keys`` in order, as arrays of ``RUN`` at most: _starts, _ends,
    _ids, and _second_0 and so on of the columns; with the _least and the _most start."""
    run = F.sort_array(F.collect_list(F.struct("_start", "_end", "_row", "_id")))
    runs = starts.groupBy(*keys).agg(run.alias("_run"))
    cut = F.explode(F.sequence(F.lit(1), F.size("_run"), F.lit(RUN)))
    parts = runs.withColumn("_cut", cut).withColumn("_run", F.slice("_run", F.col("_cut"), F.lit(RUN)))
    return parts.select(
        *keys,
        F.element_at("_run._start", 1).alias("_least"),
        F.element_at("_run._start", -1).alias("_most"),
        F.col("_run._start").alias("_starts"),
        F.col("_run._end").alias("_ends"),
        F.col("_run._id").alias("_ids"),
        *(F.col("_run._row").getField(c).alias(f"_second_{i}") for i, c in enumerate(columns)),
    )
