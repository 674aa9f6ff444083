"""As-of join: to every row of the left side the latest row of the right side that is not
later, among those of equal keys.

Both sides are put on one time axis (a union), cut into slices (``timeline``). Within a slice
a window finds the last right row up to each left row; where a slice has none yet, the last
row of the earlier slices stands in, carried over rows that are folded per key and slice. So
the join has no range condition to loop over, one shuffle of either side, and a key of half
of all rows is spread over the slices.

Of right rows at the same instant of a key the largest counts, compared by the right
columns in the order given. A right row at the very instant of a left row matches unless
``strict``. Left rows without a match, or with a null in time or keys, are kept with nulls
(dropped if ``inner``). Right rows with a null in time or keys match nothing. Rows that
repeat stay repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.operators import timeline


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    strict: bool = False,
    within_seconds: int | None = None,
    inner: bool = False,
    width: int | None = None,
) -> DataFrame:
    """All columns of ``left`` and ``columns`` of the matching right row; these must not
    share names with the left side. A match older than ``within_seconds`` does not count.
    ``width`` is the slices' width in seconds; None takes it from the data."""
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    keys = [f"_k{i}" for i in range(len(on))]
    keyed = {k: F.col(name) for k, name in zip(keys, on)}
    # One right row per key and instant: folded before the shuffle, so a crowd is one row.
    events = (
        right.filter(F.col(right_time).isNotNull())
        .dropna(subset=list(on))
        .select(
            *(c.alias(k) for k, c in keyed.items()),
            timeline.micros(F.col(right_time)).alias("_t"),
            F.struct(*columns).alias("_r"),
        )
        .groupBy(*keys, "_t")
        .agg(F.max("_r").alias("_r"))
    )
    rows = left.select(
        *(c.alias(k) for k, c in keyed.items()),
        timeline.micros(F.col(left_time)).alias("_t"),
        F.struct(*left.columns).alias("_l"),
    )
    lost = reduce(or_, (F.col(c).isNull() for c in ("_t", *keys)))
    if width is None:
        counted = left.select(*(c.alias(k) for k, c in keyed.items()), F.col(left_time).alias("_at"))
        width = timeline.slice_width(counted.dropna(), keys, "_at")
    piece = F.floor(F.col("_t") / (width * 1_000_000))
    # At one instant a right row comes first, unless a match must be earlier.
    both = (
        events.select(*keys, "_t", "_r", F.lit(None).cast(rows.schema["_l"].dataType).alias("_l"),
                      F.lit(1 if strict else 0).alias("_side"))
        .unionByName(rows.filter(~lost).select(*keys, "_t", F.lit(None).cast(events.schema["_r"].dataType).alias("_r"),
                                               "_l", F.lit(0 if strict else 1).alias("_side")))
        .withColumn("_s", piece)
    )
    seen = F.struct("_t", "_r")
    upto = Window.partitionBy(*keys, "_s").orderBy("_t", "_side")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn(
        "_m", F.last(F.when(F.col("_r").isNotNull(), seen), ignorenulls=True).over(upto)
    ).filter(F.col("_l").isNotNull())
    folded = events.withColumn("_s", piece).groupBy(*keys, "_s").agg(F.max(seen).alias("_last"))
    # Slices with left rows only ask for a carry too.
    asked = rows.filter(~lost).select(*keys, piece.alias("_s")).distinct()
    slices = folded.join(asked, [*keys, "_s"], "full")
    carry = timeline.carried(slices, keys, "_s", F.last("_last", ignorenulls=True), "_carry")
    matched = found.join(carry.select(*keys, "_s", "_carry"), [*keys, "_s"], "left").withColumn(
        "_m", F.coalesce("_m", "_carry")
    )
    if within_seconds is not None:
        near = F.col("_t") - F.col("_m._t") <= within_seconds * 1_000_000
        matched = matched.withColumn("_m", F.when(near, F.col("_m")))
    if inner:
        return matched.filter(F.col("_m").isNotNull()).select("_l.*", "_m._r.*")
    none = rows.filter(lost).select("_l.*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns))
    return matched.select("_l.*", "_m._r.*").unionByName(none)
