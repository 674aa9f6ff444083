"""Exact quantiles per group without sorting a group into one task.

Every wanted rank of every group has a bracket of values, at first from the least to the
largest. A pass counts the rows of each bracket in ``BUCKETS`` buckets (folded before the
shuffle, so a group of half of all rows costs a task at most that many rows), finds the
bucket that holds the rank, and takes the least and largest value met in it as the new
bracket. Both ends of an unfinished bracket fall into different buckets, so each pass narrows
it; it is done when they are equal. A few passes do, whatever the number of rows.

Quantiles are interpolated between the two ranks around (n - 1) * q. Nulls, NaN and
infinite values are left out; null keys are a key; a group without values has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.sources.writers import landed

BUCKETS = 2048


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return same


def _other(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})


def exact_quantiles(
    rows: DataFrame, keys: Sequence[str], value: Column, quantiles: dict[str, float]
) -> DataFrame:
    """keys, n and a column for each named quantile (0 to 1)."""
    if bad := [q for q in quantiles.values() if not 0 <= q <= 1]:
        raise ValueError(f"not between 0 and 1: {bad}")
    finite = (
        rows.select(*keys, value.cast("double").alias("_v"))
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")))
    )
    whole = finite.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    wanted = [(F.col("n") - 1) * float(q) for q in quantiles.values()]
    ranks = F.array_distinct(F.array(*(f(w).cast("long") for w in wanted for f in (F.floor, F.ceil))))
    state = landed(
        whole.withColumn("_rank", F.explode(ranks)).withColumn("_left", F.col("_rank")), "brackets"
    )
    done = state.filter("_low = _high")
    open_ = state.filter("_low < _high")
    while not open_.isEmpty():
        stepped = landed(_narrow(finite, open_, keys), "brackets")
        done = done.unionByName(stepped.filter("_low = _high"))
        open_ = stepped.filter("_low < _high")
    at = F.map_from_entries(F.collect_list(F.struct("_rank", "_low")))
    found = done.groupBy(*keys, "n").agg(at.alias("_at"))
    named = {}
    for name, w in zip(quantiles, wanted):
        low, high = (F.element_at("_at", f(w).cast("long")) for f in (F.floor, F.ceil))
        named[name] = low + (high - low) * (w - F.floor(w))
    return found.withColumns(named).drop("_at")


def _narrow(finite: DataFrame, open_: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One pass over the rows that lie in a bracket."""
    # Halves, so that the width of any two doubles is a double.
    share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
    met = finite.join(_other(open_, keys), _same(keys)).filter(F.col("_v").between(F.col("_low"), F.col("_high")))
    folded = met.groupBy(*keys, "n", "_rank", "_left", bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    below = Window.partitionBy(*keys, "_rank").orderBy("_bucket")
    before = F.sum("_n").over(below) - F.col("_n")
    holds = (F.col("_left") >= F.col("_before")) & (F.col("_left") < F.col("_before") + F.col("_n"))
    return (
        folded.withColumn("_before", before)
        .filter(holds)
        .select(*keys, "n", "_low", "_high", "_rank", (F.col("_left") - F.col("_before")).alias("_left"))
    )


def robust_figures(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """keys, n, median and mad (the median distance from the median)."""
    medians = landed(exact_quantiles(rows, keys, F.col(column), {"median": 0.5}), "medians")
    near = rows.select(*keys, F.col(column)).join(_other(medians, keys), _same(keys))
    distance = F.abs(F.col(column) - F.col("median"))
    mads = exact_quantiles(near, keys, distance, {"mad": 0.5}).drop("n")
    return medians.join(_other(mads, keys), _same(keys)).select(*keys, "n", "median", "mad")


def robust_scores(rows: DataFrame, keys: Sequence[str], column: str, figures: DataFrame) -> DataFrame:
    """``rows`` with robust_z, the distance from the group's median in units of its scaled
    MAD (null where that is zero), as against mean and deviation, which outliers move."""
    known = _other(figures.select(*keys, "median", "mad"), keys)
    z = F.try_divide(0.6745 * (F.col(column) - F.col("median")), F.col("mad"))
    joined = rows.join(known, _same(keys), "left").withColumn("robust_z", z)
    return joined.drop("median", "mad", *(f"_k{i}" for i in range(len(keys))))


def robust_outliers(rows: DataFrame, keys: Sequence[str], column: str, limit: float = 3.5) -> DataFrame:
    """keys, n, median, mad and n_outliers, the rows beyond the limit on either side."""
    figures = landed(robust_figures(rows, keys, column), "figures")
    far = robust_scores(rows, keys, column, figures).filter(F.abs("robust_z") > limit)
    counts = far.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_outliers"))
    joined = figures.join(_other(counts, keys), _same(keys), "left")
    return joined.select(*keys, "n", "median", "mad", F.coalesce("n_outliers", F.lit(0)).alias("n_outliers"))
