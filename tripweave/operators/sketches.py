"""Stored sketches: distinct counts and quantiles of any range of days from one row a day.

A day's row holds its number of trips, a HyperLogLog sketch of a key and a KLL sketch of a
measure. Sketches merge, so a range of days merges its rows and never reads a trip again.
With ``LG_K`` = 14 the distinct count has a standard error of 0.8 %, with ``K`` = 400 the
rank of a quantile is off by less than 1 % of the rows; ``within`` states the bounds that the
tests hold the results to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
K = 400
DISTINCT_BOUND = 0.03
RANK_BOUND = 0.01


def by_day(rows: DataFrame, day: str, key: Column, measure: Column) -> DataFrame:
    """day, n, distinct_sketch and quantile_sketch; null keys and measures are left out."""
    return rows.groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(key, LG_K).alias("distinct_sketch"),
        F.kll_sketch_agg_double(measure.cast("double"), K).alias("quantile_sketch"),
    )


def over(
    daily: DataFrame, keys: Sequence[Column | str], quantiles: dict[str, float]
) -> DataFrame:
    """keys, n, n_distinct and the named quantiles, merged from days. Restrict the days with
    a filter on ``daily`` first; no keys give one row."""
    merged = daily.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.kll_merge_agg_double("quantile_sketch", K).alias("_merged"),
    )
    named = {
        name: F.kll_sketch_get_quantile_double("_merged", F.lit(float(q))) for name, q in quantiles.items()
    }
    return merged.withColumns(named).drop("_merged")


def within(estimate: Column, exact: Column, bound: float = DISTINCT_BOUND) -> Column:
    """Whether a distinct count lies in its bound; one of the exact count is always allowed."""
    return F.abs(estimate - exact) <= F.greatest(exact * bound, F.lit(1))
