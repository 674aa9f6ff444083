"""Additive totals: counts and sums that can be merged again without the trips."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.columns import rows


def totals(
    df: DataFrame, keys: Sequence[str], columns: Iterable[str], *extra: Column
) -> DataFrame:
    """Per key the row count ``n`` and, per column, its sum and its non-null count."""
    parts = [rows().alias("n")]
    for c in columns:
        parts += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    return df.groupBy(*keys).agg(*parts, *extra)


def merged_count() -> Column:
    return F.sum("n")


def merged_sum(column: str) -> Column:
    return F.sum(f"sum_{column}")


def merged_mean(column: str) -> Column:
    return F.try_divide(F.sum(f"sum_{column}"), F.sum(f"n_{column}"))
