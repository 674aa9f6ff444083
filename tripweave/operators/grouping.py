"""Building blocks the reports share: grouped measures, shares, profiles, top rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.columns import percent, rows


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    share: str | None = None,
    order: Iterable[Column] = (),
    count: Column | None = None,
) -> DataFrame:
    """Row count ``n`` and named measures per key; ``share`` adds a percentage of
    all rows; ``order`` sorts the groups; ``count`` replaces the row count where the
    rows are totals."""
    n = rows() if count is None else count
    out = df.groupBy(*keys).agg(n.alias("n"), *(c.alias(name) for name, c in measures.items()))
    if share:
        out = with_share(out, share)
    order = list(order)
    return out.orderBy(*order) if order else out


def with_share(groups: DataFrame, name: str = "pct", count: str = "n") -> DataFrame:
    """Percentage of each group's count in the total.

    The window runs over finished groups (a handful of labels), never over trips,
    and saves the second scan a separate total would cost. All groups meet in one task,
    so the keys must be few: labels, codes or boroughs.
    """
    total = F.sum(count).over(Window.partitionBy())
    return groups.withColumn(name, percent(F.col(count), total))


def top_rows(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows, with every column as tie-break so the cut is stable.
    Spark keeps ``n`` rows per partition and merges them; nothing is fully sorted."""
    return df.orderBy(*by, *(F.col(c).asc_nulls_first() for c in df.columns)).limit(n)


@dataclass(frozen=True)
class OneRow:
    """A result that follows from aggregates over a whole table: ``parts`` names them,
    ``finish`` shapes the one row they give. Several can share a scan."""

    parts: Mapping[str, Column]
    finish: Callable[[DataFrame], DataFrame] = lambda one: one

    def of(self, df: DataFrame) -> DataFrame:
        return self.finish(df.agg(*(c.alias(n) for n, c in self.parts.items())))


def together(df: DataFrame, results: Mapping[str, OneRow]) -> DataFrame:
    """The aggregates of several results in one row, a struct for each."""
    return df.agg(
        *(
            F.struct(*(c.alias(n) for n, c in result.parts.items())).alias(name)
            for name, result in results.items()
        )
    )


def apart(one_row: DataFrame, results: Mapping[str, OneRow]) -> dict[str, DataFrame]:
    """The results from a stored row of ``together``."""
    return {name: r.finish(one_row.select(f"{name}.*")) for name, r in results.items()}


def description(columns: Sequence[str]) -> OneRow:
    """Count, mean, sample deviation, minimum and maximum, one typed row per column,
    all from a single pass."""
    stats = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    value = {c: F.col(c).cast("double") for c in columns}
    parts = {
        c: F.struct(
            F.lit(c).alias("column"), *(f(value[c]).alias(s) for s, f in stats.items())
        )
        for c in columns
    }
    return OneRow(parts, lambda one: stacked(one, columns))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return description(columns).of(df)


def stacked(one_row: DataFrame, structs: Sequence[str]) -> DataFrame:
    """Turn the like-shaped structs of a one-row result into one row each."""
    return one_row.select(F.inline(F.array(*structs)))
