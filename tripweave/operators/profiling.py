"""Profile of raw trips. Each table takes one pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tripweave.functions.columns import looked_up, percent, rows
from tripweave.functions.labels import ENGLISH, RATE_CODES, Wording
from tripweave.operators.grouping import OneRow, description, grouped, stacked

OUTLIER_RULES = {
    "zero_distance_trips": ("trip_distance", "<=", 0),
    "negative_fare_trips": ("fare_amount", "<", 0),
    "zero_passenger_trips": ("passenger_count", "<=", 0),
    "negative_total_trips": ("total_amount", "<", 0),
}


def _breaks(rule: str) -> Column:
    name, sign, bound = OUTLIER_RULES[rule]
    return F.col(name) <= bound if sign == "<=" else F.col(name) < bound


def counted() -> OneRow:
    return OneRow({"n": rows()})


def row_count(trips: DataFrame) -> DataFrame:
    return counted().of(trips)


def covered() -> OneRow:
    pickup = F.col("tpep_pickup_datetime")
    parts = {"first_pickup": F.min(pickup), "last_pickup": F.max(pickup)}
    return OneRow(
        parts, lambda one: one.withColumn("days", F.datediff("last_pickup", "first_pickup"))
    )


def period(trips: DataFrame) -> DataFrame:
    return covered().of(trips)


def listed(schema: StructType) -> OneRow:
    """Position, name and type of each column, with the number of values it holds."""
    parts = {
        f.name: F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(f.name).alias("n_values"),
        )
        for i, f in enumerate(schema.fields, 1)
    }
    return OneRow(parts, lambda one: stacked(one, schema.names))


def schema_listing(trips: DataFrame) -> DataFrame:
    return listed(trips.schema).of(trips)


def _shares(one: DataFrame, label: str, number: str, names: Iterable[str]) -> DataFrame:
    """One row per count of a one-row result, with its percentage of ``_n``."""
    entries = [
        F.struct(
            F.lit(name).alias(label),
            F.col(name).alias(number),
            percent(F.col(name), F.col("_n")).alias("pct"),
        )
        for name in names
    ]
    return one.select(F.inline(F.array(*entries)))


def missing(schema: StructType) -> OneRow:
    """Nulls per column, empty texts included, with their percentage."""

    def is_missing(field) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, StringType):
            return c.isNull() | (c == "")
        return c.isNull()

    parts = {"_n": rows()} | {f.name: F.count_if(is_missing(f)) for f in schema.fields}
    return OneRow(parts, lambda one: _shares(one, "column", "nulls", schema.names))


def missing_values(trips: DataFrame) -> DataFrame:
    return missing(trips.schema).of(trips)


def rule_breaks() -> OneRow:
    """Trips that break each plausibility rule, with their percentage."""
    parts = {"_n": rows()} | {r: F.count_if(_breaks(r)) for r in OUTLIER_RULES}
    return OneRow(parts, lambda one: _shares(one, "rule", "n", OUTLIER_RULES))


def outliers(trips: DataFrame) -> DataFrame:
    return rule_breaks().of(trips)


def headline() -> OneRow:
    """Four headline counts as (metric, value) texts."""
    shown = ("zero_distance_trips", "negative_fare_trips", "zero_passenger_trips")
    parts = {"total_trips": rows()} | {r: F.count_if(_breaks(r)) for r in shown}

    def finish(one: DataFrame) -> DataFrame:
        entries = [
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value"))
            for m in parts
        ]
        return one.select(F.inline(F.array(*entries)))

    return OneRow(parts, finish)


def summary(trips: DataFrame) -> DataFrame:
    return headline().of(trips)


def raw_description() -> OneRow:
    return description(["trip_distance", "fare_amount", "total_amount", "passenger_count"])


def describe_raw(trips: DataFrame) -> DataFrame:
    return raw_description().of(trips)


def whole_table(schema: StructType) -> dict[str, OneRow]:
    """Every profile that needs no grouping, to be taken from one scan."""
    return {
        "profile_summary": headline(),
        "profile_period": covered(),
        "profile_schema": listed(schema),
        "profile_missing": missing(schema),
        "profile_outliers": rule_breaks(),
        "profile_describe_raw": raw_description(),
    }


def code_distribution(trips: DataFrame, code: str, count: Column | None = None) -> DataFrame:
    """Trips and percentage per code, null included, most frequent first. Rows may be
    totals with a ``count`` of their own, here and below."""
    return grouped(trips, [code], {}, share="pct", order=[F.desc("n"), F.asc(code)], count=count)


def code_totals(trips: DataFrame) -> DataFrame:
    """Mergeable counts by both codes."""
    return trips.groupBy("payment_type", "RatecodeID").agg(rows().alias("n"))


def ratecode_labelled(trips: DataFrame, count: Column | None = None) -> DataFrame:
    groups = code_distribution(trips, "RatecodeID", count)
    return groups.withColumn("rate_label", looked_up(F.col("RatecodeID"), RATE_CODES))


def payment_type_labelled(
    trips: DataFrame, wording: Wording = ENGLISH, count: Column | None = None
) -> DataFrame:
    groups = code_distribution(trips, "payment_type", count)
    legend = dict(enumerate(wording.payments, 1))
    return groups.withColumn("payment_label", looked_up(F.col("payment_type"), legend))
