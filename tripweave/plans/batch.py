"""The whole batch: raw trips in, prepared table, stored results and exports out.

Trips are prepared once and written by date. What follows reads the raw trips twice and
the prepared ones eight times, whatever the number of results: raw profile and codes;
folds by time and bands, by zone pair and hour; share groups; figures of the whole table;
anomalies, categories and trip scores, row by row; and the samples. All other results
come from these stored tables. Later steps read written tables: a lost executor costs a
re-read and not a recomputation, and nothing is cached.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripweave.functions import labels as L
from tripweave.operators import anomalies, cleaning, profiling, segments, sharing, zones
from tripweave.operators.enrichment import calendar_labels, enrich
from tripweave.operators.grouping import OneRow, apart, description, together
from tripweave.operators.totals import merged_count
from tripweave.plans import charts
from tripweave.plans.reports import all_reports, band_part, fold, time_part
from tripweave.sources import readers, schemas, writers

CLEANED = "cleaned_trips"

# Results stored as Parquet, for other steps to build on; all others are CSV.
PARQUET = {
    "raw_profile",
    "raw_codes",
    "folded",
    "whole_table",
    "zone_totals",
    "share_groups",
    "share_savings",
    "samples",
}
# Row-level results, by date as the prepared trips are.
BY_DATE = {"anomalies", "categorized_trips", "efficiency_trips"}


def save(df: DataFrame, out: str, name: str) -> DataFrame:
    """Store a named result and return it as read back."""
    path, reader = f"{out}/{name}", df.sparkSession.read.schema(df.schema)
    if name in PARQUET:
        writers.write_parquet(df, path)
        return reader.parquet(path)
    if name in BY_DATE:
        writers.write_by_date(df, path, ordered=True)
        return reader.parquet(path)
    writers.write_csv(df, path)
    return reader.option("header", True).csv(path)


def prepare_table(
    trips: DataFrame, out: str, wording: L.Wording = L.ENGLISH, ordered: bool = False
) -> DataFrame:
    """Write prepared trips by date and return the written table. ``ordered`` says the
    trips arrive roughly in order of time, which saves the shuffle."""
    path, prepared = f"{out}/{CLEANED}", cleaning.prepare(trips, wording)
    writers.write_by_date(prepared, path, ordered)
    return readers.read_cleaned(trips.sparkSession, path, prepared.schema)


def store_results(
    raw: DataFrame,
    trips: DataFrame,
    zone_table: DataFrame,
    out: str,
    wording: L.Wording = L.ENGLISH,
) -> dict[str, DataFrame]:
    """Store every named result; the values read what was written."""
    stored: dict[str, DataFrame] = {}

    def keep(results: Mapping[str, DataFrame]) -> None:
        stored.update({name: save(df, out, name) for name, df in results.items()})

    of_raw = profiling.whole_table(raw.schema) | {"clean_report": cleaning.validity()}
    of_trips = _whole_table()
    keep(
        {
            "raw_profile": together(enrich(raw), of_raw),
            "raw_codes": profiling.code_totals(raw),
            "folded": fold(trips, wording),
            "whole_table": together(trips, of_trips),
            "zone_totals": zones.zone_totals(trips, by_hour=True),
            "share_groups": sharing.share_groups(trips),
            "categorized_trips": segments.categorize(trips, wording),
            "efficiency_trips": segments.efficiency(trips),
            "samples": readers.samples(trips, random=0.01, exported=0.001),
        }
    )
    keep(apart(stored["raw_profile"], of_raw) | apart(stored["whole_table"], of_trips))
    base = stored["anomaly_baseline"]
    keep(
        {
            "share_savings": sharing.savings(stored["share_groups"]),
            "anomalies": anomalies.anomalies(trips, base=base),
            "share_candidate_rate": sharing.candidate_rate_from_zones(stored["zone_totals"]),
        }
    )
    by_time, by_band = time_part(stored["folded"]), band_part(stored["folded"])
    keep(
        _from_stored(stored, by_time, wording)
        | all_reports(by_time, by_band, wording)
        | zones.all_rankings(stored["zone_totals"], zone_table)
    )
    hourly = stored["hourly_distribution"]
    keep(
        {
            "peak_hours": charts.peak_hours(hourly),
            "top3_hours": charts.peak_hours(hourly, 3),
            "kpi_dashboard": charts.kpi_from_totals(by_time, stored["share_savings_total"]),
        }
    )
    return stored


def _whole_table() -> dict[str, OneRow]:
    return {
        "describe_trips": description(["trip_distance_km", "trip_duration_minutes"]),
        "correlation_matrix": segments.correlations(),
        "anomaly_baseline": anomalies.base_figures(),
    }


def _from_stored(
    stored: Mapping[str, DataFrame], by_time: DataFrame, wording: L.Wording
) -> dict[str, DataFrame]:
    groups, flagged = stored["share_groups"], stored["anomalies"]
    scored, codes = stored["efficiency_trips"], stored["raw_codes"]
    n_candidates = stored["share_candidate_rate"].select("n_candidates").scalar()
    labels = calendar_labels(wording)
    paid = by_time.withColumn("payment_type_label", labels["payment_type_label"])
    return {
        "profile_payment_type": profiling.payment_type_labelled(codes, wording, merged_count()),
        "profile_ratecode": profiling.ratecode_labelled(codes, merged_count()),
        "cleaned_sample": stored["samples"].filter("in_random").drop("in_random", "in_export"),
        "anomaly_rate": anomalies.rate_from_stored(flagged, by_time),
        "share_savings_total": sharing.savings_total(groups, n_candidates=n_candidates),
        "hourly_peak_zone": charts.hourly_peak_from_totals(stored["zone_totals"]),
        "payment_pivot": charts.payment_pivot(paid, wording, merged_count()),
        "payment_counts": charts.payment_counts(paid, folded=True),
        "category_ordered": charts.category_ordered(by_time, wording, folded=True),
        "share_group_stats": sharing.group_stats(groups),
        "share_top_groups": sharing.top_groups(groups),
        "share_top_origins": sharing.top_origins(groups),
        "share_by_hour": sharing.by_hour(groups),
        "share_by_day": sharing.by_day(groups),
        "share_scenarios": sharing.scenarios(groups, wording=wording),
        "share_top_savings": sharing.top_savings(stored["share_savings"]),
        "anomaly_top": anomalies.top(flagged),
        "anomaly_types": anomalies.types(flagged, wording=wording),
        "efficiency_stats": segments.efficiency_stats(scored),
        "efficiency_top": segments.efficiency_top(scored),
    }


def store_exports(
    results: Mapping[str, DataFrame],
    sample: DataFrame,
    out: str,
    first: date | None = None,
    last: date | None = None,
) -> dict[str, DataFrame]:
    """Write the seven chart inputs as CSV. Six hold a handful of rows and become one
    file each; the row sample grows with the trips and keeps Spark's own files. Days
    are limited only by bounds that are given."""
    small = charts.export_tables(results, first, last)
    for name, df in small.items():
        writers.write_single_csv(df, f"{out}/{name}")
    writers.write_csv(sample, f"{out}/sample_data")
    return {
        name: sample.sparkSession.read.schema(df.schema).option("header", True).csv(f"{out}/{name}")
        for name, df in (small | {"sample_data": sample}).items()
    }


def run(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    out: str,
    first: date | None = None,
    last: date | None = None,
    wording: L.Wording = L.ENGLISH,
    schema: StructType | None = schemas.TRIPS,
    ordered: bool = False,
) -> None:
    """Everything, from files to files."""
    raw = readers.read_trips(spark, trips_path, schema)
    zone_table = readers.read_zones(spark, zones_path)
    trips = prepare_table(raw, out, wording, ordered)
    stored = store_results(raw, trips, zone_table, out, wording)
    sample = stored["samples"].filter("in_export").select(*readers.SAMPLE_COLUMNS)
    store_exports(stored, sample, f"{out}/exports", first, last)
