"""Every registered query by name, over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tripweave.operators import (
    anomalies,
    cleaning,
    profiling,
    segments,
    sharing,
    zones,
)
from tripweave.operators.enrichment import enrich
from tripweave.operators.grouping import describe
from tripweave.plans import batch, charts, further
from tripweave.plans.reports import REPORTS, fold, report, report_from_totals, time_part
from tripweave.sources import driver_tables, readers, writers

FIRST_DAY, LAST_DAY = date(2024, 1, 8), date(2024, 1, 21)
SAMPLE = 0.05


@dataclass(frozen=True)
class Tables:
    """The inputs of one query, planned only when asked for."""

    spark: SparkSession
    sf_dir: str

    @property
    def raw(self) -> DataFrame:
        return driver_tables.raw_trips(self.spark, self.sf_dir)

    @property
    def trips(self) -> DataFrame:
        return driver_tables.prepared_trips(self.spark, self.sf_dir)

    @property
    def zones(self) -> DataFrame:
        return driver_tables.zones(self.spark, self.sf_dir)

    @property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @property
    def all_groups(self) -> DataFrame:
        return sharing.trip_groups(sharing.candidates(self.trips))

    @property
    def groups(self) -> DataFrame:
        return sharing.shareable(self.all_groups)

    def folder(self) -> str:
        return writers.shared_folder(self.spark)


def _scan_zones(t: Tables) -> DataFrame:
    path = t.folder()
    writers.write_csv(t.zones, path)
    return readers.read_zones(t.spark, path)


def _csv_roundtrip(t: Tables) -> DataFrame:
    return batch.save(report(t.trips, "hourly_distribution"), t.folder(), "hourly_distribution")


def _parquet_roundtrip(t: Tables) -> DataFrame:
    return batch.save(t.groups, t.folder(), "share_groups")


def _export_results(t: Tables) -> DataFrame:
    """Rows of each exported file, read back."""
    out, trips = t.folder(), t.trips
    groups = batch.save(t.groups, out, "share_groups")
    by_time = time_part(batch.save(fold(trips), out, "folded"))
    reported = ("hourly_distribution", "payment_distribution", "payment_by_date")
    results = {name: report_from_totals(by_time, name) for name in reported} | {
        "top_pickup_zones": zones.top_zones(trips, t.zones, "pickup"),
        "share_by_hour": sharing.by_hour(groups),
        "share_savings": sharing.savings(groups),
    }
    written = batch.store_exports(results, readers.sample_export(trips), f"{out}/exports")
    counts = [
        df.agg(F.lit(name).alias("result"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in written.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _exported(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """A small result, written as one CSV file and read back."""

    def through_file(t: Tables) -> DataFrame:
        result, path = make(t), t.folder()
        writers.write_single_csv(result, path)
        return t.spark.read.schema(result.schema).option("header", True).csv(path)

    return through_file


# Row-level results: values are compared as they are.
ROW_LEVEL: dict[str, Callable[[Tables], DataFrame]] = {
    "scan_trips": lambda t: t.raw,
    "scan_zones": _scan_zones,
    "cleaned_roundtrip": lambda t: t.trips,
    "sample_trips": lambda t: readers.hash_sample(t.trips, SAMPLE),
    "sample_export_cols": lambda t: readers.sample_export(t.trips, 0.01),
    "preview_raw": lambda t: readers.preview(t.raw, ordered=True),
    "preview_zones": lambda t: readers.preview(t.zones, ordered=True),
    "preview_enriched": lambda t: readers.preview(
        t.trips, columns=readers.PREVIEW_COLUMNS, ordered=True
    ),
    "clean_trips": lambda t: cleaning.clean(t.raw),
    "enrich_trips": lambda t: enrich(cleaning.clean(t.raw)),
    "plausible_trips": lambda t: cleaning.prepare(t.raw),
    "join_pickup_zone": lambda t: zones.join_zone(t.trips, t.zones, "pickup"),
    "join_both_zones": lambda t: zones.join_zones(t.trips, t.zones),
    "share_candidates": lambda t: sharing.candidates(t.trips),
    "share_time_buckets": lambda t: sharing.time_buckets(sharing.candidates(t.trips)),
    "categorized_trips": lambda t: segments.categorize(t.trips),
    "efficiency_trips": lambda t: segments.efficiency(t.trips),
} | further.ROW_LEVEL

# Aggregated or scored results: doubles are settled to fixed digits before comparison.
AGGREGATED: dict[str, Callable[[Tables], DataFrame]] = {
    "profile_row_count": lambda t: profiling.row_count(t.raw),
    "profile_schema": lambda t: profiling.schema_listing(t.raw),
    "profile_period": lambda t: profiling.period(t.raw),
    "profile_missing": lambda t: profiling.missing_values(t.raw),
    "profile_outliers": lambda t: profiling.outliers(t.raw),
    "profile_describe_raw": lambda t: profiling.describe_raw(t.raw),
    "profile_payment_type": lambda t: profiling.code_distribution(t.raw, "payment_type"),
    "profile_payment_labeled": lambda t: profiling.payment_type_labelled(t.raw),
    "profile_ratecode": lambda t: profiling.code_distribution(t.raw, "RatecodeID"),
    "profile_ratecode_labeled": lambda t: profiling.ratecode_labelled(t.raw),
    "profile_summary": lambda t: profiling.summary(t.raw),
    "clean_report": lambda t: cleaning.clean_report(t.raw),
    "describe_distance": lambda t: describe(t.trips, ["trip_distance_km"]),
    "describe_duration": lambda t: describe(t.trips, ["trip_duration_minutes"]),
    "zone_match_rate": lambda t: zones.match_rate(t.trips, t.zones),
    "top_pickup_zones": lambda t: zones.top_zones(t.trips, t.zones, "pickup"),
    "top_dropoff_zones": lambda t: zones.top_zones(t.trips, t.zones, "dropoff"),
    "pickup_borough_stats": lambda t: zones.borough_stats(t.trips, t.zones, "pickup"),
    "dropoff_borough_stats": lambda t: zones.borough_stats(t.trips, t.zones, "dropoff"),
    "peak_hours": lambda t: charts.peak_hours(report(t.trips, "hourly_distribution")),
    "short_top_pickup": lambda t: zones.top_zones_by_length(t.trips, t.zones, "pickup", True),
    "short_top_dropoff": lambda t: zones.top_zones_by_length(t.trips, t.zones, "dropoff", True),
    "long_top_pickup": lambda t: zones.top_zones_by_length(t.trips, t.zones, "pickup", False),
    "long_top_dropoff": lambda t: zones.top_zones_by_length(t.trips, t.zones, "dropoff", False),
    "borough_flows": lambda t: zones.borough_flows(t.trips, t.zones),
    "share_candidate_rate": lambda t: sharing.candidate_rate(t.trips),
    "share_groups": lambda t: t.groups,
    "share_groups_7_minutes": lambda t: sharing.share_groups(t.trips, minutes=7),
    "share_group_stats": lambda t: sharing.group_stats(t.groups),
    "share_top_groups": lambda t: sharing.top_groups(t.groups),
    "share_top_origins": lambda t: sharing.top_origins(t.groups),
    "share_savings": lambda t: sharing.savings(t.groups),
    "share_savings_total": lambda t: sharing.savings_total(t.all_groups),
    "share_top_savings": lambda t: sharing.top_savings(sharing.savings(t.groups)),
    "share_by_hour": lambda t: sharing.by_hour(t.groups),
    "share_by_day": lambda t: sharing.by_day(t.groups),
    "share_scenarios": lambda t: sharing.scenarios(t.groups),
    "anomaly_baseline": lambda t: anomalies.baseline(t.trips),
    "anomaly_scores": lambda t: anomalies.scores(t.trips),
    "anomaly_rate": lambda t: anomalies.rate(t.trips),
    "anomaly_top": lambda t: anomalies.top(anomalies.anomalies(t.trips)),
    "anomaly_types": lambda t: anomalies.types(anomalies.anomalies(t.trips)),
    "correlation_matrix": lambda t: segments.correlation_matrix(t.trips),
    "efficiency_stats": lambda t: segments.efficiency_stats(segments.efficiency(t.trips)),
    "efficiency_top": lambda t: segments.efficiency_top(segments.efficiency(t.trips)),
    "export_top15_zones": lambda t: charts.top15_zones(zones.top_zones(t.trips, t.zones, "pickup")),
    "payment_by_date_range": lambda t: charts.payment_by_date_range(t.trips, FIRST_DAY, LAST_DAY),
    "export_top20_savings": lambda t: charts.top20_savings(sharing.savings(t.groups)),
    "top3_hours": lambda t: charts.peak_hours(report(t.trips, "hourly_distribution"), 3),
    "payment_pivot": lambda t: charts.payment_pivot(t.trips),
    "hourly_peak_zone": lambda t: charts.hourly_peak_zone(t.trips),
    "kpi_dashboard": lambda t: charts.kpi_dashboard(t.trips),
    "sample_hourly": lambda t: charts.hourly_counts(readers.hash_sample(t.trips, SAMPLE)),
    "sample_payment": lambda t: charts.payment_counts(readers.hash_sample(t.trips, SAMPLE)),
    "category_ordered": lambda t: charts.category_ordered(t.trips),
    "sink_csv_roundtrip": _csv_roundtrip,
    "sink_parquet_roundtrip": _parquet_roundtrip,
    "export_results": _export_results,
    "export_hourly": _exported(lambda t: report(t.trips, "hourly_distribution")),
    "export_payment": _exported(lambda t: report(t.trips, "payment_distribution")),
    "export_share_hourly": _exported(lambda t: sharing.by_hour(t.groups)),
    "export_payment_by_date": _exported(lambda t: report(t.trips, "payment_by_date")),
    "export_savings_summary": _exported(
        lambda t: charts.top20_savings(sharing.savings(t.groups))
    ),
    "export_top_pickup_zones": _exported(
        lambda t: charts.top15_zones(zones.top_zones(t.trips, t.zones, "pickup"))
    ),
    "export_sample_data": _exported(lambda t: readers.sample_export(t.trips, 0.01)),
} | {name: (lambda t, name=name: report(t.trips, name)) for name in REPORTS} | further.AGGREGATED

# Totals over many trips are settled to cents, means, ratios and figures of a single
# group of trips to six digits.
TOTALS = {"sum_fare", "sum_total", "money_saved", "minutes_saved", "hours_saved"}
PER_GROUP = {"share_savings", "share_top_savings", "export_top20_savings", "export_savings_summary"}


def settled(df: DataFrame, per_group: bool = False) -> DataFrame:
    """Doubles at fixed digits. The tail that summation order leaves differs between
    engines; the small offset keeps exact halves on one side."""

    def settle(name: str):
        scale = 1e2 if name in TOTALS and not per_group else 1e6
        return F.floor(F.col(name) * scale + 0.500001) / scale

    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({name: settle(name) for name in doubles}) if doubles else df


def _run(name: str, make: Callable[[Tables], DataFrame], settle: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = make(Tables(spark, sf_dir))
        return settled(df, name in PER_GROUP) if settle else df

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _run(name, make, settle)
    for table, settle in ((ROW_LEVEL, False), (AGGREGATED, True))
    for name, make in table.items()
}
