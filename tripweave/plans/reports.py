"""Grouped reports as data: keys, measures and a filter per report.

Some thirty analyses differ in nothing else, so they are rows of one table and run
through one function. ``run_report`` adds no action; Spark sees one aggregate per
report and prunes the scan to the columns it names.

A single report reads the trips. To produce them all, ``fold`` reads the trips once and
folds them twice, by time and payment (``time_totals``) and by bands and segments
(``band_totals``); all 31 reports then merge these small tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import labels as L
from tripweave.functions.columns import band_order, banded, labelled, percent, rows
from tripweave.operators.enrichment import calendar_labels
from tripweave.operators.grouping import grouped
from tripweave.operators.segments import categorize, with_rush_hour
from tripweave.operators.totals import merged_count, merged_mean, merged_sum, totals

# Measures by result column: what is averaged or summed under that name.
AVERAGED = {
    "avg_fare": "fare_amount",
    "avg_total": "total_amount",
    "avg_tip": "tip_amount",
    "avg_tip_pct": "tip_percentage",
    "avg_km": "trip_distance_km",
    "avg_minutes": "trip_duration_minutes",
    "avg_speed": "average_speed_kmh",
    "avg_passengers": "passenger_count",
}
SUMMED = {"sum_fare": "fare_amount", "sum_total": "total_amount"}


TIME_KEYS = ("trip_date", "hour", "payment_type", "trip_category", "is_short_trip")


# Keys of the second fold: positions of bands, segments, and whether a tip was given.
BAND_KEYS = (
    "payment_type",
    "amount_order",
    "tip_order",
    "fare_order",
    "trip_profile",
    "revenue_category",
    "tipped",
)
BANDED = {
    "amount": ("total_amount", L.AMOUNT_BANDS),
    "tip": ("tip_percentage", L.TIP_BANDS),
    "fare": ("fare_amount", L.FARE_BANDS),
}


def _time_extras() -> list[Column]:
    return [
        F.count_if(F.col("tip_amount") > 0).alias("n_tipped"),
        F.count("VendorID").alias("n_vendor"),
        F.min("total_amount").alias("min_total"),
        F.max("total_amount").alias("max_total"),
        F.sum(F.col("total_amount") * F.col("total_amount")).alias("sq_total"),
    ]


def time_totals(trips: DataFrame) -> DataFrame:
    """Mergeable totals of every averaged or summed column."""
    return totals(trips, TIME_KEYS, AVERAGED.values(), *_time_extras())


def _with_bands(trips: DataFrame, wording: L.Wording) -> DataFrame:
    orders = {f"{k}_order": band_order(F.col(c), bands) for k, (c, bands) in BANDED.items()}
    tipped = F.coalesce(F.col("tip_amount") > 0, F.lit(False))
    return categorize(trips, wording).withColumns(orders | {"tipped": tipped})


def fold(trips: DataFrame, wording: L.Wording = L.ENGLISH) -> DataFrame:
    """Both folds from one scan: rows with ``is_time`` hold totals by time, the others
    by bands and segments."""
    keys = [*TIME_KEYS, *(k for k in BAND_KEYS if k not in TIME_KEYS)]
    parts = [rows().alias("n")]
    for c in dict.fromkeys(AVERAGED.values()):
        parts += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    marked = _with_bands(trips, wording)
    grouping = F.grouping("trip_date").alias("not_time")
    out = marked.groupingSets([list(TIME_KEYS), list(BAND_KEYS)], *keys).agg(
        *parts, *_time_extras(), grouping
    )
    return out.withColumn("is_time", F.col("not_time") == 0).drop("not_time")


def time_part(folded: DataFrame) -> DataFrame:
    other = [k for k in BAND_KEYS if k not in TIME_KEYS]
    return folded.filter("is_time").drop("is_time", *other)


def band_part(folded: DataFrame) -> DataFrame:
    other = [k for k in TIME_KEYS if k not in BAND_KEYS]
    return folded.filter("not is_time").drop("is_time", *other)


def _relabelled(folded: DataFrame, wording: L.Wording) -> DataFrame:
    day = folded.withColumn("day_of_week", F.dayofweek("trip_date"))
    return day.withColumns(calendar_labels(wording))


def _merged_measure(name: str) -> Column:
    if name in AVERAGED:
        return merged_mean(AVERAGED[name])
    if name in SUMMED:
        return merged_sum(SUMMED[name])
    return {
        "min_total": lambda: F.min("min_total"),
        "max_total": lambda: F.max("max_total"),
        "std_total": _merged_deviation,
        "n_tipped": lambda: F.sum("n_tipped"),
        "pct_tipped": lambda: percent(F.sum("n_tipped"), merged_count()),
    }[name]()


def _merged_deviation() -> Column:
    """Sample deviation from counts, sums and sums of squares."""
    n, total = F.sum("n_total_amount"), merged_sum("total_amount")
    spread = F.sum("sq_total") - total * total / n
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))


def _measure(name: str) -> Column:
    if name in AVERAGED:
        return F.avg(AVERAGED[name])
    if name in SUMMED:
        return F.sum(SUMMED[name])
    return {
        "min_total": lambda: F.min("total_amount"),
        "max_total": lambda: F.max("total_amount"),
        "std_total": lambda: F.stddev_samp("total_amount"),
        "n_tipped": lambda: F.count_if(F.col("tip_amount") > 0),
        "pct_tipped": lambda: percent(F.count_if(F.col("tip_amount") > 0), rows()),
    }[name]()


@dataclass(frozen=True)
class Report:
    """One grouped report. ``share`` adds ``pct`` of the rows that pass ``where``."""

    keys: str
    measures: str = ""
    where: Callable[[], Column] | None = None
    share: bool = False
    by: str = ""  # "+name" ascending, "-name" descending; other keys break ties
    derive: Callable[[DataFrame, L.Wording], DataFrame] | None = None


def _banded(source: str, name: str, bands: L.Bands):
    def derive(trips: DataFrame, _: L.Wording) -> DataFrame:
        value = F.col(source)
        return trips.withColumns(
            {name: banded(value, bands), "band_order": band_order(value, bands)}
        )

    return derive


def _week(trips: DataFrame, _: L.Wording) -> DataFrame:
    return trips.withColumn("week", F.weekofyear("trip_date"))


def _rush(trips: DataFrame, _: L.Wording) -> DataFrame:
    return with_rush_hour(trips)


def _short() -> Column:
    return F.col("is_short_trip")


def _long() -> Column:
    return ~F.col("is_short_trip")


def _card() -> Column:
    return F.col("payment_type") == L.CARD


def _card_tipped() -> Column:
    return _card() & (F.col("tip_amount") > 0)


def _card_or_cash() -> Column:
    return F.col("payment_type").isin(L.CARD, L.CASH)


REPORTS: dict[str, Report] = {
    # distances, durations and speeds
    "category_distribution": Report("trip_category", share=True, by="-n"),
    "short_long_split": Report("is_short_trip", share=True, by="-n"),
    "speed_by_hour": Report("hour", "avg_speed", by="+hour"),
    "speed_by_day": Report("day_name day_of_week", "avg_speed", by="+day_of_week"),
    "speed_by_period": Report("time_period", "avg_speed", by="-avg_speed"),
    "speed_by_weekend": Report("is_weekend", "avg_speed", by="+is_weekend"),
    "fare_by_category": Report("trip_category", "avg_fare avg_total avg_tip_pct", by="+trip_category"),
    # time of day and week
    "hourly_distribution": Report("hour", "avg_fare avg_speed", by="+hour"),
    "daily_distribution": Report("day_name day_of_week", "avg_fare avg_km", by="+day_of_week"),
    "period_distribution": Report("time_period", "avg_fare avg_speed", share=True, by="-n"),
    "day_hour_heatmap": Report("day_name day_of_week hour", by="+day_name +hour"),
    "hourly_trends": Report(
        "day_name day_of_week hour",
        "avg_fare avg_km avg_speed avg_tip_pct",
        by="+day_name +hour",
    ),
    "daily_trends": Report("trip_date", "avg_fare sum_total avg_passengers", by="+trip_date"),
    "rush_vs_offpeak": Report(
        "is_rush_hour",
        "avg_fare avg_minutes avg_speed sum_total",
        by="+is_rush_hour",
        derive=_rush,
    ),
    "weekend_period": Report(
        "is_weekend time_period",
        "avg_fare avg_speed avg_tip_pct",
        by="+is_weekend +time_period",
    ),
    # payments
    "payment_distribution": Report(
        "payment_type payment_type_label", "avg_total avg_tip", share=True, by="-n"
    ),
    "payment_short": Report(
        "payment_type_label", "avg_total avg_tip_pct", where=_short, share=True, by="-n"
    ),
    "payment_long": Report(
        "payment_type_label", "avg_total avg_tip_pct", where=_long, share=True, by="-n"
    ),
    "payment_by_date": Report("trip_date payment_type_label", by="+trip_date -n"),
    "payment_by_week": Report(
        "week payment_type_label", "avg_total", by="+week -n", derive=_week
    ),
    "payment_by_day": Report(
        "day_name day_of_week payment_type_label", "avg_total", by="+day_of_week -n"
    ),
    "payment_by_hour": Report("hour payment_type_label", where=_card_or_cash, by="+hour -n"),
    "amount_stats": Report(
        "payment_type_label", "min_total avg_total max_total std_total", by="-avg_total"
    ),
    "amount_bands": Report(
        "amount_band band_order payment_type_label",
        by="+band_order -n",
        derive=_banded("total_amount", "amount_band", L.AMOUNT_BANDS),
    ),
    "tip_stats": Report(
        "payment_type_label",
        "avg_tip avg_tip_pct n_tipped pct_tipped",
        where=_card_or_cash,
        by="-n",
    ),
    "tip_bands": Report(
        "tip_band band_order",
        "avg_tip avg_tip_pct",
        where=_card_tipped,
        by="+band_order",
        derive=_banded("tip_percentage", "tip_band", L.TIP_BANDS),
    ),
    "payment_weekend": Report(
        "is_weekend payment_type_label", "avg_total avg_tip_pct", by="+is_weekend -n"
    ),
    "payment_period": Report(
        "time_period payment_type_label", "avg_total", by="+time_period -n"
    ),
    "tip_by_fare_band": Report(
        "fare_band band_order",
        "avg_tip avg_tip_pct avg_fare",
        where=_card,
        by="+band_order",
        derive=_banded("fare_amount", "fare_band", L.FARE_BANDS),
    ),
    # segments
    "profile_distribution": Report(
        "trip_profile", "avg_fare avg_km", by="-n", derive=categorize
    ),
    "revenue_distribution": Report(
        "revenue_category", "sum_fare avg_km", by="-n", derive=categorize
    ),
}


def run_report(
    trips: DataFrame,
    report: Report,
    wording: L.Wording = L.ENGLISH,
    measure: Callable[[str], Column] = _measure,
    count: Column | None = None,
) -> DataFrame:
    """One report over prepared trips, or over totals with their own ``measure``."""
    if report.where is not None:
        trips = trips.filter(report.where())
    if report.derive is not None:
        trips = report.derive(trips, wording)
    keys, by = report.keys.split(), report.by.split()
    ties = [k for k in keys if "+" + k not in by] if by else []
    order = [F.desc(o[1:]) if o[0] == "-" else F.asc(o[1:]) for o in by]
    return grouped(
        trips,
        keys,
        {m: measure(m) for m in report.measures.split()},
        share="pct" if report.share else None,
        order=order + [F.asc(k) for k in ties],
        count=count,
    )


def report(trips: DataFrame, name: str, wording: L.Wording = L.ENGLISH) -> DataFrame:
    """A named report over prepared trips."""
    return run_report(trips, REPORTS[name], wording)


# Reports by bands and segments: how their keys follow from the second fold.
BAND_REPORTS = {
    "amount_bands": "amount",
    "tip_bands": "tip",
    "tip_by_fare_band": "fare",
    "profile_distribution": None,
    "revenue_distribution": None,
}


def report_from_totals(
    folded: DataFrame, name: str, wording: L.Wording = L.ENGLISH
) -> DataFrame:
    """One report merged from ``time_totals``, or from the totals by bands for the
    reports of ``BAND_REPORTS``."""
    known = REPORTS[name]
    if name not in BAND_REPORTS:
        named = _relabelled(folded, wording)
        return run_report(named, known, wording, _merged_measure, merged_count())
    named = folded.withColumn(
        "payment_type_label", labelled(F.col("payment_type"), wording.payments)
    )
    if band := BAND_REPORTS[name]:
        order, bands = F.col(f"{band}_order"), BANDED[band][1]
        label = F.element_at(F.array(*map(F.lit, bands.labels)), order + 1)
        named = named.withColumns({"band_order": order, f"{band}_band": label})
    if name == "tip_bands":
        named = named.filter(_card() & F.col("tipped"))
        known = replace(known, where=None)
    return run_report(
        named, replace(known, derive=None), wording, _merged_measure, merged_count()
    )


def all_reports(
    by_time: DataFrame, by_band: DataFrame, wording: L.Wording = L.ENGLISH
) -> dict[str, DataFrame]:
    """Every report, from the two stored folds."""
    return {
        name: report_from_totals(by_band if name in BAND_REPORTS else by_time, name, wording)
        for name in REPORTS
    }
