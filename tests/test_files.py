"""Readers, writers, sampling, the batch run and the plans Spark makes of them."""

from __future__ import annotations

import re
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripweave.functions.labels import FRENCH
from tripweave.operators import anomalies, profiling, segments, sharing, zones
from tripweave.operators.cleaning import clean, clean_report, prepare
from tripweave.plans import batch, charts
from tripweave.plans.catalog import QUERIES
from tripweave.plans.reports import REPORTS, all_reports, band_part, fold, report, time_part
from tripweave.sources import driver_tables, readers, writers
from tripweave.sources.schemas import PREPARED, TRIPS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return driver_tables.raw_trips(spark, sf_dir)


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return driver_tables.prepared_trips(spark, sf_dir)


def same_rows(a, b) -> bool:
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


def close_rows(a, b) -> bool:
    """The same rows, doubles up to the tail that the order of summation leaves."""
    exact = [c for c, t in a.dtypes if t != "double"]
    rest = [c for c in a.columns if c not in exact]

    def rows(df):
        return sorted(
            (
                tuple(str(r[c]) for c in exact),
                tuple(float("nan") if r[c] is None else r[c] for c in rest),
            )
            for r in df.collect()
        )

    return all(
        x[0] == y[0] and x[1] == pytest.approx(y[1], rel=1e-7, abs=1e-7, nan_ok=True)
        for x, y in zip(rows(a), rows(b), strict=True)
    )


def test_parquet_round_trip_by_date(spark, raw, tmp_path):
    back = batch.prepare_table(raw, str(tmp_path))
    assert same_rows(prepare(raw), back)
    folders = sorted(p.name for p in (tmp_path / batch.CLEANED).iterdir() if p.is_dir())
    assert folders[0] == "trip_date=2024-01-01" and len(folders) == 31


def test_ordered_trips_are_written_without_a_shuffle(spark, raw, tmp_path):
    ordered = raw.orderBy("tpep_pickup_datetime").coalesce(3)
    back = batch.prepare_table(ordered, str(tmp_path), ordered=True)
    assert same_rows(prepare(raw), back)
    files = [len(list(d.glob("*.parquet"))) for d in (tmp_path / batch.CLEANED).glob("trip_date=*")]
    assert max(files) <= 2


def test_csv_round_trip(trips, tmp_path):
    table = report(trips, "hourly_distribution")
    assert same_rows(table, batch.save(table, str(tmp_path), "hourly_distribution"))


def test_zone_csv_keeps_texts(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n264,"Unknown","N/A","N/A"\n')
    got = readers.read_zones(spark, str(path)).collect()
    assert [tuple(r) for r in got][1] == (264, "Unknown", "N/A", "N/A")


def test_single_file_export(trips, tmp_path):
    writers.write_single_csv(report(trips, "hourly_distribution"), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1


def test_one_crowded_day_is_split_into_several_files(spark, trips_of, tmp_path):
    one = prepare(trips_of({}))
    row = one.first()
    many = spark.range(0, 200_000, numPartitions=8).select(
        *(F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in one.schema)
    )
    many = many.withColumn("total_amount", F.rand(seed=1))
    changed = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        writers.write_by_date(many, str(tmp_path / "days"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(list((tmp_path / "days" / "trip_date=2024-01-17").glob("*.parquet"))) > 1


def test_random_sample_repeats_with_its_seed(trips):
    first, again = (readers.sample_trips(trips, 0.1, seed=7) for _ in range(2))
    assert same_rows(first, again)


def test_hash_sample_does_not_depend_on_layout(trips):
    a = readers.hash_sample(trips, 0.1)
    b = readers.hash_sample(trips.repartition(7), 0.1)
    assert same_rows(a, b)
    assert 0.07 < a.count() / trips.count() < 0.13
    with pytest.raises(ValueError):
        readers.hash_sample(trips, 1.5)


def test_preview_is_sorted(trips):
    rows = readers.preview(trips, 5, readers.PREVIEW_COLUMNS, ordered=True).collect()
    assert len(rows) == 5
    assert rows == sorted(rows, key=tuple)
    quick = readers.preview(trips, 5)
    assert quick.count() == 5 and "Sort" not in plan(quick) and "TakeOrdered" not in plan(quick)


# landing


def test_landed_tables_are_written_once(spark, sf_dir, raw):
    assert driver_tables.raw_trips(spark, sf_dir).inputFiles() == raw.inputFiles()


def test_landing_again_after_the_folder_is_gone(spark, sf_dir, raw, monkeypatch):
    files = tuple(writers.listing(spark, f"{sf_dir}/{t}.parquet") for t in driver_tables.INPUTS)
    key = (spark.sparkContext.applicationId, sf_dir, "trips", files)
    assert key in driver_tables._landed
    monkeypatch.setitem(driver_tables._landed, key, "/nonexistent/trips")
    again = driver_tables.raw_trips(spark, sf_dir)
    assert again.count() == raw.count()


def test_appended_rows_are_landed_anew(spark, sf_dir, tmp_path):
    for name in driver_tables.INPUTS:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    n = driver_tables.raw_trips(spark, str(tmp_path)).count()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert driver_tables.raw_trips(spark, str(tmp_path)).count() == 2 * n


def test_shared_folder_follows_the_setting(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    path = writers.shared_folder(spark)
    assert path.startswith(base) and Path(path.removeprefix("file:")).is_dir()

    class Unset:
        _jvm, _jsc = spark._jvm, spark._jsc

        class conf:
            @staticmethod
            def get(name, default=None):
                return str(tmp_path) if name == "spark.sql.warehouse.dir" else default

    assert writers.shared_folder(Unset()).startswith(str(tmp_path))


def test_no_machine_local_folder_in_the_package():
    for path in Path(batch.__file__).parents[1].rglob("*.py"):
        assert "mkdtemp" not in path.read_text(), path


# plans


def test_validity_reaches_the_scan(raw):
    text = plan(clean(raw).select("fare_amount"))
    assert "PushedFilters: [IsNotNull(trip_distance)" in text
    schema = text.split("ReadSchema:")[1]
    assert "Airport_fee" not in schema and "RatecodeID" not in schema


def test_reports_read_only_their_columns(trips):
    text = plan(report(trips, "hourly_distribution"))
    assert "ReadSchema: struct<fare_amount:double,average_speed_kmh:double,hour:int>" in text


def test_date_range_prunes_folders(trips):
    df = charts.payment_by_date_range(trips, date(2024, 1, 8), date(2024, 1, 9))
    assert "PartitionFilters: [isnotnull(trip_date" in plan(df)


def test_rankings_join_after_aggregation(spark, sf_dir, trips):
    lines = plan(zones.top_zones(trips, driver_tables.zones(spark, sf_dir), "pickup")).splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "PULocationID" in x)
    above = [x for x in lines[:scan] if "HashAggregate" in x]
    assert any("partial_count" in x for x in above)
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any("HashAggregate" in x for x in lines[join:scan])


def test_no_query_multiplies_rows(spark, sf_dir):
    kept = {"export_top15_zones", "export_top20_savings"}
    written = {n for n in QUERIES if n.startswith(("sink", "export", "scan_zones"))} - kept
    for name in set(QUERIES) - written:
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_hot_keys_are_split_when_trips_are_derived(spark, tmp_path, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = F.pmod(F.xxhash64("l_partkey", "l_linenumber", "copy"), F.lit(3)) == 0
    skewed = (
        lines.crossJoin(spark.range(20).withColumnRenamed("id", "copy"))
        .withColumn("l_orderkey", F.when(hot, 77).otherwise(F.col("l_orderkey")).cast("long"))
        .drop("copy")
    )
    skewed.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("orders", "customer", "supplier"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        df = driver_tables.derive_trips(spark, str(tmp_path)).agg(
            F.count(F.lit(1)).alias("n"), F.max("fare_amount"), F.sum("DOLocationID")
        )
        assert df.collect()[0].n == lines.count() * 20
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# batch


@pytest.fixture(scope="module")
def raw_files(spark, sf_dir, raw, tmp_path_factory):
    base = tmp_path_factory.mktemp("input")
    writers.write_parquet(raw, str(base / "trips"))
    writers.write_csv(driver_tables.zones(spark, sf_dir), str(base / "zones"))
    return str(base / "trips"), str(base / "zones")


@pytest.fixture(scope="module")
def ran(spark, raw_files, tmp_path_factory):
    """One batch, with the records that its scans of raw and prepared trips read."""
    out = str(tmp_path_factory.mktemp("batch"))
    trips = batch.prepare_table(readers.read_trips(spark, raw_files[0]), out)
    raw = readers.read_trips(spark, raw_files[0])
    log = Scans(spark)
    stored = batch.store_results(raw, trips, readers.read_zones(spark, raw_files[1]), out)
    sample = stored["samples"].filter("in_export").select(*readers.SAMPLE_COLUMNS)
    batch.store_exports(stored, sample, f"{out}/exports")
    return out, stored, log.counts({"raw": raw_files[0], "prepared": f"{out}/{batch.CLEANED}"})


class Scans:
    """How often the queries run from now on read a folder, by their executed plans."""

    def __init__(self, spark):
        self.store = spark._jsparkSession.sharedState().statusStore()
        self.spark, self.before = spark, self.store.executionsCount()

    def counts(self, folders: dict[str, str]) -> dict[str, int]:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        found = dict.fromkeys(folders, 0)
        runs = self.store.executionsList()
        for i in range(self.before, runs.size()):
            text = runs.apply(i).physicalPlanDescription()
            ran = text.split("+- == Initial Plan ==")[0]
            scans = set(re.findall(r"Scan parquet .*?(\(\d+\))", ran))
            details = [d.strip() for d in text.split("\n\n")]
            for name, folder in folders.items():
                own = [d for d in details if "Scan parquet" in d and f"{folder}]" in d]
                found[name] += sum(d.split(" ")[0] in scans for d in own)
        return found


def test_batch_reads_raw_twice_and_prepared_eight_times(ran):
    assert ran[2] == {"raw": 2, "prepared": 8}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_stored_reports_equal_direct_ones(ran, trips, name):
    assert close_rows(report(trips, name), ran[1][name])


DIRECT = {
    "profile_missing": lambda raw, trips: profiling.missing_values(raw),
    "profile_ratecode": lambda raw, trips: profiling.ratecode_labelled(raw),
    "profile_payment_type": lambda raw, trips: profiling.payment_type_labelled(raw),
    "profile_describe_raw": lambda raw, trips: profiling.describe_raw(raw),
    "clean_report": lambda raw, trips: clean_report(raw),
    "anomaly_baseline": lambda raw, trips: anomalies.baseline(trips),
    "anomaly_rate": lambda raw, trips: anomalies.rate(trips),
    "anomalies": lambda raw, trips: anomalies.anomalies(trips),
    "correlation_matrix": lambda raw, trips: segments.correlation_matrix(trips),
    "share_candidate_rate": lambda raw, trips: sharing.candidate_rate(trips),
    "share_savings_total": lambda raw, trips: sharing.savings_total(
        sharing.trip_groups(sharing.candidates(trips))
    ),
    "kpi_dashboard": lambda raw, trips: charts.kpi_dashboard(trips),
    "hourly_peak_zone": lambda raw, trips: charts.hourly_peak_zone(trips),
    "payment_pivot": lambda raw, trips: charts.payment_pivot(trips),
    "payment_counts": lambda raw, trips: charts.payment_counts(trips),
    "category_ordered": lambda raw, trips: charts.category_ordered(trips),
}


@pytest.mark.parametrize("name", sorted(DIRECT))
def test_stored_results_equal_direct_ones(ran, raw, trips, name):
    assert close_rows(DIRECT[name](raw, trips), ran[1][name])


def test_batch_writes_every_result(spark, ran, trips):
    out, stored, _ = ran
    for name in stored:
        found = {p.suffix for p in Path(out, name).rglob("part-*")}
        kind = ".parquet" if name in batch.PARQUET | batch.BY_DATE else ".csv"
        assert kind in found, name
    assert {*REPORTS, "peak_hours", "top3_hours", "payment_pivot", "payment_counts"} <= set(stored)
    exports = {p.name for p in Path(out, "exports").iterdir()}
    assert exports == {
        "hourly_distribution",
        "top_pickup_zones",
        "payment_distribution",
        "payment_by_date",
        "ridesharing_hourly",
        "savings_summary",
        "sample_data",
    }
    assert stored["share_groups"].count() == sharing.share_groups(trips).count()


@pytest.mark.parametrize("name", sorted(batch.BY_DATE))
def test_row_level_results_are_pruned_by_date(ran, name):
    one_day = charts.between_days(ran[1][name], date(2024, 1, 8), date(2024, 1, 8))
    assert "PartitionFilters: [isnotnull(trip_date" in plan(one_day)


def test_exports_hold_every_month(spark, trips, tmp_path):
    later = trips.withColumn("trip_date", F.date_add("trip_date", 60))
    by_date = report(later, "payment_by_date")
    kept = charts.between_days(by_date)
    assert kept.count() == report(trips, "payment_by_date").count() > 100
    assert charts.between_days(by_date, date(2024, 1, 1), date(2024, 1, 31)).count() == 0


def test_a_column_named_n_changes_nothing(spark, sf_dir, trips):
    table, odd = driver_tables.zones(spark, sf_dir), trips.withColumn("n", F.lit(5))
    for rank in (
        zones.match_rate,
        zones.borough_flows,
        lambda t, z: zones.top_zones(t, z, "pickup"),
        lambda t, z: zones.borough_stats(t, z, "dropoff"),
        lambda t, z: zones.top_zones_by_length(t, z, "pickup", True),
    ):
        assert rank(odd, table).collect() == rank(trips, table).collect()


def test_missing_columns_are_an_error(spark, raw, tmp_path):
    path = str(tmp_path / "renamed")
    writers.write_parquet(raw.withColumnRenamed("passenger_count", "riders"), path)
    for schema in (TRIPS, None):
        with pytest.raises(ValueError, match="passenger_count"):
            readers.read_trips(spark, path, schema)
    read = readers.read_trips(spark, path, optional=["passenger_count"])
    assert read.filter("passenger_count is not null").isEmpty()


def test_french_labels_from_trips_and_from_totals(spark, raw, tmp_path):
    french = batch.prepare_table(raw, str(tmp_path), FRENCH)
    folded = batch.save(fold(french, FRENCH), str(tmp_path), "folded")
    merged = all_reports(time_part(folded), band_part(folded), FRENCH)
    for name in ("payment_by_day", "weekend_period", "profile_distribution"):
        direct = report(french, name, FRENCH)
        keys = REPORTS[name].keys.split()
        assert direct.select(keys).collect() == merged[name].select(keys).collect()
    labels = {r.payment_type_label for r in merged["payment_by_day"].collect()}
    assert labels == set(FRENCH.payments)


def test_files_with_other_column_types(spark, raw, tmp_path):
    other = raw.withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("double"),
            "tpep_pickup_datetime": F.col("tpep_pickup_datetime").cast("timestamp"),
            "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime").cast("timestamp"),
        }
    )
    writers.write_parquet(other, str(tmp_path / "other"))
    read = readers.read_trips(spark, str(tmp_path / "other"), schema=None)
    groups = sharing.share_groups(batch.prepare_table(read, str(tmp_path)))
    assert dict(groups.dtypes)["total_passengers"] == "double"
    assert groups.count() == sharing.share_groups(prepare(raw)).count()


def test_raw_files_have_the_declared_columns(spark, raw_files):
    assert readers.read_trips(spark, raw_files[0]).schema == TRIPS


def test_command_line_names_its_arguments():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-m", "tripweave", "--help"], cwd=root, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0 and "--trips" in done.stdout


def test_reading_lists_once_and_reads_one_footer(spark, sf_dir, tmp_path):
    """Nor does a read of declared types look at the files a second time."""
    path = str(tmp_path / "prepared")
    writers.write_by_date(driver_tables.prepared_trips(spark, sf_dir), path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one read", "")
    trips = readers.read_cleaned(spark, path)
    jobs = tracker.getJobIdsForGroup("one read")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 1
    assert trips.schema.names == PREPARED.names
    assert [f.dataType for f in trips.schema] == [f.dataType for f in PREPARED]
