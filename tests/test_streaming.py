"""Share groups of arriving trips: late ones, restarts, and the batch result."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from support import NOON
from tripweave.operators.sharing import share_groups
from tripweave.operators.cleaning import prepare
from tripweave.streaming import share_groups as streaming
from tripweave.streaming.__main__ import main


def folders(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")


def minute(m):
    return {"tpep_pickup_datetime": NOON + timedelta(minutes=m)}


def arrive(trips_of, source, *minutes):
    trips_of(*(minute(m) for m in minutes)).write.mode("append").parquet(source)


def starts(spark, out):
    found = streaming.final_groups(spark, out)
    return sorted((r.first_pickup, r.n_trips) for r in found.collect())


def test_groups_come_once_they_are_final(spark, trips_of, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    arrive(trips_of, source, 0, 1, 6)
    run = streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    assert run.rows_read == 3 and starts(spark, out) == []
    # Minute 2 is late, but within ten minutes of minute 6; minute 20 closes both buckets.
    arrive(trips_of, source, 2, 7, 20)
    streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    assert starts(spark, out) == [(NOON, 3), (NOON + timedelta(minutes=6), 2)]


def test_too_late_trips_are_counted_and_left_out(spark, trips_of, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    arrive(trips_of, source, 0, 1, 60)
    streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    arrive(trips_of, source, 2, 90)
    run = streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    assert run.rows_too_late == 1
    assert starts(spark, out) == [(NOON, 2)]


def test_runs_without_news_change_nothing(spark, trips_of, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    arrive(trips_of, source, 0, 1, 30)
    streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    for _ in range(2):
        run = streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
        assert run.rows_read == 0
    assert starts(spark, out) == [(NOON, 2)]


def test_a_run_broken_off_is_taken_up_again(spark, trips_of, tmp_path):
    """A batch that fails writes nothing; the next run on its checkpoint works it off whole."""
    source, out, checkpoint = folders(tmp_path)
    arrive(trips_of, source, 0, 1, 30)
    groups = streaming.stream_groups(spark.readStream.schema(trips_of().schema).parquet(source), late="10 minutes")
    broken = groups.withColumn("n_trips", F.raise_error(F.lit("broken off")).cast("long"))
    failed = False
    try:
        broken.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start(out).awaitTermination()
    except Exception:
        failed = True
    assert failed
    streaming.append_groups(spark, source, out, checkpoint, late="10 minutes")
    assert starts(spark, out) == [(NOON, 2)]


def test_stream_equals_batch_where_all_is_final(spark, trips_of, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    minutes = [(i * 7) % 60 + i / 9 for i in range(60)]
    arrive(trips_of, source, *minutes[:30])
    arrive(trips_of, source, *minutes[30:])
    arrive(trips_of, source, 500)
    streaming.append_groups(spark, source, out, checkpoint)
    raw = trips_of(*(minute(m) for m in minutes))
    batch = share_groups(prepare(raw))
    got = streaming.final_groups(spark, out).select(*batch.columns)
    assert got.count() == batch.count() > 0

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())

    assert rows(got) == rows(batch)
    assert got.dtypes == batch.dtypes


def test_the_command_works_off_what_is_new(spark, trips_of, tmp_path):
    source, out, checkpoint = folders(tmp_path)
    arrive(trips_of, source, 0, 1, 60)
    given = ["--trips", source, "--out", out, "--checkpoint", checkpoint, "--late", "10 minutes", "--files-per-batch", "9"]
    assert main(given).rows_read == 3
    assert main(given).rows_read == 0
    assert starts(spark, out) == [(NOON, 2)]
