"""Append the share groups that became final: ``python -m tripweave.streaming``.

One call works off the trip files that are new since the last call on the same checkpoint,
so it can be run by any timer.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tripweave.functions import labels as L
from tripweave.streaming import share_groups


def main(arguments: list[str] | None = None) -> share_groups.Run:
    parser = argparse.ArgumentParser(prog="tripweave.streaming", description=__doc__)
    parser.add_argument("--trips", required=True, help="folder of raw trips as Parquet, growing")
    parser.add_argument("--out", required=True, help="folder of the share groups given out")
    parser.add_argument("--checkpoint", required=True, help="folder that says what is done")
    parser.add_argument("--minutes", type=int, default=L.BUCKET_MINUTES)
    parser.add_argument("--at-least", type=int, default=L.MIN_GROUP)
    parser.add_argument("--late", default=share_groups.LATE, help="how late a trip may come")
    parser.add_argument("--files-per-batch", type=int, help="only where files arrive in order")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tripweave-streaming").getOrCreate()
    run = share_groups.append_groups(
        spark,
        given.trips,
        given.out,
        given.checkpoint,
        given.minutes,
        given.at_least,
        given.late,
        given.files_per_batch,
    )
    print(f"{run.batches} batches, {run.rows_read} trips read, {run.rows_too_late} too late")
    return run


if __name__ == "__main__":
    main()
