"""``python -m tripweave --trips PATH --zones PATH --out PATH [--language fr]``"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from tripweave.functions.labels import ENGLISH, FRENCH
from tripweave.plans.batch import run
from tripweave.sources.schemas import TRIPS


def main() -> None:
    args = argparse.ArgumentParser(prog="tripweave", description="Run the whole trip batch.")
    args.add_argument("--trips", required=True, help="raw trips, Parquet")
    args.add_argument("--zones", required=True, help="zone table, CSV with a header")
    args.add_argument("--out", required=True, help="folder for all results")
    args.add_argument("--first", type=date.fromisoformat, help="first day of the exported payments")
    args.add_argument("--last", type=date.fromisoformat, help="last day of the exported payments")
    args.add_argument("--language", choices=["en", "fr"], default="en")
    args.add_argument(
        "--file-schema",
        action="store_true",
        help="take column types from the trip files, where they differ from the declared ones",
    )
    args.add_argument(
        "--ordered",
        action="store_true",
        help="trip files are roughly in order of time; write days without a shuffle",
    )
    given = args.parse_args()
    spark = (
        SparkSession.builder.appName("tripweave")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    wording = FRENCH if given.language == "fr" else ENGLISH
    schema = None if given.file_schema else TRIPS
    run(
        spark,
        given.trips,
        given.zones,
        given.out,
        given.first,
        given.last,
        wording,
        schema,
        given.ordered,
    )


if __name__ == "__main__":
    main()
