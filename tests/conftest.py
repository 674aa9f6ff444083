"""One local session for all tests, and tables of literal rows."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from support import trip  # noqa: E402
from tripweave.sources.schemas import TRIPS, ZONES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tripweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def trips_of(spark):
    """Literal raw trips, one keyword dict each."""

    def make(*rows: dict):
        full = [trip(**r) for r in rows]
        return spark.createDataFrame([tuple(r[n] for n in TRIPS.names) for r in full], TRIPS)

    return make


@pytest.fixture
def zones_of(spark):
    def make(*rows: tuple):
        return spark.createDataFrame([(*r, "") for r in rows], ZONES)

    return make
