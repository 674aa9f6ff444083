"""Trip, zone and stored-result readers, and row sampling."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from tripweave.sources import schemas

# The columns that tell trips apart, of the exported sample, of the preview.
SAMPLE_KEYS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "payment_type",
)
SAMPLE_COLUMNS = (
    "trip_distance_km",
    "trip_duration_minutes",
    "average_speed_kmh",
    "hour",
    "day_name",
    "fare_amount",
    "tip_percentage",
    "payment_type_label",
    "trip_category",
    "time_period",
)
PREVIEW_COLUMNS = (
    "tpep_pickup_datetime",
    "trip_distance_km",
    "trip_duration_minutes",
    "average_speed_kmh",
    "hour",
    "day_name",
    "time_period",
    "trip_category",
    "fare_amount",
    "tip_percentage",
)


def read_trips(
    spark: SparkSession,
    path: str,
    schema: StructType | None = schemas.TRIPS,
    optional: Collection[str] = (),
) -> DataFrame:
    """Raw trips from Parquet. Pass ``schema=None`` for files whose own column types
    differ from the declared ones. Columns that the files lack are an error, unless
    they are named as ``optional``; these read as nulls."""
    return _read(spark, path, schema, schemas.TRIPS, optional)


def _read(
    spark: SparkSession,
    path: str,
    schema: StructType | None,
    needed: StructType,
    optional: Collection[str],
) -> DataFrame:
    found = spark.read.parquet(path)
    own = {f.name.lower(): f for f in found.schema.fields}
    lacking = [f for f in (schema or needed).fields if f.name.lower() not in own]
    if missing := [f.name for f in lacking if f.name not in optional]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    if schema is None:
        return found.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    # Files of exactly these types serve the very frame that was inspected, so they are
    # listed once and one footer is read; others are read again in the declared types.
    if any(own[f.name.lower()].dataType != f.dataType for f in schema.fields if f not in lacking):
        return spark.read.schema(schema).parquet(path)
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in lacking}
    return found.withColumns(nulls).select(*(F.col(f.name).alias(f.name) for f in schema.fields))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone table from CSV with a header. Texts such as ``N/A`` stay texts."""
    return spark.read.schema(schemas.ZONES).option("header", True).csv(path)


def read_cleaned(
    spark: SparkSession,
    path: str,
    schema: StructType | None = schemas.PREPARED,
    optional: Collection[str] = (),
) -> DataFrame:
    """Prepared trips, stored by ``trip_date``; filters on it skip whole folders."""
    return _read(spark, path, schema, schemas.PREPARED, optional)


def sample_trips(trips: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Random rows; repeatable for one seed and one layout of the input."""
    return trips.sample(fraction=fraction, seed=seed)


def hash_sample(trips: DataFrame, fraction: float, keys: Sequence[str] = SAMPLE_KEYS) -> DataFrame:
    """Rows whose key hash falls in the lowest ``fraction``: the same rows on every
    run and layout. Copies of one trip are kept or left together."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")

    def text(name: str) -> Column:
        c = F.col(name)
        if isinstance(trips.schema[name].dataType, (TimestampType, TimestampNTZType)):
            c = F.unix_timestamp(c)
        return F.coalesce(c.cast("string"), F.lit(""))

    digest = F.md5(F.concat_ws("|", *(text(k) for k in keys)))
    return trips.filter(F.substring(digest, 1, 8) < f"{int(fraction * 16**8):08x}")


def samples(trips: DataFrame, random: float, exported: float, seed: int = 42) -> DataFrame:
    """The rows of a random sample and of the exported one from a single scan, marked
    by ``in_random`` and ``in_export``. The export takes a fast hash of the keys."""
    top = int(exported * 2**32)
    hashed = F.xxhash64(*SAMPLE_KEYS).bitwiseAND(F.lit(2**32 - 1))
    marked = trips.withColumns({"in_random": F.rand(seed) < random, "in_export": hashed < top})
    return marked.filter("in_random or in_export")


def sample_export(trips: DataFrame, fraction: float = 0.001) -> DataFrame:
    """The ten columns of the exported sample."""
    return hash_sample(trips, fraction).select(*SAMPLE_COLUMNS)


def preview(
    df: DataFrame, n: int = 10, columns: Sequence[str] | None = None, ordered: bool = False
) -> DataFrame:
    """Some first rows, from as little of the table as it takes. With ``ordered``, the
    first by the shown columns: the same rows on every run, for a scan of them all."""
    shown = df.select(*(columns or df.columns))
    return (shown.orderBy(*shown.columns) if ordered else shown).limit(n)
