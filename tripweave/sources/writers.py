"""Writers, and the shared folder for tables a job writes for its own later steps."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_by_date(trips: DataFrame, path: str, ordered: bool = False) -> None:
    """Parquet by ``trip_date``. The rebalance hint lets Spark merge thin days into
    full-sized tasks and split a day that is too large for one, so neither many
    small files nor one huge task comes of it. Trips that already arrive roughly in
    order of time (``ordered``) need no shuffle: each task meets a few days only.
    """
    balanced = trips if ordered else trips.hint("rebalance", F.col("trip_date"))
    balanced.write.mode("overwrite").partitionBy("trip_date").parquet(path)


def write_single_csv(result: DataFrame, path: str) -> None:
    """One CSV file, for results with a handful of rows (a day-by-label table at
    most). Row-level data goes through ``write_csv``."""
    write_csv(result.coalesce(1), path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is
    unset; both are shared by all executors on a cluster. It is removed when the
    session's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            warnings.warn(
                f"spark.checkpoint.dir is unset and the warehouse is {base}: unless all executors "
                "share that folder, set spark.checkpoint.dir to storage that they do",
                stacklevel=2,
            )
    path = f"{base.rstrip('/')}/tripweave-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path


def landed(df: DataFrame, name: str) -> DataFrame:
    """Written to a folder of its own in the shared place and read back, so that later steps
    neither compute it again nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of every file at a path, to notice that a table has changed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return tuple(
        sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files)
    )
