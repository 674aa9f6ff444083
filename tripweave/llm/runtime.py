"""Small helpers that every operator of this package uses to run on Spark."""

from __future__ import annotations

import ctypes
import io
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.sources.writers import shared_folder

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20
#: Bits that screen rows by key: so many a key, but 8 MB in all at most.
KEY_BITS = 16
MOST_BITS = 1 << 26


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, as
    ``--py-files`` would, once per application."""
    sc = spark.sparkContext
    name = f"tripweave-{sc.applicationId}.zip"
    if any(path.endswith(name) for path in sc.listFiles):
        return
    root = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, f"{root.name}/{path.relative_to(root)}")
    target = Path(SparkFiles.getRootDirectory()) / "shipped" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(data.getvalue())
    sc.addPyFile(str(target))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send texts to Python workers in batches of fewer rows than Spark's own setting, which
    are tens of megabytes of text each; a setting of the session's own stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(rows))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back, so that later
    steps neither compute it again nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed. Spark's cleaner does so once the
    driver's JVM has collected what refers to them, which a driver with memory to spare
    seldom does by itself. Listeners refer to a finished step for a moment more."""
    for _ in range(2):
        time.sleep(0.3)
        spark._jvm.System.gc()


def screened(rows: DataFrame, key: str, ids: DataFrame, count: int) -> DataFrame:
    """The rows with a last column ``_perhaps``: true wherever ``ids`` (one column of about
    ``count`` values) holds the key, and for few others. The bits behind it are broadcast;
    they stay within ``MOST_BITS``, and beyond some millions of ids more rows are true."""
    bits = 1 << 15
    while bits < min(MOST_BITS, KEY_BITS * count):
        bits *= 2

    def slot(column):
        # Of one type on both sides, or equal values had different hashes.
        return F.pmod(F.xxhash64(F.col(column).cast(ids.schema[0].dataType), F.lit("screen")), F.lit(bits))

    places = ids.select(slot(ids.columns[0]).alias("_slot"))
    maps = places.groupBy(F.bitmap_bucket_number("_slot").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")
    )
    at = rows.withColumn("_slot", slot(key)).withColumn("_map", F.bitmap_bucket_number("_slot"))
    byte = "conv(hex(substring(_bits, int(bitmap_bit_position(_slot) div 8) + 1, 1)), 16, 10)"
    held = F.expr(f"getbit(bigint({byte}), int(bitmap_bit_position(_slot) % 8)) = 1")
    found = at.join(F.broadcast(maps), "_map", "left")
    return found.select(*rows.columns, F.coalesce(held, F.lit(False)).alias("_perhaps"))


def without(rows: DataFrame, key: str, ids: DataFrame, count: int) -> DataFrame:
    """The rows whose key ``ids`` (one column of about ``count`` values) does not hold. Only
    rows that it may hold are joined, so the others need no shuffle."""
    marked = screened(rows, key, ids, count)
    held = ids.toDF(key)
    left = marked.filter("_perhaps").join(held, key, "left_anti").select(*rows.columns)
    return marked.filter("not _perhaps").select(*rows.columns).unionByName(left)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system at the end of a task, as Python workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most`` bytes together;
    a longer text is a run of its own."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy()
    first = total = 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and total + size > most:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)


def over_slices(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: int, most: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on every slice of every batch, for ``mapInArrow``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, most):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out
        give_back()

    return run
