"""Sharding by longest-processing-time scheduling, balanced by bytes.

Rows of equal text form a group that stays together. Groups, largest first, each go to
the shard with the least bytes so far, which a heap gives. What goes through the heap is
bounded whatever the size of the corpus: every group of at least a 2^-16 part of all
bytes is an item of its own (2^16 of them at most), and all smaller groups are dealt by
hash into 2^16 bundles, which are the other items. A bundle is about as large as the
smallest single item, so shards end within about one such part of each other unless a
single group is larger than a shard should be.

The size of a row is the UTF-8 bytes of its text plus 1. A null text counts as an empty
one and is in the group of the empty texts. Nulls in the id, repeated rows and extra
columns do no harm: each row is placed. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.runtime import land, partitions

#: Bundles, and the most groups that are items of their own.
ITEMS = 1 << 16


def least_loaded(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """(item, shard) for items (item, size): the largest first, each to the shard with
    the least so far; ties by item and by shard number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for item, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed.append((item, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row. Slots
    count the rows of a shard from 0, in order of id."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = land(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("text_key"),
        ),
        "sizes",
    )
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("size"))
    total = rows.agg(F.sum("size").alias("all_bytes"))
    bundle = F.pmod(F.xxhash64("text_key"), F.lit(ITEMS)).cast("int")
    items = land(
        groups.join(F.broadcast(total))
        .withColumn("alone", F.col("size") * ITEMS >= F.col("all_bytes"))
        .groupBy(F.when(F.col("alone"), F.col("text_key")).alias("group"),
                 F.when(~F.col("alone"), bundle).alias("bundle"))
        .agg(F.sum("size").alias("size")),
        "items",
    )
    numbered = items.orderBy("group", "bundle").collect()
    placed = least_loaded([(i, r["size"]) for i, r in enumerate(numbered)], shards)
    table = spark.createDataFrame(
        [(numbered[i]["group"], numbered[i]["bundle"], shard) for i, shard in placed],
        "group binary, bundle int, shard int",
    )
    of_group = table.filter("group is not null").select(
        F.col("group").alias("text_key"), F.col("shard").alias("group_shard")
    )
    of_bundle = table.filter("bundle is not null").select(
        "bundle", F.col("shard").alias("bundle_shard")
    )
    # Both sides hold 2^16 rows at most.
    dealt = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(of_group), "text_key", "left")
        .join(F.broadcast(of_bundle), "bundle", "left")
        .select(
            "doc_id", "size", "text_crc32", F.coalesce("group_shard", "bundle_shard").alias("shard")
        )
    )
    return with_slots(dealt).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_slots(dealt: DataFrame) -> DataFrame:
    """A number from 0 without gaps within each shard, in order of id. Rows are sorted
    over many tasks, however few shards there are; counts per task and shard, a small
    table, tell where each task's numbers begin."""
    spark = dealt.sparkSession
    place = F.monotonically_increasing_id()
    rows = land(
        dealt.repartitionByRange(partitions(spark), "shard", "doc_id")
        .sortWithinPartitions("shard", "doc_id")
        .withColumn("task", F.shiftright(place, 33).cast("int"))
        .withColumn("row", place.bitwiseAND(F.lit((1 << 33) - 1))),
        "ordered",
    )
    counts = rows.groupBy("shard", "task").agg(
        F.count("*").alias("n"), F.min("row").alias("first_row")
    )
    by_task = Window.partitionBy("shard").orderBy("task")
    offsets = counts.select(
        "shard", "task", "first_row", (F.sum("n").over(by_task) - F.col("n")).alias("before")
    )
    # One row per task and shard at most.
    return rows.join(F.broadcast(offsets), ["shard", "task"]).withColumn(
        "slot", F.col("row") - F.col("first_row") + F.col("before")
    )
