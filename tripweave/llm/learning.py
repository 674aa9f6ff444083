"""Learning from all labelled rows of a table, on all tasks at once.

Rows are dealt to *shards* by a hash of their key, so a shard's size is bounded and its
rows do not depend on how the table is stored. In a round, every shard goes on from the
same parameters and learns from its own rows; what the shards changed is then averaged
(iterative parameter mixing). Changes are summed as fixed-point numbers, which no order
of summation alters. Only the parameters pass through the driver, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.runtime import give_back, land, let_go, partitions, screened

#: One in fixed-point numbers.
ONE = float(1 << 36)
#: Rows of parameters that travel together.
BLOCK = 1024
#: Margins are folded in steps of one part of this, up to ``FAR`` on either side.
STEPS = 1024
FAR = 64.0
#: What marks a text where a label's row has the label; it comes after all labels.
TEXT = 2


def dealt(rows: DataFrame, key: str, count: int, shard_rows: int) -> DataFrame:
    """The rows with their shard in front, each shard a partition, in order of a hash of
    the key and of the columns. ``count`` is the number of rows, or a little more."""
    n = max(1, -(-count // shard_rows))
    shard = F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(n)).cast("int")
    return (
        rows.select(shard.alias("shard"), "*")
        .repartitionById(n, F.col("shard"))
        .sortWithinPartitions(F.xxhash64(key), *rows.columns)
    )


def labelled(
    docs: DataFrame,
    usable: DataFrame,
    count: int,
    learnt: Column,
    id_col: str,
    text_col: str,
    shard_rows: int,
    every: int,
) -> DataFrame:
    """shard, label, held and text of every document for which ``learnt`` holds and that
    has a label (``usable``: doc_id, label), written. A repeated id is learnt once, by
    its smallest text. Of a shard's rows every ``every``-th is held back."""
    texts = docs.filter(learnt).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    # Texts travel once, to their shard, and few that have no label; there they meet it.
    some = screened(texts, "doc_id", usable.select("doc_id"), count).filter("_perhaps")
    both = some.select("doc_id", F.lit(TEXT).alias("mark"), "text").unionByName(
        usable.select("doc_id", F.col("label").cast("int").alias("mark"), F.lit(None).cast("string").alias("text"))
    )

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, label, seen, before = None, None, 0, None
        for batch in batches:
            keep, labels, held = [], [], []
            plain = (batch.column(c).to_pylist() for c in range(3))
            for row, (shard, doc, mark) in enumerate(zip(*plain)):
                if shard != before:
                    seen, before = 0, shard
                if mark != TEXT:
                    wanted, label = doc, mark
                elif doc == wanted:
                    keep.append(row)
                    labels.append(label)
                    held.append(seen % every == 0)
                    wanted, seen = None, seen + 1
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), pa.array(labels, pa.int32()), pa.array(held, pa.bool_()), kept.column(3)],
                ["shard", "label", "held", "text"],
            )

    rows = dealt(both, "doc_id", count, shard_rows)
    rows = land(rows.mapInArrow(once, "shard int, label int, held boolean, text string"), "labelled")
    let_go(docs.sparkSession)
    return rows


def parts(rows: DataFrame) -> tuple[dict[int, int], DataFrame, DataFrame]:
    """How many rows have either label, the rows to train on and the rows to judge by: all
    rows for both, if those held back or the others lack a label."""
    counts = {(r.label, r.held): r["count"] for r in rows.groupBy("label", "held").count().collect()}
    each = {y: counts.get((y, False), 0) + counts.get((y, True), 0) for y in (0, 1)}
    if all(counts.get((y, h)) for y in (0, 1) for h in (False, True)):
        return each, rows.filter("not held"), rows.filter("held")
    return each, rows, rows


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Each shard's number (the first column) and its rows, in batches."""

    def pieces():
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield int(shards[a]), batch.slice(a, b - a)

    for shard, own in groupby(pieces(), key=lambda piece: piece[0]):
        yield shard, (batch for _, batch in own)


Learn = Callable[[int, np.ndarray, Iterator[pa.RecordBatch]], np.ndarray]


def mixed(
    rows: DataFrame, learn: Learn, start: np.ndarray, one: float = ONE, shards: int | None = None
) -> np.ndarray:
    """The parameters (a matrix) after one round. ``learn`` gets a shard's number, a copy of
    the parameters and the shard's batches, and returns what they became. A row of the
    matrix moves by the mean change over the shards that moved it, or over ``shards``.
    Changes are whole multiples of 1 / ``one``; a task sums those of all its shards."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(start)
    kind, width = start.dtype, start.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = held.value
        total, moved = np.zeros(begin.shape, np.int64), np.zeros(len(begin), np.int64)
        for shard, own in shards_of(batches):
            change = learn(shard, begin.copy(), own) - begin
            change = np.rint(change.astype(np.float64) * one).astype(np.int64)
            total += change
            moved += change.any(axis=1)
        for low in range(0, len(begin), BLOCK):
            part = slice(low, low + BLOCK)
            if moved[part].any():
                sums = np.concatenate([moved[part, None], total[part]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([low], pa.int64()), pa.array([_planes(sums)], pa.binary())], ["low", "sums"]
                )
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for low, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = _numbers(data.as_buffer()).reshape(-1, width + 1)
                sums[low] = sums[low] + own if low in sums else own
        for low, own in sums.items():
            by = np.maximum(own[:, :1], 1) if shards is None else shards
            mean = (own[:, 1:] / one / by).astype(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([low], pa.int64()), pa.array([mean.tobytes()], pa.binary())], ["low", "mean"]
            )

    blocks = rows.mapInArrow(work, "low long, sums binary")
    tasks = min(partitions(spark), -(-len(start) // BLOCK))
    found = blocks.repartition(tasks, "low").mapInArrow(add, "low long, mean binary").toArrow()
    held.destroy()
    out = start.copy()
    for low, mean in zip(found.column("low").to_pylist(), found.column("mean")):
        out[low : low + BLOCK] += np.frombuffer(mean.as_buffer(), kind).reshape(-1, width)
    return out


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, the sign in the lowest bit, so that the
    empty planes of small numbers take no room in a compressed shuffle."""
    flat = values.ravel()
    return ((flat << 1) ^ (flat >> 63)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    coded = np.ascontiguousarray(planes.T).view(np.uint64).ravel()
    return ((coded >> np.uint64(1)) ^ (~(coded & np.uint64(1)) + np.uint64(1))).view(np.int64)


def folded(margins: DataFrame, *by: str) -> pa.Table:
    """Margins, down to a whole step, of judged rows by label (and ``by``), with their
    numbers."""
    step = F.floor(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), "margin")) * STEPS) / STEPS
    each = margins.withColumn("margin", step).groupBy(*by, "label", "margin").count()
    return each.orderBy(*by, "margin", "label").toArrow()
