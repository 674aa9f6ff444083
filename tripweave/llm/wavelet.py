"""Token ids of documents in shard files, each a compressed wavelet matrix.

A shard file holds the ids of a run of documents as bit-planes, highest bit first: the
plane of a bit lists it for every position, then the positions are dealt stably into
those with 0 and those with 1 for the next plane. With counts of ones at block starts a
plane answers rank and select, and from these the file gives any id (``access``), how
often an id occurs before a position (``rank``) and where its n-th occurrence is
(``select``), reading a few blocks only. Planes are stored as zstandard blocks; where
compression does not help, a block is stored as it is.

Layout: magic, header length, JSON header (counts, offsets), document table, blocks.

``write_shards`` sorts by id across the cluster; every task streams its range and
closes a file after ``shard_tokens`` ids. A file is written under a name of its own and
becomes part of the result by its row in the manifest, which Spark commits once per
task; what a lost or repeated attempt has left behind is never read. Files are written
and read through ``pyarrow.fs``, so the folder may be in any store it knows.

Null texts are empty documents and hold the end id alone. Rows with equal ids follow
each other in order of text. A null id sorts first. An empty table gives no files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.bpe import word_encoder
from tripweave.llm.runtime import land, partitions, ship, slices

MAGIC = b"TWWM0001"
#: Bytes of a plane per compressed block.
BLOCK = 1 << 15
SHARD_TOKENS = 1 << 22
MANIFEST = "path string, shard long, first_doc long, n_docs long, n_tokens long"


def pack(ids: np.ndarray, doc_ids: list, ends: np.ndarray) -> bytes:
    """The shard file of documents whose ids end at ``ends``."""
    top = int(ids.max()) if len(ids) else 0
    current = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1)
    planes, blocks = [], []
    for bit in range(max(1, top.bit_length()) - 1, -1, -1):
        ones = (current >> bit) & 1 == 1
        packed = np.packbits(ones)
        index, count = [], 0
        for at in range(0, len(packed), BLOCK):
            raw = packed[at : at + BLOCK]
            small = squeeze.compress(raw.tobytes())
            blocks.append(small if len(small) < len(raw) else raw.tobytes())
            index.append((len(blocks[-1]), count))
            count += int(np.bitwise_count(raw).sum())
        planes.append({"zeros": len(ids) - count, "blocks": index})
        current = np.concatenate([current[~ones], current[ones]])
    table = json.dumps([doc_ids, np.diff(ends, prepend=0).tolist()]).encode()
    table = squeeze.compress(table)
    header = {"n": len(ids), "planes": planes, "table": len(table)}
    head = squeeze.compress(json.dumps(header).encode())
    return b"".join([MAGIC, struct.pack("<Q", len(head)), head, table, *blocks])


class WaveletMatrix:
    """One shard file. Blocks are read when asked for."""

    def __init__(self, data):
        """``data``: the file's bytes, or an open file with ``read_at``."""
        self._data = data
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a token shard")
        size = struct.unpack("<Q", self._read(8, 8))[0]
        self._zstd = zstandard.ZstdDecompressor()
        header = json.loads(self._zstd.decompress(self._read(16, size)))
        table = self._zstd.decompress(self._read(16 + size, header["table"]))
        self.doc_ids, counts = json.loads(table)
        self.ends = np.cumsum(counts, dtype=np.int64) if counts else np.zeros(0, np.int64)
        self.n, self._planes, self._cache = header["n"], header["planes"], {}
        at = 16 + size + header["table"]
        for plane in self._planes:
            plane["at"], plane["ones"] = [], []
            for length, ones in plane["blocks"]:
                plane["at"].append((at, length))
                plane["ones"].append(ones)
                at += length

    def _read(self, at: int, size: int) -> bytes:
        if isinstance(self._data, (bytes, memoryview)):
            return bytes(self._data[at : at + size])
        return self._data.read_at(size, at)

    def _block(self, plane: int, number: int, keep: bool = True) -> np.ndarray:
        if (plane, number) in self._cache:
            return self._cache[plane, number]
        at, size = self._planes[plane]["at"][number]
        full = min(BLOCK, (self.n + 7) // 8 - number * BLOCK)
        raw = self._read(at, size)
        bits = np.frombuffer(raw if size == full else self._zstd.decompress(raw), np.uint8)
        if keep:
            self._cache[plane, number] = bits
        return bits

    def _bit(self, plane: int, i: int) -> int:
        return int(self._block(plane, i // (8 * BLOCK))[i // 8 % BLOCK] >> (7 - i % 8) & 1)

    def _ones(self, plane: int, i: int) -> int:
        """Ones before position i of a plane."""
        if i == 0:
            return 0
        number = (i - 1) // (8 * BLOCK)
        bits, rest = self._block(plane, number), i - number * 8 * BLOCK
        count = self._planes[plane]["ones"][number] + int(np.bitwise_count(bits[: rest // 8]).sum())
        return count + (int(bits[rest // 8] >> (8 - rest % 8)).bit_count() if rest % 8 else 0)

    def _select(self, plane: int, bit: int, k: int) -> int:
        """The position of the k-th (from 0) one or zero of a plane."""
        ones = self._planes[plane]["ones"]
        before = ones if bit else [8 * BLOCK * i - x for i, x in enumerate(ones)]
        number = bisect_right(before, k) - 1
        bits = np.unpackbits(self._block(plane, number))
        return number * 8 * BLOCK + int(np.flatnonzero(bits == bit)[k - before[number]])

    def access(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, plane in enumerate(self._planes):
            bit, ones = self._bit(p, i), self._ones(p, i)
            value = value << 1 | bit
            i = plane["zeros"] + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where a token's occurrences before ``end`` lie after the last plane."""
        if token >> len(self._planes):
            return 0, 0
        a, b = 0, min(end, self.n)
        for p, plane in enumerate(self._planes):
            ones_a, ones_b = self._ones(p, a), self._ones(p, b)
            if token >> (len(self._planes) - 1 - p) & 1:
                a, b = plane["zeros"] + ones_a, plane["zeros"] + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def rank(self, token: int, end: int) -> int:
        """How often a token occurs before position ``end``."""
        a, b = self._range(token, end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The position of a token's k-th occurrence, from 0."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for p in range(len(self._planes) - 1, -1, -1):
            zeros = self._planes[p]["zeros"]
            bit = token >> (len(self._planes) - 1 - p) & 1
            i = self._select(p, bit, i - zeros if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        wide = len(self._planes) > 16
        current = np.zeros(self.n, np.uint32 if wide else np.uint16)
        for p in range(len(self._planes) - 1, -1, -1):
            plane = self._planes[p]
            parts = [self._block(p, i, keep=False) for i in range(len(plane["at"]))]
            ones = np.unpackbits(np.concatenate([*parts, np.zeros(0, np.uint8)]), count=self.n)
            ones = ones.view(bool)
            before = np.empty_like(current)
            before[~ones] = current[: plane["zeros"]]
            place = current.dtype.type(1 << (len(self._planes) - 1 - p))
            before[ones] = current[plane["zeros"] :] | place
            current = before
        return current.astype(np.uint32)


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Encode, append ``end_id`` to each document and write shards in ascending order
    of id. Returns the manifest, itself a written table below ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    ordered = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).cast("string").alias("text"),
        )
        .repartitionByRange(4 * partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", "text", F.spark_partition_id().alias("task"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        store, root = fs.FileSystem.from_uri(folder)
        held, names, lengths, shard, task = [], [], [], 0, 0

        def close():
            nonlocal held, names, lengths, shard
            path = f"{root}/{task:06d}-{shard:06d}-{uuid.uuid4().hex}.twm"
            data = pack(np.concatenate(held), names, np.cumsum(lengths))
            with store.open_output_stream(path) as file:
                file.write(data)
            row = [path, (task << 32) + shard, names[0], len(names), int(sum(lengths))]
            held, names, lengths, shard = [], [], [], shard + 1
            kinds = [pa.string(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                ["path", "shard", "first_doc", "n_docs", "n_tokens"],
            )

        for batch in batches:
            for part in slices(batch, 1):
                flat, offsets = encoder.encode(part.column(1))
                task = part.column(2)[0].as_py()
                held.append(np.insert(flat, offsets[1:], end_id).astype(np.uint32))
                names += part.column(0).to_pylist()
                lengths += (np.diff(offsets) + 1).tolist()
                if sum(map(len, held)) >= shard_tokens:
                    yield close()
        if held:
            yield close()

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    rows = ordered.mapInArrow(write, MANIFEST)
    rows.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids before each shard. There is one row per file
    of some megabytes, so the running sum is over few rows: first by task, whose shards
    are few, then over the tasks."""
    by_task = manifest.groupBy(F.shiftright("shard", 32).alias("task")).agg(
        F.sum("n_tokens").alias("n")
    )
    tasks = by_task.select(
        "task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before")
    )
    inside = Window.partitionBy("task").orderBy("shard")
    return (
        manifest.withColumn("task", F.shiftright("shard", 32))
        .join(tasks, "task")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
        .drop("task", "before")
    )


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    ship(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = land(shard_starts(manifest).select("path", "start"), "shards")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as file:
                    shard = WaveletMatrix(memoryview(file.readall()))
                ids, ends = shard.ids().astype("<u4"), shard.ends
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(begins + start, pa.int64()),
                     pa.array(ends - begins, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = files.repartition(4 * partitions(spark), F.xxhash64("path"))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
