"""Vector code compression: product codes with value dictionaries per dimension.

Components become whole numbers, floor(scale * x), and a vector is cut into ``parts``
equal runs of dimensions. Each part has a codebook of at most ``entries`` vectors of whole
numbers, which ``rounds`` of exact integer k-means refine; a vector's code is the index of
the nearest entry of each part.

Vectors are packed once into blocks of at most ``BLOCK`` and written: per dimension the
block's sorted distinct integers (its *value dictionary*), and per vector the index into
it. In every round a task tabulates, per dimension, the squared differences between each
distinct integer and that dimension of all entries; a part's distance to all entries is
then the sum of one gathered row per dimension. A block's tables are bounded by the block
and the codebook, whatever the data. Tasks emit sums and counts per entry, at most parts x
entries rows each, which Spark adds up; only the codebooks (bounded the same way) pass
through the driver. All arithmetic is exact, so results do not depend on partitioning.

Codebooks start from the vectors of the ``entries`` smallest ids (ties: by components),
fewer if there are fewer; an entry without vectors stays. Ties of distance go to the
smaller index.

Rows whose vector is null or holds a null or non-finite component are dropped. Rows that
repeat an id are vectors of their own; rows without an id are coded too, but come last
among the starting vectors. The dimension is that of the first starting vector of which
``parts`` divides the size; vectors of another size, empty ones among them, keep their row
with null code and error. Labels may be null and are equal then. Components so large that
sums of squares leave 64 bits are an error that says so. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.runtime import land, ship

#: Vectors of a block at most, so that an index into a dictionary fits 16 bits.
BLOCK = 4096
#: Vectors whose rows are gathered at a time.
STEP = 512
LIMIT = 1 << 62

PACKED = "n int, rows binary, dictionary binary, codes binary"


def whole_numbers(
    vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str
) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part."""
    x = F.col("x")
    kept = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    ).filter(
        x.isNotNull()
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    )

    def integer(c):
        scaled = F.floor(c * float(scale))
        return F.when(F.abs(c * float(scale)) < float(1 << 52), scaled).otherwise(
            F.raise_error(F.lit("a component is too large for exact codes")).cast("long")
        )

    return kept.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform(x, integer).alias("v")
    )


def _pack(matrix: np.ndarray, rows: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    dictionaries, codes = [], np.empty(matrix.shape[::-1], np.uint16)
    for d in range(matrix.shape[1]):
        values, codes[d] = np.unique(matrix[:, d], return_inverse=True)
        dictionaries.append(values)
    sizes = np.array([len(values) for values in dictionaries], np.int64)
    table = np.concatenate([sizes, *dictionaries]).astype(np.int64)
    return len(rows), rows.tobytes(), table.tobytes(), codes.tobytes()


def packed(vectors: DataFrame, dim: int) -> DataFrame:
    """Blocks of vectors of ``dim`` components as value dictionaries and indexes into them."""
    ship(vectors.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def block():
            columns = zip(_pack(np.concatenate([m for m, _ in waiting]), np.concatenate([r for _, r in waiting])))
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 3))],
                ["n", "rows", "dictionary", "codes"],
            )

        held = 0
        for batch in batches:
            rows = batch.column(0).to_numpy().astype(np.int64)
            matrix = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, dim)
            for at in range(0, len(rows), BLOCK // 4):
                piece = rows[at : at + BLOCK // 4]
                if held + len(piece) > BLOCK:
                    yield block()
                    held = 0
                waiting.append((matrix[at : at + BLOCK // 4], piece))
                held += len(piece)
        if held:
            yield block()

    return vectors.filter(F.size("v") == dim).select("row", "v").mapInArrow(work, PACKED)


def _reach(values: np.ndarray, entries: np.ndarray) -> int:
    """The largest difference of a value and an entry."""
    return max(int(values[-1]) - int(entries.min()), int(entries.max()) - int(values[0]))


def nearest(
    dictionaries: list[np.ndarray], codes: np.ndarray, books: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and squared distance, (parts x vectors) each, for the
    vectors of a block. ``books`` is parts x entries x width."""
    parts, _, width = books.shape
    n = codes.shape[1]
    entry, error = np.empty((parts, n), np.int64), np.empty((parts, n), np.int64)
    for part in range(parts):
        own = dictionaries[part * width : (part + 1) * width]
        # Half the memory traffic wherever a part's distances are sure to fit.
        reach = sum(_reach(values, books[part, :, w]) ** 2 for w, values in enumerate(own))
        kind = np.int32 if reach < 1 << 31 else np.int64
        total = np.zeros((n, books.shape[1]), kind)
        for w, values in enumerate(own):
            table = (values[:, None] - books[part, :, w][None, :]).astype(kind)
            table *= table
            index = codes[part * width + w]
            for at in range(0, n, STEP):
                total[at : at + STEP] += table[index[at : at + STEP]]
        entry[part] = total.argmin(axis=1)
        error[part] = total[np.arange(n), entry[part]]
    return entry, error


def _unpack(n: int, rows: bytes, table: bytes, codes: bytes, dim: int):
    table = np.frombuffer(table, np.int64)
    ends = dim + np.cumsum(table[:dim])
    dictionaries = [table[e - s : e] for s, e in zip(table[:dim], ends)]
    return np.frombuffer(rows, np.int64), dictionaries, np.frombuffer(codes, np.uint16).reshape(dim, n)


def _over_blocks(blocks: DataFrame, books: np.ndarray, schema: str, work: Callable) -> DataFrame:
    """``work(rows, dictionaries, codes, entry, error)`` on every block; it returns columns
    or, from blocks seen so far, what ``done`` makes of them at the end."""
    parts, _, width = books.shape
    data = io.BytesIO()
    np.save(data, books)
    sent = blocks.sparkSession.sparkContext.broadcast(data.getvalue())  # parts x entries x width
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.load(io.BytesIO(sent.value))

        def seen():
            for batch in batches:
                for packed_block in zip(*(c.to_pylist() for c in batch.columns)):
                    block = _unpack(*packed_block, parts * width)
                    yield *block, *nearest(block[1], block[2], own)

        for columns in work(seen(), own):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return blocks.mapInArrow(run, schema)


def _sums(blocks, books):
    """Per part and entry that won any vector: their number and the sums of components."""
    parts, entries, width = books.shape
    count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
    for _, dictionaries, codes, entry, _ in blocks:
        for part in range(parts):
            count[part] += np.bincount(entry[part], minlength=entries)
            order = np.argsort(entry[part], kind="stable")
            met, first = np.unique(entry[part][order], return_index=True)
            for w in range(width):
                d = part * width + w
                values = dictionaries[d][codes[d]][order]
                total[part, met, w] += np.add.reduceat(values, first)
    part, entry = np.nonzero(count)
    if len(part):
        sums = [s.tolist() for s in total[part, entry]]
        yield part.astype(np.int32), entry.astype(np.int32), count[part, entry], sums


def _codes(blocks, books):
    for rows, _, _, entry, error in blocks:
        digits = [[f"{i:02x}" for i in column] for column in entry.T.tolist()]
        yield rows, ["".join(d) for d in digits], error.sum(axis=0)


def train(
    vectors: DataFrame, blocks: DataFrame, dim: int, parts: int, entries: int, rounds: int
) -> np.ndarray:
    """Codebooks (parts x entries x width) after the rounds."""
    width = dim // parts
    start = (
        vectors.filter(F.size("v") == dim)
        .orderBy(F.col("vec_id").asc_nulls_last(), "v")
        .limit(entries)
        .select("v")
        .collect()
    )
    books = np.array([r.v for r in start], np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        found = _over_blocks(blocks, books, "part int, entry int, n long, sums array<long>", _sums)
        folded = found.groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            F.array(
                *(F.sum(F.col("sums")[w].cast("decimal(28,0)")).alias(str(w)) for w in range(width))
            ).alias("sums"),
        )
        for row in folded.collect():  # parts x entries rows at most
            books[row.part, row.entry] = [int(s) // row.n for s in row.sums]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) of every row that takes part, and the codebooks
    (None where no vector can be cut). Two hex digits a part, so 256 entries at most."""
    if not 0 < entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    table = land(whole_numbers(vectors, scale, id_col, vector_col, label_col), "vectors")
    fit = table.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = fit.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("dim")).first()
    if first is None:
        none = {"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")}
        return table.select("vec_id", "label").withColumns(none), None
    reach = table.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if first.dim * (2 * reach) ** 2 >= LIMIT:
        raise ValueError(f"components up to {reach} are too large for exact distances in 64 bits")
    blocks = land(packed(table, first.dim), "blocks")
    books = train(table, blocks, first.dim, parts, entries, rounds)
    coded = _over_blocks(blocks, books, "row long, code string, error long", _codes)
    rows = table.select("row", "vec_id", "label")
    return rows.join(coded, "row", "left").drop("row"), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels (nulls together).
    Errors are folded per label before any shuffle and joined back, so a label of a third
    of all rows is one row of the smaller side."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
