"""Exact top-k search by MaxScore over shards of integer vectors.

Terms are vector components; a term's posting list in a shard is a column of values. A
query's terms are taken in the order of how far their contributions can reach in the shard,
and split by the query's running k-th best score: *non-essential* are the last ones, whose
bounds together stay below it, so that no vector gets there by them alone; the others are
*essential*, and their postings are traversed for every vector still in play. Whatever is
left of a vector is bounded twice: by the largest contributions the remaining terms have in
the shard, and by the norms of the remaining parts of query and vector. After every few
terms those vectors drop out whose partial score plus the smaller bound cannot reach the
k-th best; non-essential terms are probed for the others alone, while any is competitive.

The k-th best starts from a seed shard: the k best scores of a query among a few vectors are
a lower bound of its final ones. It is handed on to every shard with the query, and rises
within a shard by the full scores of the vectors that lead. Nothing is approximated: a
vector is left out only if it cannot reach the k-th score.

Vectors are dealt by hash into shards and queries into blocks of about ``BLOCK``. Every
shard is sent once; the blocks, which are the smaller side, are sent to each shard. A piece
of work is a shard and a block, of bounded size, and the best of each piece are merged per
query, partially before the shuffle.

Components become floor(scale * x). Vectors that are null, empty, or hold a null or
non-finite component take no part, nor do rows without an id. Rows that repeat an id are
one vector, the smallest. Only vectors of a query's own dimension are compared with it.
Ties go to the smaller id. Components so large that a product sum could leave 53 bits, within
which all arithmetic is exact, are an error that says so. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.runtime import land, partitions, ship

#: Components of a shard at most, and vectors at least.
SHARD_VALUES = 1 << 20
LEAST = 256
BLOCK = 256
#: Vectors of a dimension that give a query its first threshold.
SEED = 512
#: Terms between two tests of who is still in play.
STEP = 4
EXACT = 1 << 53
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(
    vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, v): one row per id, all components whole numbers."""
    x = F.col("x")
    whole = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")
    ).filter(
        F.col("vec_id").isNotNull()
        & (F.size(x) > 0)
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    )
    floors = F.transform(x, lambda c: F.floor(c * float(scale)).cast("long"))
    return whole.select("vec_id", floors.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def best_of_shard(
    queries: np.ndarray, query_ids, matrix: np.ndarray, ids: np.ndarray, k: int, limits=None, work=None
):
    """(query, vec_id, score) of the k best of a shard for each query; exact. Below its
    entry in ``limits``, if there are any, nothing need be given. ``work`` collects the
    numbers of products."""
    order_by_id = np.argsort(ids, kind="stable")
    matrix, ids = matrix[order_by_id].astype(np.float64), ids[order_by_id]
    high, low = matrix.max(axis=0), matrix.min(axis=0)
    columns = np.ascontiguousarray(matrix.T)
    squares = columns * columns
    norms = squares.sum(axis=0)
    for number, (query, query_id) in enumerate(zip(np.asarray(queries, np.float64), query_ids)):
        limit = -np.inf if limits is None else limits[number]
        top = np.where(query > 0, query * high, query * low)
        reach = top - np.where(query > 0, query * low, query * high)
        terms = np.argsort(-reach, kind="stable")
        rest = np.concatenate([np.cumsum(top[terms][::-1])[::-1], [0]])
        length = np.sqrt(np.concatenate([np.cumsum(query[terms][::-1] ** 2)[::-1], [0]]))
        at = np.flatnonzero(ids != query_id)
        sums, left, done = np.zeros(len(at)), norms[at], 0
        # Essential terms: the fewest after which the others cannot lift a vector by themselves.
        alone = np.minimum(rest, length * np.sqrt(norms.max(initial=0)))
        essential = int(np.argmax(alone < limit)) if (alone < limit).any() else len(terms)
        led = False
        while done < len(terms) and len(at):
            some = terms[done : done + STEP]
            whole = len(at) == len(ids)
            seen = columns[some] if whole else columns[some][:, at]
            sums = sums + query[some] @ seen
            left = left - (squares[some] if whole else squares[some][:, at]).sum(axis=0)
            done += len(some)
            if work is not None:
                work.append(len(some) * len(at))
            if not led and 2 * done >= min(essential, len(terms)):
                # The vectors that lead so far, in full: the k-th of them is a threshold.
                lead = at[np.argpartition(-sums, k - 1)[:k]] if len(at) > k else at
                if len(lead) == k:
                    limit = max(limit, float((matrix[lead] @ query).min()))
                led = True
            bound = np.minimum(rest[done], length[done] * np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6)
            stay = sums + bound >= limit
            if not stay.all():
                at, sums, left = at[stay], sums[stay], left[stay]
        best = np.lexsort((ids[at], -sums))[:k]
        for i in best.tolist():
            yield query_id, int(ids[at[i]]), int(sums[i])


def _blobs(vectors: DataFrame, pieces: str, count: Column) -> DataFrame:
    """Vectors packed per (number, dimension): ids and components as binary columns."""
    dealt = vectors.withColumn(pieces, F.pmod(F.xxhash64("vec_id"), count))
    spark = vectors.sparkSession

    def pack(table: pa.Table) -> pa.Table:
        values = np.asarray(table.column("v").combine_chunks().values, np.int64)
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        return pa.table(
            {
                pieces: table.column(pieces).slice(0, 1).cast(pa.int64()),
                "dim": pa.array([len(values) // len(ids)], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "values": pa.array([values.tobytes()], pa.binary()),
            }
        )

    ship(spark)
    return (
        dealt.withColumn("dim", F.size("v"))
        .groupBy(pieces, "dim")
        .applyInArrow(pack, f"{pieces} long, dim int, ids binary, values binary")
    )


def _seeded(blocks: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """Blocks with the k-th best score of each query among the first ``SEED`` vectors of its
    dimension by hash: at most ``SEED`` vectors a dimension travel."""
    first = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    few = table.withColumn("dim", F.size("v")).withColumn("n", F.row_number().over(first))
    seeds = _blobs(few.filter(F.col("n") <= SEED).select("vec_id", "v"), "seed", F.lit(1))
    joined = blocks.join(seeds.select("dim", "ids", F.col("values").alias("seeds")), "dim", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            limits = []
            for dim, query_ids, asked, ids, seeds in zip(*(c.to_pylist() for c in batch.columns[1:])):
                wanted = np.frombuffer(asked, np.int64).reshape(-1, dim).astype(np.float64)
                known, own = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                scores = wanted @ np.frombuffer(seeds, np.int64).reshape(-1, dim).T.astype(np.float64)
                scores[known[None, :] == own[:, None]] = -np.inf
                enough = scores.shape[1] >= k
                limits.append((np.partition(scores, -k)[:, -k] if enough else np.full(len(own), -np.inf)).tobytes())
            columns = [*batch.columns[:4], pa.array(limits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "dim", "query_ids", "queries", "limits"])

    schema = "block long, dim int, query_ids binary, queries binary, limits binary"
    return joined.select("block", "dim", "query_ids", "queries", "ids", "seeds").mapInArrow(work, schema)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best other vectors.
    ``shard`` is the number of vectors of a shard; None takes it from the data, large
    enough to spare copies of the queries and small enough to give every task some."""
    spark = vectors.sparkSession
    table = land(integer_vectors(vectors, scale, id_col, vector_col), "vectors")
    reach = F.max(F.array_max(F.transform("v", F.abs)))
    seen = table.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), reach.alias("reach")).first()
    if seen.n and seen.dim * seen.reach**2 >= EXACT:
        raise ValueError(f"components up to {seen.reach} are too large for exact scores")
    queries = table.filter(is_query)
    tasks = 2 * partitions(spark)
    if shard is None:
        shard = min(max(LEAST, SHARD_VALUES // max(1, seen.dim or 1)), max(LEAST, -(-seen.n // tasks)))
    n_shards, n_blocks = -(-seen.n // shard) or 1, -(-queries.count() // block) or 1
    asked = _blobs(queries, "block", F.lit(n_blocks)).select(
        "block", "dim", F.col("ids").alias("query_ids"), F.col("values").alias("queries")
    )
    blocks = land(_seeded(land(asked, "blocks"), table, k), "seeded")
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))
    # Both sides are dealt by shard and dimension, so the join moves nothing again.
    dealt = min(n_shards, 4 * tasks)
    shards = _blobs(table, "shard", F.lit(n_shards)).repartition(dealt, "shard", "dim")
    meet = blocks.withColumn("shard", F.explode(numbers)).repartition(dealt, "shard", "dim")
    pieces = shards.join(meet.hint("merge"), ["shard", "dim"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, values, query_ids, wanted, limits = (c[row].as_py() for c in batch.columns)
                found = list(
                    best_of_shard(
                        np.frombuffer(wanted, np.int64).reshape(-1, dim), np.frombuffer(query_ids, np.int64).tolist(),
                        np.frombuffer(values, np.int64).reshape(-1, dim), np.frombuffer(ids, np.int64), k,
                        np.frombuffer(limits, np.float64),
                    )
                )
                columns = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    found = pieces.select("dim", "ids", "values", "query_ids", "queries", "limits").mapInArrow(work, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
