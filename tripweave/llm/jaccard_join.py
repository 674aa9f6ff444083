"""N-gram Jaccard join by parity sketches.

Every text becomes the set of its hashed word shingles. A *parity sketch* deals the set
into blocks by hash and XORs the hashes of each block. Every element of the symmetric
difference of two sets changes one block at most, so the number of blocks that differ
never exceeds that difference; nor does the Hamming distance of sketches in which an
element flips one bit. Sets whose Jaccard similarity reaches p/q differ by at most
``(|S| + |T|) (q - p) / (q + p)`` elements; with one block more than that, at least one
block must agree exactly (pigeonhole). The bound depends on sizes, so the sketch layout
is fixed per *size band*; a set also gets a sketch in the layout of the next band if a
set there could be similar to it. Joining on (band, block, parity) therefore meets every
similar pair. Layouts have some blocks to spare, so that empty and thin blocks need not
be joined on (``probes``).

Exact copies are folded into one class by a digest of their sets. Within a bucket of the
join not all pairs are formed: every member is paired with the smallest one only, and of
these pairs the nearest of each member is verified exactly on the texts, so whole groups
of near copies collapse into components. What remains are the other pairs with a smallest
member, and pairs within buckets that still hold different components; only pairs across
components are compared there, sketch against sketch in bounded chunks, and those within
the bound are verified. So no link that joins two components can be lost, and work on a
large group of near copies stays linear. Rows that travel are narrow: keys with ids, then
sketches (folded to two bits an element) and texts only of documents that share a key.

Rows that are null or have no words have an empty set and are linked with nothing.
Repeated rows each get a row of the result. A null id takes no part in links: its
component is null. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import text as tx
from tripweave.llm.components import components
from tripweave.llm.runtime import land, let_go, over_slices, partitions, ship, small_batches

class _Member(NamedTuple):
    first: bool
    second: bool
    id: int
    component: int
    n_shingles: int
    words: np.ndarray


#: Bytes of text whose shingles are made at a time.
SLICE = 1 << 20
#: Members of a bucket that are compared in one piece.
CHUNK = 512


class Bands:
    """Size bands for "100 * intersection >= percent * union".

    A band spans two steps of the similarity, so a set can only be similar to sets of
    its own and the neighbouring bands. ``blocks`` of a band is one more than the
    largest difference of two similar sets of which the larger lies in it.
    """

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent lies in (50, 100]")
        self.percent, self.low = percent, [1]

    def _reach(self, size: int) -> int:
        """The size of the largest set that can be similar to one of this size."""
        return size * 100 // self.percent

    def _extend(self, size: int) -> None:
        while self.low[-1] <= size:
            self.low.append(self._reach(self._reach(self.low[-1])) + 1)

    def of(self, size: int) -> int:
        self._extend(size)
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def first(self, band: int) -> int:
        while len(self.low) <= band:
            self._extend(self.low[-1])
        return self.low[band]

    def bound(self, total: int) -> int:
        """The largest symmetric difference of similar sets with so many elements together."""
        return total * (100 - self.percent) // (100 + self.percent)

    def most(self, size: int) -> int:
        """The largest symmetric difference of a set of this size and a similar one."""
        return self.bound(size + self._reach(size))

    def blocks(self, band: int) -> int:
        return self.bound(2 * (self.first(band + 1) - 1)) + 1

    def layouts(self, size: int) -> tuple[int, int, int]:
        """The band, its blocks, and the blocks of the next band; 0 blocks where only
        an equal set can be similar, which the folding of copies has found."""
        band = self.of(size)
        own, up = self.blocks(band), self.blocks(band + 1)
        return band, own if own > 1 else 0, up if self._reach(size) >= self.first(band + 1) else 0


def sketch(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """The parity sketch: ``blocks`` words of 64 bits."""
    if not blocks:
        return np.zeros(0, np.int64)
    spread = tx.mix(shingles + tx.U64(blocks))
    block = (spread >> tx.U64(32)) * tx.U64(blocks) >> tx.U64(32)
    bit = (block << tx.U64(6)) + (spread & tx.U64(63))
    flips = np.bincount(bit.astype(np.int64), minlength=64 * blocks) & 1
    return np.packbits(flips.astype(bool), bitorder="little").view(np.int64)


def _shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = tx.utf8(column)
    data = tx.LOWER[data]
    starts, ends, firsts = tx.words(data, offsets)
    flat, bounds = tx.shingles(tx.hash_spans(data, starts, ends), firsts, k)
    edges = bounds.tolist()
    for a, b in zip(edges, edges[1:]):
        own = np.sort(flat[a:b])
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def _kinds(s: np.ndarray, bands: Bands) -> list[tuple[int, int]]:
    """(band, blocks) of the layouts in which a set has a sketch."""
    if not len(s):
        return []
    band, own, up = bands.layouts(len(s))
    return [(b, m) for b, m in ((band, own), (band + 1, up)) if m]


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """The sketch folded by XOR to about two bits an element. Folding never raises a
    Hamming distance, so the bound stays one."""
    width = size // 32 + 1
    out = np.zeros(-(-len(words) // width) * width, np.int64)
    out[: len(words)] = words
    return np.bitwise_xor.reduce(out.reshape(-1, width), axis=0)


def shingle_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3
) -> DataFrame:
    """Size of the set and signature (equal for equal sets, null for empty) of every row."""
    ship(docs.sparkSession)

    def work(batch):
        sets = list(_shingle_sets(batch.column(1), k))
        sigs = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(sigs, pa.binary())],
            ["doc_id", "n_shingles", "sig"],
        )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(over_slices(work, 1, SLICE), "doc_id long, n_shingles long, sig binary")


def block_keys(s: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks that hold elements, the XOR of the 64-bit hashes in each, and their
    number. A block of two sets agrees only if they hold the same elements there."""
    spread = tx.mix(s + tx.U64(blocks))
    block = (spread >> tx.U64(32)) * tx.U64(blocks) >> tx.U64(32)
    order = np.argsort(block, kind="stable")
    block = block[order]
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    parity = np.bitwise_xor.reduceat(tx.mix(spread[order]), first)
    return block[first], parity, np.diff(np.append(first, len(block)))


def probes(s: np.ndarray, band: int, blocks: int, most: int) -> np.ndarray:
    """The join keys of a set in one layout, which has a fifth more blocks than the
    pigeonhole needs. Similar sets differ in ``most`` blocks at most. If more blocks than
    that hold elements, the ``most + 1`` fullest (then lowest) suffice: the fullest block
    that two similar sets share has at most ``most`` blocks before it in either set. So
    empty and thin blocks, which agree by chance, seldom become keys. Sets that have
    fewer filled blocks use all blocks, empty ones too."""
    wide = blocks + blocks // 5 + 2
    at, parity, count = block_keys(s, wide)
    if len(at) > most:
        chosen = np.lexsort((at, -count))[: most + 1]
        at, parity = at[chosen], parity[chosen]
    else:
        filled, at = at, np.arange(wide, dtype=tx.U64)
        every = np.zeros(wide, tx.U64)
        every[filled.astype(np.int64)] = parity
        parity = every
    return tx.mix(parity ^ tx.mix((at << tx.U64(16)) + tx.U64(band)))


def _keys(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, id): one row per text and probed block, in each layout it has."""

    def work(batch):
        bands, keys, counts = Bands(percent), [], []
        for s in _shingle_sets(batch.column(1), k):
            most = bands.most(len(s))
            own = [probes(s, band, m, most) for band, m in _kinds(s, bands)]
            keys += own
            counts.append(sum(map(len, own)))
        if not keys:
            return None
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), ids], ["key", "id"]
        )

    return texts.select("id", "text").mapInArrow(over_slices(work, 1, SLICE), "key long, id long")


SKETCHES = "id long, n_shingles long, band int, own array<long>, up array<long>"


def _sketches(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Folded sketches of texts, in both layouts (empty where there is none). Folds are
    as wide as the band's largest set asks for, so they compare word by word."""

    def work(batch):
        bands, sizes, band_of, sides = Bands(percent), [], [], ([], [])
        for s in _shingle_sets(batch.column(1), k):
            band = bands.of(max(1, len(s)))
            made = dict(_kinds(s, bands))
            sizes.append(len(s))
            band_of.append(band)
            for side, b in zip(sides, (band, band + 1)):
                wide = bands.first(b + 1) - 1
                side.append(fold(sketch(s, made[b]), wide) if b in made else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(band_of, pa.int32()),
             *map(_lists, sides)],
            ["id", "n_shingles", "band", "own", "up"],
        )

    return texts.select("id", "text").mapInArrow(over_slices(work, 1, SLICE), SKETCHES)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*arrays, np.zeros(0, np.int64)]))


def _with_sketches(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    def side(name: str) -> DataFrame:
        return sketches.select(
            F.col("id").alias(name),
            F.col("n_shingles").alias(f"{name}_size"),
            F.col("band").alias(f"{name}_band"),
            F.col("own").alias(f"{name}_own"),
            F.col("up").alias(f"{name}_up"),
        )

    return pairs.join(side("a"), "a").join(side("b"), "b")


def _within(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches allow them to be similar, with the Hamming distance; in
    Spark's own functions. Each pair is compared in the layout of the higher band."""
    a, b = F.col("a_band"), F.col("b_band")
    left = F.when(a < b, F.col("a_up")).otherwise(F.col("a_own"))
    right = F.when(b < a, F.col("b_up")).otherwise(F.col("b_own"))
    flips = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    distance = F.aggregate(flips, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(64)))
    total = F.col("a_size") + F.col("b_size")
    bound = F.floor(total * (100 - percent) / (100 + percent) + 1e-9)
    return pairs.select("a", "b", distance.alias("distance"), bound.alias("bound")).filter(
        "distance <= bound"
    )


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar indeed, by their whole texts."""
    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
    both = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")

    def work(batch):
        keep = []
        for s, t in zip(_shingle_sets(batch.column(2), k), _shingle_sets(batch.column(3), k)):
            common = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * common >= percent * (len(s) + len(t) - common))
        chosen = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
        return chosen.filter(pa.array(keep, pa.bool_()))

    rows = both.select("a", "b", "a_text", "b_text")
    return rows.mapInArrow(over_slices(work, 2, SLICE), "a long, b long")


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one bucket that lie in different components and within the
    sketch bound. A bucket of many members is cut into chunks of about ``CHUNK``, and
    each pair of chunks is a piece of work of its own."""
    sizes = members.groupBy("key").agg((F.floor(F.count("*") / CHUNK) + 1).alias("chunks"))
    own = F.pmod(F.xxhash64("id"), F.col("chunks"))
    dealt = (
        members.join(sizes, "key")
        .withColumn("own_chunk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select(
            F.xxhash64(
                "key", F.least("own_chunk", "other"), F.greatest("own_chunk", "other")
            ).alias("piece"),
            (F.col("own_chunk") <= F.col("other")).alias("first"),
            (F.col("own_chunk") >= F.col("other")).alias("second"),
            "id", "component", "n_shingles", "words",
        )
    )
    ordered = dealt.repartition(partitions(members.sparkSession), "piece").sortWithinPartitions(
        "piece", "id"
    )

    def compare(rows: list[_Member]) -> Iterator[tuple[int, int]]:
        """Pairs of a piece: rows of its first chunk against those of its second."""
        left, right = [r for r in rows if r.first], [r for r in rows if r.second]
        width = max(len(r.words) for r in rows)
        matrix = np.zeros((len(right), width), np.int64)
        for i, r in enumerate(right):
            matrix[i, : len(r.words)] = r.words
        ids = np.array([r.id for r in right], np.int64)
        comps = np.array([r.component for r in right], np.int64)
        sizes = np.array([r.n_shingles for r in right], np.int64)
        same = len(left) == len(rows) == len(right)
        for r in left:
            own = np.zeros(width, np.int64)
            own[: len(r.words)] = r.words
            # Counted unsigned: numpy counts the bits of a number's absolute value.
            apart = np.bitwise_count((matrix ^ own).view(np.uint64)).sum(axis=1)
            total = sizes + r.n_shingles
            near = (apart <= total * (100 - percent) // (100 + percent)) & (comps != r.component)
            if same:
                near &= ids > r.id
            for other in ids[near].tolist():
                yield min(other, r.id), max(other, r.id)

    def run(batches):
        piece, rows = None, []
        for batch in batches:
            out: set[tuple[int, int]] = set()
            lists = batch.column(6)
            flat, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            edges = (edges - edges[0]).tolist()
            plain = zip(*(batch.column(c).to_pylist() for c in range(6)))
            for i, (of, *values) in enumerate(plain):
                if of != piece:
                    if len({r.component for r in rows}) > 1:
                        out.update(compare(rows))
                    piece, rows = of, []
                rows.append(_Member(*values, flat[edges[i] : edges[i + 1]].copy()))
            yield _pairs(out)
        if len({r.component for r in rows}) > 1:
            yield _pairs(set(compare(rows)))

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(found)) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _labels(pairs: DataFrame, grown: DataFrame) -> DataFrame:
    """The pairs with their ends replaced by the components they are in so far."""
    known = grown.withColumnRenamed("node", "id")
    for end in ("a", "b"):
        pairs = (
            pairs.withColumn("id", F.col(end))
            .join(known, "id", "left")
            .withColumn(f"{end}_in", F.coalesce("component", "id"))
            .drop("id", "component")
        )
    return pairs


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id, the smallest id reachable
    over links, for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    ).filter("id is not null")
    sets = land(shingle_sets(docs, id_col, text_col, k), "sets")
    classes = land(
        sets.filter("sig is not null and doc_id is not null")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("id")),
        "classes",
    )
    # Copies share all their keys, so the smallest id of a bucket is always that of a
    # class. Buckets are found by partial counts and joined back, as a hot key that a
    # join meets can be split over tasks; copies go there, by a join of narrow rows.
    buckets = (
        _keys(texts, k, percent)
        .groupBy("key")
        .agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
        .filter("pivot <> last")
        .select("key", "pivot")
    )
    buckets = land(buckets, "buckets")
    let_go(spark)
    shared = _keys(texts, k, percent).join(buckets.hint("merge"), "key")
    met = land(
        shared.join(classes.select("id"), "id", "left_semi").select("key", "id", "pivot"), "met"
    )
    let_go(spark)
    involved = met.select("id").distinct()
    # The ids grow with the corpus, so they are not to be broadcast at any size. This is
    # the only time that texts meet them; what follows reads the written part.
    texts = land(
        texts.join(involved.hint("merge"), "id", "left_semi").dropDuplicates(["id", "text"]),
        "texts",
    )
    let_go(spark)
    sketches = land(_sketches(texts, k, percent), "sketches")
    pivots = met.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    near = land(_within(_with_sketches(pivots.distinct(), sketches), percent), "near")
    let_go(spark)
    best = near.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a"))
    grown = components(land(_verified(best.select("a", "b"), texts, k, percent), "stars"))
    let_go(spark)

    # Pairs with a pivot have been compared; others only where components differ.
    members = met.filter("id <> pivot").select("key", "id").distinct()
    labelled = members.join(grown.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = land(mixed.filter("low <> high").select("key"), "mixed")
    members = labelled.join(mixed, "key").join(sketches, "id")
    layouts = land(members.groupBy("key").agg(F.max("band").alias("top")), "layouts")
    members = members.join(layouts, "key").select(
        "key", "id", "component", "n_shingles",
        F.when(F.col("band") < F.col("top"), F.col("up")).otherwise(F.col("own")).alias("words"),
    )
    left_over = _labels(near.select("a", "b"), grown).filter("a_in <> b_in").select("a", "b")
    open_pairs = land(_across(members, percent).unionByName(left_over).distinct(), "open")
    bridges = _labels(_verified(open_pairs, texts, k, percent), grown)
    merged = components(bridges.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
    final = (
        grown.join(
            merged.select(F.col("node").alias("component"), F.col("component").alias("top")),
            "component",
            "left",
        )
        .select(F.col("node").alias("id"), F.coalesce("top", "component").alias("c"))
        .unionByName(merged.select(F.col("node").alias("id"), F.col("component").alias("c")))
        .groupBy("id")
        .agg(F.min("c").alias("component"))
    )
    by_class = land(
        classes.join(final, "id", "left").select(
            "sig", F.coalesce("component", "id").alias("component")
        ),
        "by_class",
    )
    return sets.join(by_class, "sig", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
