"""Benchmark decontamination by SimHash over item-sized windows.

Every window of a document that is as long as a benchmark item gets a 64-bit SimHash of
its words, weighted by their length (up to ``HEAVIEST`` bytes; verification has no limit). Lengths of items are grouped by a fixed ratio, so
there are few window sizes; an item is fingerprinted by its first and by its last words
of the group's size, so an edit near one end leaves the other fingerprint as it was.
Fingerprints are indexed by four blocks of 16 bits, each with all values at Hamming
distance 1 or less: two fingerprints at distance 7 or less agree up to one bit in at
least one block, so the index misses none within that radius. Windows within the radius
become candidates, and each is verified on words: the item is compared with every
stretch of its own length around the window, by the exact weighted Jaccard similarity of
their five-word shingles (weight: the bytes of the shingle's words, times its count).

A text may begin or end within an item. Every part of an item that is similar enough to
the whole holds the item's *core*, the words from the beginning of its shortest similar
ending to the end of its shortest similar beginning, so the core has a fingerprint too;
a stretch that reaches over an end of the text is compared as far as the text goes.

A document's windows are made and looked up where its text is read; no window is shuffled,
and documents are read once. Benchmark items are few but their number is not assumed: they
are dealt into parts of about ``PART`` items or ``PART_BYTES`` bytes, each small enough to be
sent to every task. With more than one part a task holds ``HELD_BYTES`` of texts at a time
and takes them through the parts one after another, with one index in memory.

Items of equal words are one item there; what is found is given to each of their ids by a
join of the hits. Case is ignored; words are separated by white space. Items with fewer words than a
shingle are compared as one shingle of all their words. Null and empty texts match
nothing, nor do empty items. Rows that repeat an id are searched each and reported once
per item. A null id is reported as null. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import text as tx
from tripweave.llm.runtime import land, over_slices, ship

SHINGLE = 5
RADIUS = 7
RATIO = 1.25
#: Longest window in words; longer items are fingerprinted by their ends.
WIDEST = 1024
#: Items, and bytes of items, that are indexed together.
PART = 20_000
PART_BYTES = 8 << 20
#: Texts that are taken through all parts together.
HELD_BYTES = 64 << 20
#: Words whose windows are made at a time, for the processor's cache.
STRIDE = 4096
HITS = "doc_id long, item_id long, similarity double, start int, end int"


#: Weight of a word in a fingerprint at most, so that sums over a window fit 16 bits.
HEAVIEST = 15


def _bit_sums(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Running sums of the weighted word bits, a row more than words. They wrap around,
    but their differences over a window do not. Summed in runs of 32 rows, all runs at
    a time, which the processor does many bits at once."""
    weights = np.minimum(sizes, HEAVIEST).astype(np.int16)
    run = 32
    runs = -(-(len(h) + 1) // run)
    sums = np.zeros((runs * run, 64), np.int16)
    signed = sums[1 : len(h) + 1]
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    np.multiply(bits.view(np.int8) * np.int8(2) - np.int8(1), weights[:, None], out=signed)
    by_run = sums.reshape(runs, run, 64)
    for i in range(1, run):
        by_run[:, i] += by_run[:, i - 1]
    before = np.cumsum(by_run[:, -1], axis=0, dtype=np.int16)
    by_run[1:] += before[:-1, None]
    return sums[: len(h) + 1]


def fingerprints(sums: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of every window of ``width`` words."""
    positive = (sums[width:] - sums[:-width]) > 0
    return np.packbits(positive, axis=1).view(np.uint64).reshape(-1)


def weighted_jaccard(a: Counter, b: Counter) -> float:
    """Sum of the smaller over sum of the larger weights; 0 for two empty ones."""
    common = sum(min(n, b[k]) for k, n in a.items() if k in b)
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


def _shingle_weights(h: np.ndarray, weights: np.ndarray) -> Counter:
    k = min(SHINGLE, len(h))
    out: Counter = Counter()
    if k:
        size = np.convolve(weights.astype(np.int64), np.ones(k, np.int64), "valid")
        for key, n in zip(tx.combine(h, k).tolist(), size.tolist()):
            out[key] += n
    return out


@dataclass
class Item:
    item_id: int
    n_words: int
    shingles: Counter


@dataclass
class Index:
    """Items of one part with their fingerprints, by window width."""

    items: list[Item]
    widths: dict[int, dict] = field(default_factory=dict)

    def look_up(self, width: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, entry) for every window within the radius of an entry."""
        own = self.widths[width]
        blocks = prints.view(np.uint16).reshape(-1, 4).T.astype(np.intp)
        found_window, found_entry = [], []
        for b in range(4):
            windows = np.flatnonzero(own["present"][b][blocks[b]])
            if not len(windows):
                continue
            begin, rows, value = own["begin"][b], own["rows"][b], blocks[b][windows]
            size = begin[value + 1] - begin[value]
            at = np.repeat(windows, size)
            total = np.cumsum(size) - size
            entry = rows[np.arange(len(at)) - np.repeat(total - begin[value], size)]
            near = np.bitwise_count(prints[at] ^ own["prints"][entry]) <= RADIUS
            found_window.append(at[near])
            found_entry.append(entry[near])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found_window]), np.concatenate([none, *found_entry])


def _window_sizes(n_words: int) -> int:
    """The largest window of the fixed grid that leaves out a ninth of the item at least,
    so that the first or the last words of an item are free of an edit near an end."""
    return _grid(n_words * 8 // 9)


def _grid(n_words: int) -> int:
    """The largest window of the fixed grid that is no longer than so many words."""
    size = 1
    while (following := max(size + 1, int(size * RATIO))) <= min(n_words, WIDEST):
        size = following
    return size


def _core(weights: np.ndarray, similarity: float) -> tuple[int, int]:
    """The words of an item that every similar enough part of it holds; all of them if
    there is no such part, none if two parts need not meet."""
    n = len(weights)
    if n <= SHINGLE:
        return 0, n
    sums = np.cumsum(np.convolve(weights.astype(np.int64), np.ones(SHINGLE, np.int64), "valid"))
    least = similarity * sums[-1] * (1 - 1e-9)
    end = int(np.searchsorted(sums, least))
    first = int(np.searchsorted(sums, sums[-1] - least, side="right"))
    return first, end + SHINGLE if first <= end else first


def build_index(items: list[tuple[int, str | None]], similarity: float = 0.8) -> Index:
    data, offsets = tx.utf8(pa.array([t for _, t in items], pa.string()))
    starts, ends, firsts = tx.words(data, offsets)
    h, weights = tx.hash_spans(tx.LOWER[data], starts, ends), ends - starts
    index, by_width = Index([]), {}
    for i, (item_id, _) in enumerate(items):
        a, b = firsts[i], firsts[i + 1]
        if a == b:
            continue
        own = _shingle_weights(h[a:b], weights[a:b])
        index.items.append(Item(item_id, int(b - a), own))
        width = _window_sizes(int(b - a))
        places = {(width, 0), (width, int(b - a) - width)}
        low, high = _core(weights[a:b], similarity)
        if low < high and (low, high) != (0, int(b - a)):
            width = _grid(high - low)
            places.add((width, low + (high - low - width) // 2))
        sums = _bit_sums(h[a:b], weights[a:b])
        for width, shift in sorted(places):
            own = fingerprints(sums[shift : shift + width + 1], width)
            by_width.setdefault(width, []).append((int(own[0]), len(index.items) - 1, shift))
    flips = np.array([0, *(1 << i for i in range(16))], np.int64)
    for width, entries in by_width.items():
        prints = np.array([e[0] for e in entries], np.uint64)
        own = {"prints": prints, "item": np.array([e[1] for e in entries]),
               "shift": np.array([e[2] for e in entries]), "present": [], "begin": [], "rows": []}
        for b in range(4):
            value = (prints.view(np.uint16).reshape(-1, 4)[:, b].astype(np.int64)[:, None] ^ flips).ravel()
            order = np.argsort(value, kind="stable")
            begin = np.searchsorted(value[order], np.arange((1 << 16) + 1))
            own["present"].append(begin[1:] > begin[:-1])
            own["begin"].append(begin)
            own["rows"].append(np.repeat(np.arange(len(entries)), len(flips))[order])
        index.widths[width] = own
    return index


def _near(index: Index, h: np.ndarray, weights: np.ndarray):
    """(width, windows, entries) for all windows of a batch, a stride of words at a time."""
    widest = max(index.widths, default=0)
    step = max(STRIDE, 4 * widest)
    for at in range(0, len(h), step):
        sums = _bit_sums(h[at : at + step + widest], weights[at : at + step + widest])
        for width in index.widths:
            reach = min(len(sums), step + width)
            if reach > width:
                windows, entries = index.look_up(width, fingerprints(sums[:reach], width))
                if len(windows):
                    yield width, windows + at, entries


def search(index: Index, column: pa.Array, similarity: float):
    """(text, item, similarity, start, end) of every item found in a batch of texts: its
    most similar stretch, in code points of the text."""
    data, offsets = tx.utf8(column)
    starts, ends, firsts = tx.words(data, offsets)
    if not len(starts):
        return []
    h, weights = tx.hash_spans(tx.LOWER[data], starts, ends), ends - starts
    best: dict[tuple[int, int], tuple] = {}
    seen: set[tuple[int, int, int]] = set()
    for width, windows, entries in _near(index, h, weights):
        own = index.widths[width]
        texts = np.searchsorted(firsts, windows, side="right") - 1
        inside = windows + width <= firsts[texts + 1]
        for window, entry, text in zip(
            windows[inside].tolist(), entries[inside].tolist(), texts[inside].tolist()
        ):
            number = int(own["item"][entry])
            item = index.items[number]
            low, high = int(firsts[text]), int(firsts[text + 1])
            begin = window - int(own["shift"][entry])
            stretches = set()
            for a in range(begin - 2, begin + 3):
                whole = min(max(a, low), max(low, high - item.n_words))
                stretches.add((whole, min(high, whole + item.n_words)))
                stretches.add((max(a, low), min(high, a + item.n_words)))
            for a, b in sorted(stretches):
                if a >= b or (number, a, b) in seen:
                    continue
                seen.add((number, a, b))
                found = weighted_jaccard(_shingle_weights(h[a:b], weights[a:b]), item.shingles)
                if found >= similarity and found > best.get((text, number), (0,))[0]:
                    best[text, number] = (found, a, b)
    chars = tx.char_offsets(data) if best else None
    return [
        (text, index.items[number].item_id, found,
         int(chars[starts[a]] - chars[offsets[text]]), int(chars[ends[b - 1]] - chars[offsets[text]]))
        for (text, number), (found, a, b) in sorted(best.items())
    ]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    part: int = PART,
) -> DataFrame:
    """doc_id, item_id, similarity, start and end (code points) of every benchmark item
    that a document holds, with the most similar place."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    # Equal words are one item: numbered once, written, and given back their ids at the end.
    plain = F.translate(F.col(item_text_col).cast("string"), ascii_uppercase, ascii_lowercase)
    named = benchmark.select(
        F.col(item_id_col).cast("long").alias("item_id"),
        F.btrim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " ")).alias("text"),
    ).filter("text <> ''")
    items = land(
        named.groupBy("text").agg(F.collect_set(F.struct("item_id")).alias("ids"))
        .withColumn("number", F.monotonically_increasing_id()),
        "items",
    )
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size.n:
        return spark.createDataFrame([], HITS)
    parts = max(-(-size.n // part), -(-size.bytes // PART_BYTES))
    held = []
    for number in range(parts):
        own = items.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == number)
        table = own.orderBy("text").select("number", "text").collect()
        held.append(spark.sparkContext.broadcast([(r["number"], r["text"]) for r in table]))

    def look(batch: pa.RecordBatch, number: int):
        found = search(_index_of(held[number], similarity), batch.column(1), similarity)
        if not found:
            return None
        text, item, score, start, end = zip(*found)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(text)), pa.array(item, pa.int64()),
             pa.array(score, pa.float64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
            ["doc_id", "item_id", "similarity", "start", "end"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = list(range(parts))
        for group in _groups(batches, HELD_BYTES if parts > 1 else 0):
            for number in order:
                yield from over_slices(lambda batch, number=number: look(batch, number), 1)(iter(group))
            order.reverse()  # the part indexed last is the next group's first

    hits = rows.mapInArrow(work, HITS)
    ids = items.select(F.col("number"), F.explode("ids.item_id").alias("item_id"))
    hits = hits.withColumnRenamed("item_id", "number").join(ids, "number").drop("number")
    most = F.max_by(F.struct("similarity", "start", "end"), F.struct("similarity", -F.col("start")))
    return hits.groupBy("doc_id", "item_id").agg(most.alias("m")).select("doc_id", "item_id", "m.*")


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of about ``most`` bytes, or one by one; an empty one is in none."""
    group, total = [], 0
    for batch in batches:
        if not most:
            if batch.num_rows:
                yield [batch]
            continue
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            group.append(piece)
            total += piece.nbytes
            if total >= most:
                yield group
                group, total = [], 0
    if group:
        yield group


_indexes: list[tuple[list, float, Index]] = []


def _index_of(held, similarity: float = 0.8) -> Index:
    """The index of a broadcast part, built once per worker. The part is kept beside it:
    Spark may drop its own reference, and another part may then get the same address."""
    items = held.value
    if not _indexes or _indexes[0][0] is not items or _indexes[0][1] != similarity:
        _indexes[:] = [(items, similarity, build_index(items, similarity))]
    return _indexes[0][2]
