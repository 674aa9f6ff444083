"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers cut the same bytes: A, byte-level BPE, reads a space and the text; B, a
piece model, reads the text and adds the space itself. Byte ranges of A and B tokens that
overlap are *linked*; offsets where tokens of both end are *cuts* between groups.

One numpy state vector holds the pointers into A's and B's tokens of all documents of a
batch. A step emits the pair every pointer stands at as a link, a cut where both tokens
end together, and moves on the token that ends first, or both; documents that are done
leave the vector. A document enters as one lane per ``LANE`` bytes, since the tokens
at a byte follow from the byte alone, so the number of steps has a bound and a very long
text does not run on by itself.

Neither tokenizer joins anything across a space that follows a sign other than white space,
so texts are cut there and every distinct piece is encoded once per worker, in a table of
bounded size; a B vocabulary with pieces that hold such a space is given whole texts.

Counts of id pairs over all documents are folded per task, then by Spark. The ``COMMON``
most frequent pairs (a bounded table) are sent to the tasks, which settle most links where
they are; the links of all other pairs meet their counts in a join. So a pair that stands in
every document never becomes a hot key, and no pair is left out.

Null and empty texts, and texts whose tokens of either side do not give back the space and
the text, have no tokens: their counts are zero and their digest is ''. Special tokens'
strings are plain text. Repeated rows and rows with a null id are documents of their own.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.runtime import land, over_slices, ship

LANE = 1024
COMMON = 1 << 18
#: Bytes of text that are aligned at a time.
SLICE = 1 << 20
#: Characters handed to a tokenizer at a time, unless one piece has more.
CHUNK = 1 << 16
#: Entries that a task folds at a time.
FOLD = 1 << 21
#: Characters of pieces that a worker's table holds before it starts anew.
TABLE = 1 << 22
#: Where a piece is not cut off: a space that follows white space, in anyone's view of it.
_SPACES = re.compile("[\\s\u0085\u180e\u200b\ufeff] ")

SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs array<long>, times array<long>"
)
ARRAYS = (
    "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>, "
    "a_links array<int>, b_links array<int>"
)


def byte_of_sign() -> dict[str, int]:
    """The signs by which byte-level vocabularies write bytes: printable Latin-1 signs
    stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        byte = byte_of_sign()
        self.a_bytes: dict[int, bytes] = {}
        for sign, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(c in byte for c in sign)
            self.a_bytes[i] = bytes(byte[c] for c in sign) if known else sign.encode()
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else None
            self.b_bytes[i] = piece.replace("▁", " ").encode() if raw is None else raw
        self.a_sizes, self.b_sizes = _sizes(self.a_bytes), _sizes(self.b_bytes)
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.cut = not any("▁" in piece.lstrip("▁") for piece in pieces)
        self._forget()

    def _forget(self) -> None:
        self.table: dict[str, int] = {}
        self.held = 0
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.whole = np.zeros(0, bool)
        self.total = [0, 0]
        self._start()

    def _start(self) -> None:
        """What is encoded next waits in lists, to be added to the arrays at once."""
        self.new_whole: list[bool] = []
        self.new_ids: list[list[np.ndarray]] = [[], []]
        self.new_ends: list[list[np.ndarray]] = [[], []]

    def _pieces(self, text: str) -> list[str]:
        """The text's pieces without the one space that each begins with."""
        if not self.cut:
            return [text]
        parts = text.split(" ")
        if not _SPACES.search(" " + text):
            return parts
        out = [parts[0]]
        for part in parts[1:]:
            if _SPACES.search((out[-1][-1:] or " ") + " "):
                out[-1] += " " + part
            else:
                out.append(part)
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Pieces that may stand side by side are encoded as one text and cut apart again."""
        plain = [p for p in pieces if self.cut and p and "▁" not in p and not _SPACES.search(p[-1] + " ")]
        odd = sorted(set(pieces).difference(plain))
        first = 0
        while first < len(plain):
            last, size = first, 0
            while last < len(plain) and (last == first or size + len(plain[last]) <= CHUNK):
                size += len(plain[last])
                last += 1
            if not self._add(plain[first:last]):
                odd += plain[first:last]
            first = last
        for piece in odd:
            self._add([piece], always=True)
        self.whole = np.append(self.whole, self.new_whole)
        for side in (0, 1):
            self.flat[side] = np.concatenate([self.flat[side], *self.new_ids[side]])
            self.ends[side] = np.concatenate([self.ends[side], *self.new_ends[side]])
        self._start()

    def _add(self, pieces: list[str], always: bool = False) -> bool:
        """Encode neighbours and add them to the table, unless tokens do not give their bytes
        back or reach across pieces; of ``always`` the one piece is then known as broken."""
        text = " ".join(pieces)
        raw = (" " + text).encode()
        ends = np.cumsum([len(piece.encode()) + 1 for piece in pieces])
        a_ids = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        # Nothing after its space: the sign for the space alone.
        b_ids = self.b.encode(text, num_threads=1) or [self.b.piece_to_id("▁")]
        found, whole = [], True
        for ids, raws, sizes in ((a_ids, self.a_bytes, self.a_sizes), (b_ids, self.b_bytes, self.b_sizes)):
            whole = whole and b"".join([raws[i] for i in ids]) == raw
            ids = np.array(ids, np.int32)
            reached = np.cumsum(sizes[ids])
            if whole and len(pieces) > 1:
                cuts = np.searchsorted(reached, ends)
                whole = bool((reached[cuts] == ends).all())
                found.append((ids, cuts + 1))
            else:
                found.append((ids, np.array([len(ids)])))
        if not whole and not always:
            return False
        first = len(self.table)
        self.table.update(zip(pieces, range(first, first + len(pieces))))
        self.new_whole += [whole] * len(pieces)
        self.held += len(text)
        for side, (ids, cuts) in enumerate(found):
            self.new_ids[side].append(ids)
            self.new_ends[side].append(self.total[side] + cuts)
            self.total[side] += len(ids)
        return True

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of both sides the ids of all texts, and where each text's begin. A text that is
        empty, or that either side does not give back, has none."""
        if self.held > TABLE:
            self._forget()
        pieces: list[str] = []
        bounds = [0]
        for text in texts:
            if text:
                pieces += self._pieces(text)
            bounds.append(len(pieces))
        new = set(pieces) - self.table.keys()
        if new:
            self._learn(sorted(new))
        at = np.fromiter(map(self.table.__getitem__, pieces), np.int64, len(pieces))
        bounds = np.array(bounds)
        broken = np.append(0, np.cumsum(~self.whole[at]))[bounds]
        kept = np.repeat(np.diff(broken) == 0, np.diff(bounds))
        before = np.append(0, np.cumsum(kept))[bounds]
        at = at[kept]
        out = []
        for flat, ends in zip(self.flat, self.ends):
            size = ends[at + 1] - ends[at]
            total = np.append(0, np.cumsum(size))
            place = np.repeat(ends[at] - total[:-1], size) + np.arange(total[-1])
            out.append((flat[place].astype(np.int64), total[before]))
        return out


def _sizes(table: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(table) + 1, np.int64)
    for i, raw in table.items():
        out[i] = len(raw)
    return out


@dataclass
class Aligned:
    """Tokens of a batch, side by side. ``a`` and ``b`` are ids; ``first_a`` and
    ``first_b`` where each document begins; links and cuts are indexes of tokens."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray, lane: int = LANE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (indexes of A and of B tokens) and cuts (the last A and B token of each group)
    of documents that lie one after another on an axis of bytes, [bounds[i], bounds[i + 1])
    each. Tokens are given by where they end; none is empty. Both come in order."""
    lanes = -(-np.diff(bounds) // lane)
    owner = np.repeat(np.arange(len(lanes)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = bounds[:-1][owner] + lane * number
    stop = np.minimum(start + lane, bounds[1:][owner])
    pa_, pb = np.searchsorted(ends_a, start, "right"), np.searchsorted(ends_b, start, "right")
    begins_a, begins_b = np.append(0, ends_a), np.append(0, ends_b)
    # A pair that began before the lane belongs to the lane before it.
    early = np.maximum(begins_a[pa_], begins_b[pb]) < start
    end_a, end_b = ends_a[pa_], ends_b[pb]
    pa_, pb = pa_ + (early & (end_a <= end_b)), pb + (early & (end_b <= end_a))
    alive = ~early | (np.minimum(end_a, end_b) < stop)
    pa_, pb, stop = pa_[alive], pb[alive], stop[alive]
    links, cuts = [], []
    while len(pa_):
        links.append((pa_, pb))
        end_a, end_b = ends_a[pa_], ends_b[pb]
        on_a, on_b = end_a <= end_b, end_b <= end_a
        both = on_a & on_b
        if both.any():
            cuts.append((pa_[both], pb[both]))
        pa_, pb = pa_ + on_a, pb + on_b
        alive = np.minimum(end_a, end_b) < stop
        if not alive.all():
            pa_, pb, stop = pa_[alive], pb[alive], stop[alive]
    none = np.zeros(0, np.int64)
    link_a, link_b = (np.concatenate(c) for c in zip(*links)) if links else (none, none)
    cut_a, cut_b = (np.concatenate(c) for c in zip(*cuts)) if cuts else (none, none)
    order = np.argsort(link_a + link_b)  # every step along a document raises the sum
    return link_a[order], link_b[order], np.sort(cut_a), np.sort(cut_b)


def align(tokenizers: Tokenizers, texts: list[str | None], lane: int = LANE) -> Aligned:
    """Texts without tokens take no place on the axis of bytes."""
    (all_a, first_a), (all_b, first_b) = tokenizers.encode(texts)
    ends_a, ends_b = np.cumsum(tokenizers.a_sizes[all_a]), np.cumsum(tokenizers.b_sizes[all_b])
    bounds = np.append(0, ends_a)[first_a]
    return Aligned(all_a, all_b, first_a, first_b, *lockstep(ends_a, ends_b, bounds, lane))


def group_texts(al: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents as bytes, and where each begins."""
    n, m = len(al.a), len(al.b)
    group_a = np.searchsorted(al.cut_a, np.arange(n), "left")
    group_b = np.searchsorted(al.cut_b, np.arange(m), "left")
    place = np.empty(n + m, np.int64)
    place[:n] = np.arange(n) + np.append(0, al.cut_b + 1)[group_a]
    place[n:] = np.arange(m) + (al.cut_a + 1)[group_b] if m else 0
    ids, after = np.empty(n + m, np.int64), np.full(n + m, ord(","), np.uint8)
    ids[place[:n]], ids[place[n:]] = al.a, al.b
    after[place[al.cut_a]] = ord("|")
    after[place[n + al.cut_b]] = ord(";")
    width = len(str(int(ids.max(initial=0))))
    signs = np.empty((n + m, width + 1), np.uint8)
    shown = np.ones((n + m, width + 1), bool)
    for k in range(width):
        power = 10 ** (width - 1 - k)
        signs[:, k] = ids // power % 10 + ord("0")
        if k < width - 1:
            shown[:, k] = ids >= power
    signs[:, width] = after
    ends = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
    return signs[shown], ends[al.first_a + al.first_b]


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


_loaded: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """Once per worker."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


def alignments(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document both sides' ids, the last token of each group on either side, and all
    links, as indexes of the document's tokens in order."""

    def work(batch):
        al = align(_tokenizers(a_path, b_path), batch.column(1).to_pylist())
        cuts = np.searchsorted(al.cut_a, al.first_a)
        links = np.searchsorted(al.link_a, al.first_a)
        base_a, base_b = (np.repeat(f[:-1], np.diff(links)) for f in (al.first_a, al.first_b))
        cut_a, cut_b = (np.repeat(f[:-1], np.diff(cuts)) for f in (al.first_a, al.first_b))
        lists = [(al.a, al.first_a), (al.b, al.first_b), (al.cut_a - cut_a, cuts), (al.cut_b - cut_b, cuts),
                 (al.link_a - base_a, links), (al.link_b - base_b, links)]
        columns = [_lists(values, offsets, pa.int32()) for values, offsets in lists]
        names = [field.split()[0] for field in ARRAYS.split(", ")]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return _rows(docs, id_col, text_col).mapInArrow(over_slices(work, 1, SLICE), ARRAYS)


def summaries(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, the digest of its groups, and
    its distinct linked id pairs (A's id * 2^32 + B's) with how many links hold each."""

    def work(batch):
        al = align(_tokenizers(a_path, b_path), batch.column(1).to_pylist())
        signs, begins = group_texts(al)
        view = memoryview(signs.tobytes())
        n = batch.num_rows
        sha = [
            hashlib.sha256(view[s : e - 1]).hexdigest() if e > s else ""
            for s, e in zip(begins[:-1].tolist(), begins[1:].tolist())
        ]
        links = np.searchsorted(al.link_a, al.first_a)
        pair = (al.a[al.link_a] << 32) | al.b[al.link_b]
        owner = np.repeat(np.arange(n), np.diff(links))
        order = np.lexsort((pair, owner))
        pair = pair[order]  # owners ascend already
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        offsets = np.searchsorted(at, links)
        times = np.diff(np.append(at, len(pair)))
        cuts = np.searchsorted(al.cut_a, al.first_a)
        counts = [np.diff(c) for c in (al.first_a, al.first_b, cuts, links)]
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string())]
        columns += [_lists(pair[at], offsets, pa.int64()), _lists(times, offsets, pa.int64())]
        names = [field.split()[0] for field in SUMMARY.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    return _rows(docs, id_col, text_col).mapInArrow(over_slices(work, 1, SLICE), SUMMARY)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per pair of what a task has read, given out whenever ``FOLD`` are held."""
    pairs, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def folded():
        own = np.concatenate([pairs, *(p for p, _ in waiting)])
        number = np.concatenate([counts, *(c for _, c in waiting)])
        waiting.clear()
        order = np.argsort(own, kind="stable")
        own, number = own[order], number[order]
        at = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
        return own[at], np.add.reduceat(number, at) if len(at) else number

    held = 0
    for batch in batches:
        waiting.append((batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()))
        held += len(waiting[-1][0])
        if held >= FOLD:
            pairs, counts = folded()
            held = 0
            if len(pairs) >= FOLD:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])
                pairs, counts = pairs[:0], counts[:0]
    pairs, counts = folded()
    if len(pairs):
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])


def pair_counts(summary: DataFrame) -> DataFrame:
    """(pair, n, best): links that hold each id pair, and whether no other pair of its B id
    has more."""
    found = summary.select("pairs", "times").mapInArrow(_fold, "pair long, n long")
    counts = land(found.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    tops = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("top"))
    joined = counts.withColumn("b_id", b_id).join(tops, "b_id")
    return land(joined.select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "counted")


def scored(summary: DataFrame, common: int = COMMON) -> DataFrame:
    """The summary without its pairs, with n_best (links whose pair is the most frequent
    of its B id, ties included) and count_sum (the counts of all links, added up)."""
    spark = summary.sparkSession
    # Numbered as it is written, so a row's number is the same in every later step.
    table = land(summary.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counted = pair_counts(table)
    top = counted.orderBy(F.desc("n"), "pair").limit(common).toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(
        (top.column("pair").to_numpy(), top.column("n").to_numpy(),
         top.column("best").to_numpy(zero_copy_only=False))
    )
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, rest array<struct<pair:long,times:long>>"
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, best = sent.value
        for batch in batches:
            pairs = batch.column(len(kept))
            offsets = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
            pair = pairs.flatten().to_numpy()
            times = batch.column(len(kept) + 1).flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            at = at[hit]
            sums = []
            for value in (best[at].astype(np.int64), number[at]):
                each = np.zeros(len(pair), np.int64)
                each[hit] = value * times[hit]
                total = np.concatenate([[0], np.cumsum(each)])
                sums.append(pa.array(total[offsets[1:]] - total[offsets[:-1]]))
            left = np.concatenate([[0], np.cumsum(~hit)])[offsets]
            rest = pa.StructArray.from_arrays([pa.array(pair[~hit]), pa.array(times[~hit])], ["pair", "times"])
            rest = pa.ListArray.from_arrays(pa.array(left, pa.int32()), rest)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, *sums, rest], [*kept, "n_best", "count_sum", "rest"]
            )

    settled = land(table.select(*kept, "pairs", "times").mapInArrow(settle, schema), "settled")
    rest = (
        settled.select("row", F.explode("rest").alias("link"))
        .select("row", "link.pair", "link.times")
        .join(counted, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    whole = settled.drop("rest").join(rest, "row", "left")
    return whole.select(
        *kept[1:6],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
