"""Encoding and decoding with a public BPE tokenizer, by tree concatenation.

Two things make it fast and even. *Words*: where the tokenizer itself splits at white
space, a text's ids are those of its words one after the other, so each distinct word is
encoded once per worker and looked up afterwards. *Long unsplit text*: a stretch without
white space is one unit for the tokenizer, whose cost grows faster than its length. Such
a stretch, and any text beyond ``leaf_chars``, is cut into halves until they are small
enough; the leaves become rows of their own that Spark deals over all tasks. Then
neighbours are concatenated up the tree: around each join a window is encoded again,
growing on both sides until its ids agree with the left half at its left end and with
the right half at its right end. Every pair of adjacent ids then occurs in a valid
encoding, which makes the whole sequence the encoding of the whole text.

A null text is empty; an empty one has no ids. Texts that contain one of the
tokenizer's special tokens are encoded as a whole by the library. Nulls in the id,
repeated rows and extra columns pass through: every row is its own document.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import text as tx
from tripweave.llm.runtime import over_slices, partitions, ship

#: Words a worker remembers before it starts afresh.
KNOWN_WORDS = 1_500_000
#: Longest text encoded in one piece, in characters.
LEAF_CHARS = 32_768
#: Characters on either side of a join that are encoded first.
WINDOW = 64

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: ASCII marks that are neither letters, digits, white space nor the apostrophe.
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer without truncation and padding, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _splits_at_white_space(path: str) -> bool:
    """Whether the tokenizer drops white space and lower-cases: then ASCII white space
    separates a text into parts with ids of their own, and a border between an ASCII
    letter and an ASCII mark does so too."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    drops = first.get("behavior") == "Removed" and first.get("invert") is True
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return drops and r"[^\s\p{L}\p{N}]+" in pattern and r"[\p{L}]+" in pattern and "Lowercase" in kinds


class WordEncoder:
    """Ids of whole batches of texts from a table of known words."""

    def __init__(self, path: str):
        self.path = path
        self.library = tokenizer(path)
        self.by_word = _splits_at_white_space(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, tx.U64)
        self.rank = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.rank) + len(keys) > KNOWN_WORDS:
            self._forget()
        found = [np.array(e.ids, np.uint32)
                 for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        number = np.arange(len(self.rank), len(self.rank) + len(keys))
        ends = self.begin[-1] + np.cumsum([len(x) for x in found])
        self.begin = np.concatenate([self.begin, ends])
        self.ids = np.concatenate([self.ids, *found])
        all_keys = np.concatenate([self.keys, keys])
        order = np.argsort(all_keys, kind="stable")
        self.rank = np.concatenate([self.rank, number])[order]
        self.keys = all_keys[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the offset of each text."""
        data, offsets = tx.utf8(column)
        if not self.by_word or any(s in data.tobytes() for s in self.special):
            texts = ["" if t is None else t for t in column.to_pylist()]
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            arrays = [np.array(e.ids, np.uint32) for e in found]
            ends = np.cumsum([0, *map(len, arrays)])
            return np.concatenate([*arrays, np.zeros(0, np.uint32)]), ends
        starts, ends, firsts = self._parts(data, offsets)
        low = self._lower(data)
        keys = tx.hash_spans(low, starts, ends)
        coded = pc.dictionary_encode(pa.array(keys))
        distinct, back = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            if len(self.rank) + len(new) > KNOWN_WORDS:
                self._forget()
                new = np.arange(len(distinct))
            where = np.zeros(len(distinct), np.int64)
            where[back] = np.arange(len(back))
            text = low.tobytes()
            spans = zip(starts[where[new]].tolist(), ends[where[new]].tolist())
            self._learn(distinct[new], [text[a:b].decode() for a, b in spans])
            at = np.searchsorted(self.keys, distinct)
        number = self.rank[at][back]
        begin, size = self.begin[number], np.diff(self.begin)[number]
        total = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(total[-1]) - np.repeat(total[:-1] - begin, size)
        return self.ids[place], total[firsts]

    @staticmethod
    def _parts(data: np.ndarray, offsets: np.ndarray):
        """Words, cut again between an ASCII letter and an ASCII mark."""
        starts, ends, firsts = tx.runs(~_WHITE[data], offsets)
        if not len(starts):
            return starts, ends, firsts
        letter, mark = _LETTER[data], _MARK[data]
        border = np.zeros(len(data), dtype=bool)
        border[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        border[starts] = False
        begins = border.copy()
        begins[starts] = True
        closes = np.zeros(len(data) + 1, dtype=bool)
        closes[:-1] = border
        closes[ends] = True
        all_starts = np.flatnonzero(begins)
        return all_starts, np.flatnonzero(closes), np.searchsorted(all_starts, offsets)

    @staticmethod
    def _lower(data: np.ndarray) -> np.ndarray:
        """ASCII capitals lower, except before a byte that may belong to a mark which
        composes with them."""
        low = tx.LOWER[data]
        if len(data) > 1:
            composed = data[1:] >= 0x80
            low[:-1][composed] = data[:-1][composed]
        return low


@dataclass
class Piece:
    """A stretch of text with its ids and the character at which each id begins."""

    text: str
    ids: list[int]
    begins: list[int]


def whole(library, text: str) -> Piece:
    found = library.encode(text, add_special_tokens=False)
    return Piece(text, found.ids, [a for a, _ in found.offsets])


def may_cut(text: str, at: int) -> bool:
    """Whether a text may be cut before character ``at``: not inside white space, and
    not where normalisation joins the two characters."""
    a, b = text[at - 1], text[at]
    if unicodedata.combining(b) or b.isspace():
        return False
    form = unicodedata.normalize
    return form("NFC", a + b) == form("NFC", a) + form("NFC", b)


def cut_at(text: str, wanted: int) -> int | None:
    """The place nearest to ``wanted`` where a text may be cut."""
    for step in range(max(wanted, len(text) - wanted)):
        for at in (wanted - step, wanted + step):
            if 0 < at < len(text) and may_cut(text, at):
                return at
    return None


def leaves(text: str, leaf_chars: int) -> list[str]:
    """The text in halves of halves, until each is at most ``leaf_chars`` long."""
    if len(text) <= leaf_chars:
        return [text]
    at = cut_at(text, len(text) // 2)
    if at is None:
        return [text]
    return leaves(text[:at], leaf_chars) + leaves(text[at:], leaf_chars)


def join(library, left: Piece, right: Piece, window: int = WINDOW) -> Piece:
    """The encoding of two neighbouring stretches from their own encodings."""
    text = left.text + right.text
    border = len(left.text)
    begins = left.begins + [border + b for b in right.begins]
    width = window
    while True:
        a, b = max(0, border - width), min(len(text), border + width)
        a = 0 if a == 0 else _token_start(left.begins, a)
        if 0 < b < len(text):
            b = cut_at(text, b) or len(text)
            b = len(text) if b <= border else b
        middle = whole(library, text[a:b])
        places = [a + x for x in middle.begins]
        head = 0 if a == 0 else _agree_left(left, middle, places, a)
        tail = len(middle.ids) if b == len(text) else _agree_right(right, middle, places, border)
        if head is not None and tail is not None:
            keep_left = 0 if a == 0 else _index(left.begins, places[head])
            if b == len(text):
                rest, at = [], []
            else:
                first = _index(right.begins, places[tail] - border)
                rest, at = right.ids[first:], begins[len(left.begins) + first :]
            if keep_left is not None:
                return Piece(
                    text,
                    left.ids[:keep_left] + middle.ids[head:tail] + rest,
                    left.begins[:keep_left] + places[head:tail] + at,
                )
        if a == 0 and b == len(text):
            return Piece(text, middle.ids, places)
        width *= 2


def _index(begins: list[int], at: int) -> int | None:
    """The only id that begins at a character; None if several do, or none."""
    from bisect import bisect_left, bisect_right

    first = bisect_left(begins, at)
    return first if bisect_right(begins, at) == first + 1 else None


def _token_start(begins: list[int], at: int) -> int:
    from bisect import bisect_right

    i = bisect_right(begins, at) - 1
    return begins[i] if i >= 0 else 0


def _agree_left(left: Piece, middle: Piece, places: list[int], a: int) -> int | None:
    """The first id of the window at which the left half has the same id, so that all
    before it can come from the left half. The window may begin inside a word, so the
    id before it must agree too."""
    border = len(left.text)
    for i in range(1, len(middle.ids)):
        if places[i] >= border - 1:
            return None
        j, k = _index(left.begins, places[i]), _index(left.begins, places[i - 1])
        if j is None or k is None or j != k + 1 or places.count(places[i]) != 1:
            continue
        if left.ids[j] == middle.ids[i] and left.ids[k] == middle.ids[i - 1]:
            return i
    return None


def _agree_right(right: Piece, middle: Piece, places: list[int], border: int) -> int | None:
    """The last id of the window at which the right half has the same id, with the id
    after it agreeing too, so that all from it on can come from the right half."""
    for i in range(len(middle.ids) - 2, -1, -1):
        if places[i] <= border:
            return None
        j, k = _index(right.begins, places[i] - border), _index(right.begins, places[i + 1] - border)
        if j is None or k is None or k != j + 1:
            continue
        if right.ids[j] == middle.ids[i] and right.ids[k] == middle.ids[i + 1]:
            return i
    return None


def concatenate(library, pieces: list[Piece]) -> Piece:
    """Neighbours joined level by level, up to the root of the tree."""
    while len(pieces) > 1:
        pairs = [pieces[i : i + 2] for i in range(0, len(pieces), 2)]
        pieces = [join(library, *p) if len(p) == 2 else p[0] for p in pairs]
    return pieces[0]


def encoded(
    docs: DataFrame,
    path: str,
    finish: Callable[[np.ndarray, np.ndarray], list[pa.Array]],
    schema: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """Every document encoded; ``finish`` turns (ids, offsets) of a batch into the
    columns of ``schema`` after the id.

    Texts up to ``leaf_chars`` are encoded where they are read. A longer one becomes
    one row per leaf; leaves are dealt out and encoded in parallel and meet again by
    document, which holds no more than the text's own row did."""
    ship(docs.sparkSession)
    fields = f"doc_id long, {schema}"
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    long_one = F.length("text") > leaf_chars

    def answer(ids: pa.Array, flat: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        names = [part.split()[0] for part in fields.split(", ")]
        return pa.RecordBatch.from_arrays([ids, *finish(flat, offsets)], names)

    def plain(batch):
        return answer(batch.column(0), *word_encoder(path).encode(batch.column(1)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                parts = leaves(text, leaf_chars)
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array(parts, pa.string())],
                    ["doc", "doc_id", "part", "text"],
                )

    def leaf(batch):
        library = tokenizer(path)
        pieces = [whole(library, t) for t in batch.column(3).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([p.ids for p in pieces], pa.list_(pa.int32())),
             pa.array([p.begins for p in pieces], pa.list_(pa.int32()))],
            ["doc", "doc_id", "part", "text", "ids", "begins"],
        )

    def tree(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        columns = (table.column(c).to_pylist() for c in ("text", "ids", "begins"))
        root = concatenate(tokenizer(path), [Piece(*x) for x in zip(*columns)])
        flat = np.array(root.ids, np.uint32)
        one = answer(table.column("doc_id").chunk(0).slice(0, 1), flat, np.array([0, len(flat)]))
        return pa.Table.from_batches([one])

    short = rows.filter(~long_one | F.col("text").isNull()).mapInArrow(over_slices(plain, 1), fields)
    parts = (
        rows.filter(long_one)
        .select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text")
        .mapInArrow(split, "doc long, doc_id long, part int, text string")
        .repartition(partitions(docs.sparkSession), "doc", "part")
        .mapInArrow(
            over_slices(leaf, 3),
            "doc long, doc_id long, part int, text string, ids array<int>, begins array<int>",
        )
    )
    return short.unionByName(parts.groupBy("doc").applyInArrow(tree, fields))


@lru_cache(maxsize=4)
def _token_strings(path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of every token, each followed by a blank, and the offsets."""
    library = tokenizer(path)
    tokens = [(library.id_to_token(i) or "").encode() + b" " for i in range(library.get_vocab_size())]
    return (
        np.frombuffer(b"".join(tokens), np.uint8),
        np.concatenate([[0], np.cumsum([len(t) for t in tokens])]),
    )


def decoded(path: str, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """What the library's ``decode(ids, skip_special_tokens=False)`` gives, in UTF-8. A
    tokenizer without a decoder joins its tokens with blanks, which is a lookup."""
    library = tokenizer(path)
    edges = offsets.tolist()
    if library.decoder is not None:
        return [
            library.decode(ids[a:b].tolist(), skip_special_tokens=False).encode()
            for a, b in zip(edges, edges[1:])
        ]
    data, begin = _token_strings(path)
    size = np.diff(begin)[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    out = data[np.arange(total[-1]) - np.repeat(total[:-1] - begin[ids], size)].tobytes()
    ends = total[offsets].tolist()
    return [out[a : max(a, b - 1)] for a, b in zip(ends, ends[1:])]


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the
    decoded text."""

    def finish(ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        little, edges = ids.astype("<u4"), offsets.tolist()
        return [
            pa.array(np.diff(offsets), pa.int64()),
            pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in zip(edges, edges[1:])]),
            pa.array([hashlib.sha256(t).hexdigest() for t in decoded(path, ids, offsets)]),
        ]

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded(docs, path, finish, schema)
