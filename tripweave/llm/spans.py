"""Substring deduplication by sliding spans of sentences.

Sentences end after ``. ! ?`` at the end of a word and at line breaks. A sentence of more
than ``LONG`` words is cut further, after the word of the smallest hash (all of them, if
several are equal) of every ``GAP`` consecutive words, so that long passages without a
full stop line up too wherever they stand. Runs are at least ``min_pieces`` such pieces
and ``min_words`` words long. The shortest run that starts at a piece and the shortest one
that ends at it are hashed (case aside) for every piece; together they cover whatever any
longer run would, so removals are those of *every* run of that size or more. A run is
*repeated* if it occurs more than once in all documents, by two independent hashes of 64
bits, of its words and of its bytes. Of a repeated run the occurrence with the smallest
(id, position) is kept; pieces covered by any other occurrence are removed.

With the defaults a repeated passage of 51 words always holds a run, whatever surrounds it:
at most 15 words at either end belong to a short sentence that begins or ends outside.

Runs are counted before anything is joined, so that only repeated ones travel with
their places, and a passage that a third of all documents share is folded by partial
counts and split as a hot join key. Texts are joined to removals by id at the end.

Rows with a null id or text, empty texts and texts shorter than one run lose nothing.
Rows that repeat an id are one document: equal places of theirs count as one
occurrence, and each of the rows loses what the id loses. Columns other than id and
text are ignored by ``repeated_spans`` and passed through by ``cut``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm import text as tx
from tripweave.llm.runtime import land, let_go, over_slices, screened, ship

#: Words of a sentence that is not cut further.
LONG = 16
#: Consecutive words of a longer sentence of which one at least ends a piece.
GAP = 8
_CUTS = np.zeros(256, dtype=bool)
_CUTS[[ord(c) for c in ".!?"]] = True
_ODD = 0x9E3779B97F4A7C15
_OTHER = 0xC2B2AE3D27D4EB4F


def _pieces(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, h: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The first word of each piece, and the offset of each text's first piece."""
    n = len(starts)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    begins = np.zeros(n + 1, dtype=bool)
    begins[1:] = _CUTS[data[ends - 1]]
    begins[1:n] |= lines[starts[1:]] > lines[ends[:-1]]
    begins[firsts] = True
    sentences = np.flatnonzero(begins)
    size = np.diff(np.append(sentences, n)) if sentences[-1] < n else np.diff(sentences)
    long = np.repeat(size > LONG, size)
    begins[1:] |= _least(h, firsts) & long
    at = np.flatnonzero(begins[:n])
    return at, np.searchsorted(at, firsts)


def _least(h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a word has the smallest hash of any ``GAP`` consecutive words of a text."""
    out = np.zeros(len(h), dtype=bool)
    n = len(h) - GAP + 1
    if n <= 0:
        return out
    least = h[:n].copy()
    for j in range(1, GAP):
        np.minimum(least, h[j : j + n], out=least)
    whole = np.ones(len(h) + GAP, dtype=bool)
    for j in range(1, GAP):
        whole[firsts[1:] - j + GAP] = False
    for j in range(GAP):
        out[j : j + n] |= (h[j : j + n] == least) & whole[GAP : GAP + n]
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=tx.U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _rolled(values: np.ndarray, base: int, first: np.ndarray, last: np.ndarray, length: np.ndarray):
    """A hash of each of the value runs [first, last) that does not depend on their place."""
    total = np.concatenate([np.zeros(1, tx.U64), np.cumsum(values * _powers(base, len(values)))])
    own = (total[last] - total[first]) * _powers(pow(base, -1, 1 << 64), len(values) + 1)[first]
    return tx.mix(tx.mix(own) ^ length.astype(tx.U64)).view(np.int64)


def _runs(column: pa.Array, min_pieces: int, min_words: int):
    """Text number, both hashes, start and end character of every run of a batch."""
    data, offsets = tx.utf8(column)
    starts, ends, firsts = tx.words(data, offsets)
    if not len(starts):
        return None
    lower = tx.LOWER[data]
    h = tx.hash_spans(lower, starts, ends)
    at, first_piece = _pieces(data, starts, ends, firsts, h)
    n = len(starts)
    bounds = np.append(at, n)
    counts = np.diff(first_piece)
    owner = np.repeat(np.arange(len(counts)), counts)
    index = np.arange(len(at))
    stop = np.maximum(np.searchsorted(bounds, at + min_words), index + min_pieces)
    whole = stop <= first_piece[1:][owner]
    begin = np.searchsorted(bounds, bounds[1:] - min_words, side="right") - 1
    begin = np.minimum(begin, index + 1 - min_pieces)
    fits = begin >= first_piece[:-1][owner]
    # A run that is the shortest from both sides is taken once.
    fits[fits] &= stop[begin[fits]] != index[fits] + 1
    run_first = np.concatenate([index[whole], begin[fits]])
    run_stop = np.concatenate([stop[whole], index[fits] + 1])
    owner, first, last = owner[run_first], at[run_first], bounds[run_stop]
    run = _rolled(h, _ODD, first, last, last - first)
    # The second hash is of the bytes of the words, without what stands between them.
    in_words = tx.WORD_BYTES[data]
    before = np.concatenate([[0], np.cumsum(in_words)])
    low, high = before[starts[first]], before[ends[last - 1]]
    proof = _rolled(lower[in_words].astype(tx.U64) + tx.U64(1), _OTHER, low, high, high - low)
    chars = tx.char_offsets(data)
    base = chars[offsets[:-1]][owner]
    return owner, run, proof, chars[starts[first]] - base, chars[ends[last - 1]] - base


def occurrences(
    docs: DataFrame, id_col: str, text_col: str, min_pieces: int, min_words: int
) -> DataFrame:
    """(run, proof, doc_id, start, end): every run with its place in code points."""
    ship(docs.sparkSession)

    def work(batch):
        found = _runs(batch.column(1), min_pieces, min_words)
        if found is None:
            return None
        owner, run, proof, start, end = found
        ids = batch.column(0).take(pa.array(owner))
        places = [pa.array(start, pa.int32()), pa.array(end, pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array(run), pa.array(proof), ids, *places], ["run", "proof", "doc_id", "start", "end"]
        )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rows = rows.filter(F.col(id_col).isNotNull())
    return rows.mapInArrow(over_slices(work, 1), "run long, proof long, doc_id long, start int, end int")


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_pieces: int = 2,
    min_words: int = 20,
) -> DataFrame:
    """doc_id, spans (sorted, merged ranges of code points to remove, end exclusive) and
    first_doc_ids (where they stand first), for every document that loses some."""
    spark = docs.sparkSession
    places = occurrences(docs, id_col, text_col, min_pieces, min_words)
    # Written before they are joined: a join of two plain tables can split a hot run,
    # one that an aggregation feeds in the same stage cannot.
    key = ["run", "proof"]
    repeated = land(places.groupBy(key).count().filter("count > 1").select(key), "repeated")
    let_go(spark)
    repeats = land(places.join(repeated, key), "repeats")
    let_go(spark)
    firsts = land(
        repeats.groupBy(key).agg(F.min(F.struct("doc_id", "start")).alias("first")), "firsts"
    )
    let_go(spark)
    later = (
        repeats.join(firsts, key)
        .filter(F.struct("doc_id", "start") != F.col("first"))
        .select("doc_id", "start", "end", F.col("first.doc_id").alias("first_doc_id"))
        .distinct()
    )
    in_text = Window.partitionBy("doc_id").orderBy("start", "end", "first_doc_id")
    reach = F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int")
    merged = (
        later.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(in_text))
        .groupBy("doc_id", "span")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.collect_set("first_doc_id").alias("ids"),
        )
    )
    return merged.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("first_doc_ids"),
    )


def _without(text: str | None, ranges) -> str | None:
    if text is None or ranges is None:
        return text
    kept, at = [], 0
    for r in ranges:
        kept.append(text[at : r["start"]])
        at = r["end"]
    return "".join([*kept, text[at:]])


def cut(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """The documents that lose something, without the given ranges of their texts; the
    other columns stay, and ``spans`` and ``first_doc_ids`` are added."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([_without(t, r) for t, r in zip(texts, ranges)], dtype=object)

    # Written, so that only texts that may lose something are shuffled for the join.
    found = land(spans.withColumnRenamed("doc_id", "_id"), "spans")
    count = found.count()
    let_go(docs.sparkSession)
    some = screened(docs, id_col, found.select("_id"), count).filter("_perhaps").drop("_perhaps")
    hit = some.join(found, F.col(id_col).cast("long") == F.col("_id")).drop("_id")
    return hit.withColumn(text_col, kept(F.col(text_col).cast("string"), "spans"))
