"""Toxicity: a convolutional text classifier, trained in numpy.

Words (runs of letters, digits and non-ASCII signs, case aside) are hashed to slots, and a
slot has an embedding. Filters of several widths run over the embeddings of a text; of each
filter the highest response anywhere in the text is kept (max pooling), and a linear layer
weighs them. Since only winning windows carry a gradient, training is cheap. A slot keeps
the signature of the word it was trained for, so a word that only shares its hash slot,
and every word met in fewer than ``KNOWN`` documents learnt from, has the zero vector.

The network is fitted on all labelled rows, dealt to shards of about ``SHARD`` that learn
side by side (``learning``). A fifth of them is held back and never
trained on; it sets the threshold on the network's margin, one for every language that
brings at least ``ENOUGH`` held-back rows of either label, one in all for the rest. The
language is told from the text itself by common function words; no column but the text
enters a score. Scores are logistic in the margin with 0.5 at the language's threshold.

Scoring reads every whole text once, in blocks of words, so a text of any length takes
bounded memory. Null and empty texts, and texts without a word, get the score of no
response at all. Labels that are null or neither 0 nor 1 are ignored; a document labelled
twice counts by its larger label. With labels of one class only, or none, every score is
the smoothed share of label 1. Repeated rows and rows with a null id are scored each. Extra
columns stay; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import learning
from tripweave.llm import text as tx
from tripweave.llm.runtime import land, over_slices, ship, slices, small_batches

BITS = 18
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 24
#: Rows of a shard that learns on its own, and words of it that are held at a time.
SHARD = 16384
HELD_WORDS = 1 << 22
#: Changes of shards are whole multiples of one part of this.
MOVES = float(1 << 20)
KNOWN = 3
HELD_BACK = 5
ENOUGH = 12
ROUNDS = 8
BATCH = 32
RATE = 0.1
#: Share of the words that a training round hides, so that a text's other words learn too.
HIDDEN = 0.4
#: Words that are scored at a time.
BLOCK = 1 << 15

# Function words by which a text's language is told.
LANGUAGES = {
    "en": "the of and to that is was for with it on be by this are from",
    "de": "der die das und zu den ist nicht ein eine mit von dem im auf für",
    "fr": "le les et est des dans pour une du qui pas sur au avec ce il",
    "es": "el los las y en un por con una su para es del se lo como",
}

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of a batch of texts, and where each text's words begin."""
    data, offsets = tx.utf8(column)
    starts, ends, firsts = tx.runs(_LETTERS[data], offsets)
    return tx.hash_spans(tx.LOWER[data], starts, ends), firsts


@cache
def _language_table() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all function words, and per word the languages it belongs to."""
    words = sorted({w for own in LANGUAGES.values() for w in own.split()})
    hashes, _ = word_hashes(pa.array(words))
    member = np.array([[w in own.split() for own in LANGUAGES.values()] for w in words])
    order = np.argsort(hashes)
    return hashes[order], member[order]


def languages(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The number of each text's language (the first of several that lead), or one past
    the last where no function word stands."""
    known, member = _language_table()
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    counts = np.zeros((len(hashes) + 1, len(LANGUAGES)), np.int64)
    np.cumsum(member[at] & hit[:, None], axis=0, out=counts[1:])
    each = counts[firsts[1:]] - counts[firsts[:-1]]
    return np.where(each.max(axis=1) > 0, each.argmax(axis=1), len(LANGUAGES))


@dataclass
class Network:
    """``rows`` maps a slot to its row of ``embeddings`` (0: unknown, the zero vector) where
    ``signs`` equals the word's hash. ``filters[i]`` is width x DIM x FILTERS."""

    rows: np.ndarray
    signs: np.ndarray
    embeddings: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    offset: float = 0.0
    slope: float = 1.0

    def words(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> tx.U64(64 - BITS)).astype(np.int64)
        return np.where(self.signs[slot] == hashes, self.rows[slot], 0)

    def pooled(self, words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The highest response of each filter in each text, at least 0."""
        out = np.zeros((len(firsts) - 1, len(WIDTHS) * FILTERS), np.float32)
        full = np.flatnonzero(np.diff(firsts))
        begins, ends = firsts[full], firsts[full + 1]
        tables = self._tables()
        for low in range(0, len(words), BLOCK):
            high = min(len(words), low + BLOCK)
            first, last = np.searchsorted(ends, low, "right"), np.searchsorted(begins, high, "left")
            cuts = np.maximum(begins[first:last], low) - low
            left = np.repeat(ends[first:last], np.diff(np.append(cuts, high - low))) - np.arange(low, high)
            response = self._responses(tables, words, low, high, left)
            best = np.maximum.reduceat(response, cuts, axis=0)
            texts = full[first:last]
            out[texts] = np.maximum(out[texts], best)
        return out

    def _tables(self, rows=slice(None)) -> list[list[np.ndarray]]:
        """What each row of the embeddings adds to the filters at each place of a window."""
        some = self.embeddings[rows]
        return [[some @ own[j] for j in range(len(own))] for own in self.filters]

    def _responses(self, tables, words, low, high, left) -> np.ndarray:
        """Of every window that begins in [low, high). ``left`` is the number of words from
        there to the end of the text; past it a window sees zero vectors."""
        shifted = []
        for j in range(max(WIDTHS)):
            own = np.zeros(high - low, np.int64)
            stop = min(len(words), high + j)
            own[: max(0, stop - low - j)] = words[low + j : stop]
            shifted.append(np.where(left > j, own, 0))
        out = np.empty((high - low, len(WIDTHS) * FILTERS), np.float32)
        for i, own in enumerate(tables):
            total = own[0][shifted[0]]
            for j in range(1, len(own)):
                total += own[j][shifted[j]]
            out[:, i * FILTERS : (i + 1) * FILTERS] = total
        return out + self.bias

    def margins(self, words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        return self.pooled(words, firsts) @ self.weights + self.offset

    def scores(self, column: pa.Array) -> np.ndarray:
        hashes, firsts = word_hashes(column)
        margin = self.margins(self.words(hashes), firsts)
        return _sigmoid(self.slope * (margin - self.thresholds[languages(hashes, firsts)]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class _Adagrad:
    """A network's arrays with the sums of their squared gradients."""

    def __init__(self, net: Network):
        self.net, self.offset = net, np.zeros(1, np.float32)
        self.values = [net.embeddings, net.bias, net.weights, self.offset, *net.filters]
        self.squares = [np.full(v.shape, 1e-3, np.float32) for v in self.values]

    def step(self, at: int, gradient: np.ndarray, where=...) -> None:
        self.squares[at][where] += gradient * gradient
        self.values[at][where] -= RATE * gradient / np.sqrt(self.squares[at][where])

    def state(self) -> np.ndarray:
        """All values and squares as one matrix, a row of an embedding to a row."""

        def tall(arrays):
            padded = [np.pad(a.ravel(), (0, -a.size % DIM)) for a in arrays]
            return np.concatenate(padded).reshape(-1, DIM)

        return np.hstack([tall(self.values), tall(self.squares)])

    def take(self, state: np.ndarray) -> None:
        for arrays, half in ((self.values, state[:, :DIM]), (self.squares, state[:, DIM:])):
            at = 0
            for a in arrays:
                rows = -(-a.size // DIM)
                a[...] = half[at : at + rows].ravel()[: a.size].reshape(a.shape)
                at += rows
        self.net.offset = float(self.offset[0])


def _vocabulary(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and signatures of the slots; a slot goes to the word in most texts (ties: the
    smaller hash)."""
    rows, signs = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, tx.U64)
    if not texts:
        return rows, signs, 1
    words, count = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
    words, count = words[count >= KNOWN], count[count >= KNOWN]
    order = np.lexsort((words, -count))
    words = words[order]
    slot, first = np.unique((words >> tx.U64(64 - BITS)).astype(np.int64), return_index=True)
    rows[slot], signs[slot] = np.arange(1, len(slot) + 1), words[first]
    return rows, signs, len(slot) + 1


def fresh_network(rows: np.ndarray, signs: np.ndarray, size: int, rng) -> Network:
    """A network that has learnt nothing, without thresholds yet."""
    embeddings = rng.normal(0, 0.1, (size, DIM)).astype(np.float32)
    embeddings[0] = 0
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
    return Network(rows, signs, embeddings, filters, np.zeros(len(weights), np.float32), weights,
                   np.zeros(len(LANGUAGES) + 1))


def _blank(size: int) -> Network:
    """A network for parameters of its own, without words."""
    none = np.zeros(0, np.int32)
    shapes = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
    bias, weights = np.zeros((2, len(WIDTHS) * FILTERS), np.float32)
    return Network(none, none, np.zeros((size, DIM), np.float32), shapes, bias, weights, none)


def _group_weights(count: np.ndarray) -> np.ndarray:
    """The weight of a row of each group of language and label: by the root of the group's
    rows, so rare ones are learnt too; 1 on average."""
    weight = 1 / np.sqrt(np.maximum(count, 1))
    return (weight / max(1e-9, (weight * count).sum() / max(1, count.sum()))).astype(np.float32)


def _round(learn: _Adagrad, known: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rng) -> None:
    """One pass over texts given as rows of the embeddings."""
    order = rng.permutation(len(known))
    for low in range(0, len(order), BATCH):
        batch = order[low : low + BATCH]
        words = [known[i] for i in batch]
        words = [np.where(rng.random(len(w), np.float32) < HIDDEN, 0, w) for w in words]
        _learn(learn.net, learn, words, labels[batch], weight[batch] / len(batch), learn.offset)
    learn.net.offset = float(learn.offset[0])


def train_network(texts: list[np.ndarray], labels: np.ndarray) -> Network:
    """A network for texts given as word hashes, without thresholds yet."""
    rng = np.random.default_rng(7)
    rows, signs, size = _vocabulary(texts)
    net = fresh_network(rows, signs, size, rng)
    known = [net.words(t) for t in texts]
    learn = _Adagrad(net)
    group = np.array([languages(t, np.array([0, len(t)]))[0] for t in texts], np.int64) * 2 + labels
    weight = _group_weights(np.bincount(group))[group] if len(group) else np.zeros(0)
    for _ in range(ROUNDS):
        _round(learn, known, labels, weight, rng)
    return net


def _best(net: Network, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The highest response of each filter in each text, at least 0, and the words of the
    window that gives it."""
    wide, filters = max(WIDTHS), len(net.weights)
    # Zero vectors follow every text, so no window sees two texts.
    gap = np.zeros(wide, np.int64)
    flat = np.concatenate([part for own in words for part in (own, gap)])
    ends = np.cumsum([len(own) + wide for own in words]) - wide
    begins = ends - [len(own) for own in words]
    packed = np.zeros((wide * DIM, filters), np.float32)
    for i, own in enumerate(net.filters):
        packed[: own.shape[0] * DIM, i * FILTERS : (i + 1) * FILTERS] = own.reshape(-1, FILTERS)
    most = np.full((len(words), filters), -np.inf, np.float32)
    where = np.repeat(begins[:, None], filters, axis=1)
    each = np.arange(filters)
    for low in range(0, len(flat) - wide, BLOCK):
        high = min(len(flat) - wide, low + BLOCK)
        seen = net.embeddings[flat[low : high + wide - 1]].ravel()
        # Every row of this view is a window: its words' embeddings side by side.
        view = np.lib.stride_tricks.sliding_window_view(seen, wide * DIM)[::DIM]
        response = view @ packed
        for t in np.flatnonzero((begins < high) & (ends > low)).tolist():
            a, b = max(begins[t], low), min(ends[t], high)
            if a < b:
                own = response[a - low : b - low]
                at = own.argmax(axis=0)
                value = own[at, each]
                better = value > most[t]
                most[t][better], where[t][better] = value[better], at[better] + a
    won = flat[where[:, :, None] + np.arange(wide)]
    return np.maximum(most + net.bias, 0), won


def _learn(net: Network, learn: _Adagrad, words, labels, scale, offset) -> None:
    pooled, won = _best(net, words)
    error = (_sigmoid(pooled @ net.weights + offset[0]) - labels) * scale
    error = error.astype(np.float32)
    back = error[:, None] * net.weights * (pooled > 0)
    learn.step(2, pooled.T @ error)
    learn.step(3, np.array([error.sum()], np.float32))
    learn.step(1, back.sum(axis=0))
    met, moved = [], []
    for i, own in enumerate(net.filters):
        part = slice(i * FILTERS, (i + 1) * FILTERS)
        gradient = np.zeros_like(own)
        for j in range(len(own)):
            at = won[:, part, j]
            gradient[j] = np.einsum("tf,tfd->df", back[:, part], net.embeddings[at])
            used = (back[:, part] != 0) & (at > 0)
            met.append(at[used])
            moved.append((back[:, part][:, :, None] * own[j].T[None])[used])
        learn.step(4 + i, gradient)
    winners, inverse = np.unique(np.concatenate(met), return_inverse=True)
    if len(winners):
        gradient = np.zeros((len(winners), DIM), np.float32)
        np.add.at(gradient, inverse, np.concatenate(moved))
        learn.step(0, gradient, winners)


def best_threshold(
    margins: np.ndarray, labels: np.ndarray, prior: float, counts: np.ndarray | None = None
) -> float:
    """Where misses and false alarms together are rarest, label 1 having the share
    ``prior``; the middle of the first gap that does so. ``counts``: rows of each margin."""
    order = np.argsort(margins)
    m, y = margins[order], labels[order]
    n = np.ones(len(m)) if counts is None else counts[order]
    ones, zeros = n * (y == 1), n * (y == 0)
    missed = np.concatenate([[0], np.cumsum(ones)]) / max(1, ones.sum()) * prior
    alarms = (1 - np.concatenate([[0], np.cumsum(zeros)]) / max(1, zeros.sum())) * (1 - prior)
    cost = missed + alarms
    cost[1:-1][m[1:] == m[:-1]] = np.inf
    at = int(np.argmin(cost))
    low, high = m[max(at - 1, 0)], m[min(at, len(m) - 1)]
    return float((low + high) / 2)


def _set_thresholds(net: Network, margin, y, tongue, share: float, counts: np.ndarray) -> None:
    net.thresholds[:] = best_threshold(margin, y, share, counts)
    for language in range(len(LANGUAGES) + 1):
        own = tongue == language
        if min(counts[own & (y == 1)].sum(), counts[own & (y == 0)].sum()) >= ENOUGH:
            net.thresholds[language] = best_threshold(margin[own], y[own], share, counts[own])


def _constant(positive: int, negative: int) -> Network:
    """A network whose scores are all the smoothed share of label 1."""
    net = train_network([], np.zeros(0, np.int64))
    net.weights[:] = 0
    net.offset = float(np.log((positive + 1) / (negative + 1)))
    return net


def fit(texts: list[np.ndarray], labels: np.ndarray, prior: float | None = None) -> Network:
    """A network with thresholds, for texts as word hashes and labels 0 and 1."""
    labels = labels.astype(np.int64)
    held = np.arange(len(texts)) % HELD_BACK == 0
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held[:] = False
    if len(set(labels)) < 2:
        return _constant(int(labels.sum()), int(len(labels) - labels.sum()))
    net = train_network([t for t, h in zip(texts, held) if not h], labels[~held])
    judge = held if held.any() else ~held
    some = [t for t, j in zip(texts, judge) if j]
    hashes, firsts = np.concatenate(some), np.concatenate([[0], np.cumsum([len(t) for t in some])])
    margin, y = net.margins(net.words(hashes), firsts), labels[judge]
    share = float((labels == 1).mean()) if prior is None else prior
    _set_thresholds(net, margin, y, languages(hashes, firsts), share, np.ones(len(y)))
    return net


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    shard_rows: int = SHARD,
) -> Network:
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    # Written, so that Spark knows its size when it plans the join with the texts.
    usable = land(usable, "usable")
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    rows = learning.labelled(
        docs, usable, sum(counts.values()), ~held_out(id_col), id_col, text_col, shard_rows, HELD_BACK
    )
    each, some, judge = learning.parts(rows)
    if not min(each.values()):
        return _constant(each[1], each[0])
    net = fresh_network(*vocabulary(some), np.random.default_rng(7))
    encoded = land(_encoded(rows, net), "encoded")
    # The same parts of the rows, now with their words.
    _, some, judge = learning.parts(encoded)
    groups = np.zeros(2 * len(LANGUAGES) + 2)
    for r in some.groupBy("language", "label").count().collect():
        groups[2 * r.language + r.label] = r["count"]
    weights = _group_weights(groups)
    state, size = _Adagrad(net).state(), len(net.embeddings)
    for turn in range(ROUNDS):

        def learn(shard, values, batches, turn=turn):
            own = _Adagrad(_blank(size))
            own.take(values)
            rng = np.random.default_rng([7, turn, shard])
            for known, labels, tongue in _gathered(batches):
                _round(own, known, labels, weights[2 * tongue + labels], rng)
            return own.state()

        state = learning.mixed(some, learn, state, one=MOVES)
    _Adagrad(net).take(state)
    held = spark.sparkContext.broadcast(net)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for known, labels, tongue in _gathered([batch]):
                firsts = np.concatenate([[0], np.cumsum([len(k) for k in known])])
                margin = held.value.margins(np.concatenate(known), firsts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tongue), pa.array(labels), pa.array(margin, pa.float64())],
                    ["language", "label", "margin"],
                )

    judged = judge.mapInArrow(margins, "language long, label long, margin double")
    found = learning.folded(judged, "language")
    tongue, y, margin, n = (
        found.column(c).to_numpy() for c in ("language", "label", "margin", "count")
    )
    _set_thresholds(net, margin, y, tongue, counts.get(1, 0) / sum(counts.values()), n)
    return net


def vocabulary(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and signatures of the slots for the texts of a table; a slot goes to the word in
    most texts (ties: the smaller hash)."""

    def met(batch):
        hashes, firsts = word_hashes(batch.column(0))
        each = [np.unique(hashes[s:e]) for s, e in zip(firsts[:-1], firsts[1:])]
        words, count = np.unique(np.concatenate(each), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(count)], ["word", "n"])

    words = rows.select("text").mapInArrow(over_slices(met, 0), "word long, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= KNOWN)
    best = F.max_by("word", F.struct("n", F.bitwise_not("word"))).alias("word")
    slot = F.shiftrightunsigned("word", 64 - BITS)
    found = words.groupBy(slot.alias("slot")).agg(best).orderBy("slot").toArrow()
    slots = found.column("slot").to_numpy()
    places, signs = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, tx.U64)
    places[slots] = np.arange(1, len(slots) + 1)
    signs[slots] = found.column("word").to_numpy().view(tx.U64)
    return places, signs, len(slots) + 1


def _encoded(rows: DataFrame, net: Network) -> DataFrame:
    """The rows with their texts as language and rows of the embeddings."""
    held = rows.sparkSession.sparkContext.broadcast(net)

    def work(batch):
        hashes, firsts = word_hashes(batch.column(3))
        known = held.value.words(hashes).astype(np.int32)
        own = [known[s:e].tobytes() for s, e in zip(firsts[:-1], firsts[1:])]
        tongue = pa.array(languages(hashes, firsts), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], tongue, pa.array(own, pa.binary())],
            ["shard", "label", "held", "language", "words"],
        )

    return rows.mapInArrow(
        over_slices(work, 3), "shard int, label int, held boolean, language int, words binary"
    )


def _gathered(batches) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Words, labels and languages of encoded rows, about ``HELD_WORDS`` words at a time."""
    known, labels, tongues, total = [], [], [], 0
    for batch in batches:
        plain = (batch.column(c).to_pylist() for c in (1, 3, 4))
        for label, tongue, words in zip(*plain):
            if known and total + len(words) // 4 > HELD_WORDS:
                yield known, np.array(labels), np.array(tongues)
                known, labels, tongues, total = [], [], [], 0
            known.append(np.frombuffer(words, np.int32))
            labels.append(label)
            tongues.append(tongue)
            total += len(words) // 4
    if known:
        yield known, np.array(labels), np.array(tongues)


def score_with(net: Network, spark, text_col: str = "text") -> Column:
    """The score of each row, 0 to 1."""
    ship(spark)
    held = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])
            found = [held.value.scores(piece.column(0)) for piece in slices(batch, 0)]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return score(F.col(text_col).cast("string"))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    shard_rows: int = SHARD,
) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, score and predicted."""
    net = train(docs, labels, id_col, text_col, shard_rows=shard_rows)
    return (
        docs.withColumn("held_out", held_out(id_col))
        .withColumn("score", score_with(net, docs.sparkSession, text_col))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
