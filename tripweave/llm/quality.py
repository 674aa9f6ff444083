"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: words and pairs of words (case aside),
triples of marks that tell whether a word repeats one of the two before it, and strings
of two to four bytes (case kept). Each is scaled by its class log-count ratio,
rows are brought to length one, and a linear model with hinge loss is fitted by dual
coordinate descent. A part of the labelled rows that the model has not seen turns its margins
into probabilities (Platt).

The model is fitted on all labelled rows. Counts are summed over all of them; the linear
model is fitted on shards of about ``SHARD`` rows side by side and the weights are averaged
(``learning``); every fifth row is held back and scales the margins. Scoring reads every whole
text once. Only texts and training labels enter a score.

Null and empty texts get the score of a text without features. Labels that are null or
neither 0 nor 1 are ignored; a document labelled twice counts by its smaller label.
With labels of one class only, or none, every score is the smoothed share of label 1.
Repeated rows and rows with a null id are scored each. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import learning
from tripweave.llm import text as tx
from tripweave.llm.runtime import give_back, land, over_slices, ship, slices, small_batches

BITS = 18
SLOTS = 1 << BITS
#: Rows of a shard that is fitted on its own.
SHARD = 2048
HELD_BACK = 5
#: Weights that stand in one row of the parameters.
WIDE = 16
#: Bytes of text whose features are made at a time.
SLICE = 1 << 20


class Features:
    """Distinct feature slots of each text of a batch."""

    def __init__(self):
        self._last = np.zeros(SLOTS, np.int32)

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        data, offsets = tx.utf8(column)
        starts, ends, firsts = tx.words(data, offsets)
        h = tx.hash_spans(tx.LOWER[data], starts, ends)
        grams = [(self._slot(h, 1), firsts, 1), (self._slot(tx.combine(h, 2), 2), firsts, 2)]
        place = np.arange(len(h)) - np.repeat(firsts[:-1], np.diff(firsts))
        again = np.zeros(len(h), tx.U64)
        again[1:] += (h[1:] == h[:-1]) & (place[1:] > 0)
        again[2:] += tx.U64(2) * ((h[2:] == h[:-2]) & (place[2:] > 1))
        grams.append((self._slot(tx.combine(again, 3), 3), firsts, 3))
        code = data.astype(np.uint32)
        for n in (2, 3, 4):
            code = (code[:-1] << np.uint32(8)) | data[n - 1 :] if len(data) >= n else code[:0]
            grams.append((self._slot(code.astype(tx.U64), 8 + n), offsets, n))
        for i in range(len(offsets) - 1):
            parts = [g[b[i] : max(b[i], b[i + 1] - n + 1)] for g, b, n in grams]
            slots = np.concatenate(parts)
            order = np.arange(len(slots), dtype=np.int32)
            self._last[slots] = order
            yield slots[self._last[slots] == order]

    @staticmethod
    def _slot(code: np.ndarray, salt: int) -> np.ndarray:
        spread = (code + tx.U64(salt)) * tx.U64(0x9E3779B97F4A7C15)
        spread ^= spread >> tx.U64(29)
        return ((spread * tx.U64(0xD6E8FEB86659FD93)) >> tx.U64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    """Margins are (weights over the row's slots) / (length of the scaled row) + bias."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, slots: np.ndarray) -> float:
        length = float(self.squares[slots].sum()) ** 0.5 if len(slots) else 0.0
        return float(self.weights[slots].sum()) / length + self.bias if length else self.bias

    def score(self, slots: np.ndarray) -> float:
        return float(_sigmoid(self.slope * self.margin(slots) + self.offset))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Scaled(Sequence):
    """Rows of slots and their values, ``ratio`` brought to length one. The values are made
    when a row's turn comes, so the driver never holds them all."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        slots = self.rows[i]
        values = self.ratio[slots]
        length = float(values @ values) ** 0.5
        return slots, values / length if length else values


def descend(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 1.0, rounds: int = 12
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model with hinge loss, by dual coordinate descent.
    Rows are (slots, values) of length one; the bias is one more feature of value 1."""
    w, bias, alpha = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(11)
    norm = [float(v @ v) + 1.0 for _, v in rows]
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slots, values = rows[i]
            gradient = y[i] * (float(w[slots] @ values) + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[slots] += step * y[i] * values
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model for rows of slots with labels 0 and 1."""
    y = np.where(labels == 1, 1.0, -1.0)
    positive, negative = float((y > 0).sum()), float((y < 0).sum())
    if not positive or not negative:
        return _constant(positive, negative)
    counts = np.ones((2, SLOTS))
    held = np.arange(len(rows)) % HELD_BACK == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False
    for slots, sign, out in zip(rows, y, held):
        if not out:
            counts[int(sign > 0)][slots] += 1
    ratio = _ratio(counts)
    scaled = Scaled([slots for slots, out in zip(rows, held) if not out], ratio)
    w, bias = descend(scaled, y[~held])
    model = Model((w * ratio).astype(np.float32), (ratio**2).astype(np.float32), bias, 1.0, 0.0)
    judge = held if held.any() else ~held
    margins = np.array([model.margin(s) for s, h in zip(rows, judge) if h])
    model.slope, model.offset = _platt(margins, y[judge] > 0, np.ones(len(margins)))
    return model


def _constant(positive: float, negative: float) -> Model:
    """Scores that are all the smoothed share of label 1."""
    zero = np.zeros(SLOTS, np.float32)
    return Model(zero, zero, 0.0, 1.0, float(np.log((positive + 1) / (negative + 1))))


def _ratio(counts: np.ndarray) -> np.ndarray:
    """The log-count ratio of every slot, from smoothed counts of labels 0 and 1."""
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _platt(margin: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds, by Newton steps on smoothed targets. ``count``:
    rows of each margin."""
    n, m = count[positive].sum(), count[~positive].sum()
    target = np.where(positive, (n + 1) / (n + 2), 1 / (m + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones(len(margin))])
    for _ in range(100):
        p = _sigmoid(at @ x)
        g = x @ (count * (p - target))
        hessian = (x * count * (p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, g)
        at = at - move * min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
    return float(max(at[0], 1e-3)), float(at[1])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    shard_rows: int = SHARD,
) -> Model:
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    # Written, so that Spark knows its size when it plans the join with the texts.
    usable = land(usable, "usable")
    count = usable.count()
    rows = learning.labelled(
        docs, usable, count, ~held_out(id_col), id_col, text_col, shard_rows, HELD_BACK
    )
    each, some, judge = learning.parts(rows)
    if not min(each.values()):
        return _constant(each[1], each[0])
    ratio = _ratio(_counts(some))
    held = spark.sparkContext.broadcast(ratio)

    def learn(shard, values, batches):
        features, slots, labels = Features(), [], []
        for batch in batches:
            labels += batch.column(1).to_pylist()
            for piece in slices(batch, 3, SLICE):
                slots += features.of(piece.column(3))
        w, bias = descend(Scaled(slots, held.value), np.where(np.array(labels) == 1, 1.0, -1.0))
        values[:-1], values[-1, 0] = w.reshape(-1, WIDE), bias
        return values

    # Every shard starts from nothing, and the mean of what they find is the model.
    shards = max(1, -(-count // shard_rows))
    state = learning.mixed(some, learn, np.zeros((SLOTS // WIDE + 1, WIDE)), shards=shards)
    weights, bias = state[:-1].ravel() * ratio, float(state[-1, 0])
    model = Model(weights.astype(np.float32), (ratio**2).astype(np.float32), bias, 1.0, 0.0)
    given = spark.sparkContext.broadcast(model)

    def margins(batch):
        found = [given.value.margin(slots) for slots in Features().of(batch.column(3))]
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(found)], ["label", "margin"])

    judged = judge.mapInArrow(over_slices(margins, 3, SLICE), "label int, margin double")
    found = learning.folded(judged)
    margin, label, n = (found.column(c).to_numpy() for c in ("margin", "label", "count"))
    model.slope, model.offset = _platt(margin, label == 1, n.astype(float))
    return model


def _counts(rows: DataFrame) -> np.ndarray:
    """Of labels 0 and 1, how many rows have each slot, and one more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(), np.zeros((2, SLOTS), np.int64)
        for batch in batches:
            for piece in slices(batch, 3, SLICE):
                for label, slots in zip(piece.column(1).to_pylist(), features.of(piece.column(3))):
                    counts[label][slots] += 1
        met = np.flatnonzero(counts.any(axis=0))
        arrays = [pa.array(met), pa.array(counts[0][met]), pa.array(counts[1][met])]
        yield pa.RecordBatch.from_arrays(arrays, ["slot", "n0", "n1"])
        give_back()

    each = rows.mapInArrow(work, "slot long, n0 long, n1 long")
    found = each.groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    counts = np.ones((2, SLOTS))
    for label, name in enumerate(("n0", "n1")):
        counts[label][found.column("slot").to_numpy()] += found.column(name).to_numpy()
    return counts


def score_with(model: Model, spark, text_col: str = "text") -> Column:
    """The score of each row, 0 to 1."""
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for part in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["text"])
            found = [
                held.value.score(slots)
                for piece in slices(batch, 0, SLICE)
                for slots in features.of(piece.column(0))
            ]
            yield pd.Series(found, dtype="float64")
        give_back()

    return score(F.col(text_col).cast("string"))


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    shard_rows: int = SHARD,
) -> DataFrame:
    """All rows and columns of ``docs`` with held_out, score and predicted."""
    model = train(docs, labels, id_col, text_col, shard_rows=shard_rows)
    return (
        docs.withColumn("held_out", held_out(id_col))
        .withColumn("score", score_with(model, docs.sparkSession, text_col))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
