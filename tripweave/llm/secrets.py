"""Secret scans: fixed rules, and a character convolutional network beside them.

The rules find *base* spans: assignments to names such as ``password`` or ``token``,
access keys and long hexadecimal strings, leftmost and non-overlapping per kind. Besides
these, every run of ``CANDIDATE`` or more characters that secrets are made of is a
candidate, and so is one of ``SHORT`` or more that mixes letters and digits. A small
convolutional network, written in numpy, reads each candidate whole with its surroundings: a
run longer than a window by its parts between signs, as far as these are candidates
themselves, and in overlapping windows along it, every ``STRIDE`` characters and at its end.
What it finds likely enough is added as a span of kind ``found``, unless it touches a base
span: parts first, then windows that meet none of these, overlapping ones as one. Base
spans always stay.

The network is trained on labelled findings: candidates inside base spans against all
others, with the surroundings blanked at random so that it learns the shape of secrets
and not only the names before them. It is fitted on all distinct windows, dealt to shards
of about ``SHARD`` that learn side by side (``learning``); a quarter of them is held back
to calibrate its scores (Platt) and to set the threshold: the highest one that still
finds ``recall`` of the findings held back. Scanning and scoring cover every text to its
end. With fewer than eight distinct windows of either label nothing is added.

A null or empty text has no spans. Nulls in the id, repeated rows and extra columns do
no harm: every row is scanned on its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import learning
from tripweave.llm import text as tx
from tripweave.llm.runtime import land, over_slices, ship, slices

# The base rules, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "found")
LEAST = {"assign": 8, "access": 16, "hex": 32}

CANDIDATE, SHORT = 16, 8
BEFORE, INSIDE, AFTER = 24, 48, 24
STRIDE = INSIDE // 2
WIDTH = BEFORE + INSIDE + AFTER
#: Windows of a shard that learns on its own.
SHARD = 8192
#: Distinct windows that either label needs.
LEAST_OF_EACH = 8
_HEX = np.zeros(256, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_SECRET = np.zeros(256, dtype=bool)
_SECRET[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *map(ord, "+/_=-")]] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[[*range(0x30, 0x3A)]] = True
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[[ord(":"), ord("=")]] = True

SCANNED = (
    "doc_id long, base array<struct<kind:int,start:int,end:int>>, "
    "candidates array<struct<start:int,end:int,label:int,window:binary>>"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the assignments and access keys of a text."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= LEAST["assign"]:
            found.append((0, m.start(), m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST["access"]:
            found.append((1, m.start(), m.end()))
    return found


def window(data: np.ndarray, low: int, high: int, start: int, end: int) -> bytes:
    """A candidate of ``INSIDE`` bytes at most with its surroundings in a fixed number of
    bytes. Zeros stand where the text [low, high) has nothing."""
    out = np.zeros(WIDTH, np.uint8)
    before = data[max(low, start - BEFORE) : start]
    out[BEFORE - len(before) : BEFORE] = before
    own = data[start:end]
    out[BEFORE : BEFORE + len(own)] = own
    after = data[end : min(high, end + AFTER)]
    out[BEFORE + INSIDE : BEFORE + INSIDE + len(after)] = after
    return out.tobytes()


def scan_texts(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Base spans and candidates of each text, in code points."""
    data, offsets = tx.utf8(column)
    n = len(offsets) - 1
    chars = tx.char_offsets(data)
    signs = np.concatenate([[0], np.cumsum(_SIGNS[data])])
    base: list[list] = [[] for _ in range(n)]
    candidates: list[list] = [[] for _ in range(n)]
    raw = data.tobytes()
    # No assignment without a sign and no access key without its first letters.
    read = set(np.flatnonzero(signs[offsets[1:]] > signs[offsets[:-1]]).tolist())
    at = raw.find(b"AKIA")
    while at >= 0:
        read.add(int(np.searchsorted(offsets, at, side="right")) - 1)
        at = raw.find(b"AKIA", at + 4)
    for i in read:
        base[i] += base_spans(raw[offsets[i] : offsets[i + 1]].decode())
    for i, a, b in _long_runs(_HEX[data], offsets, LEAST["hex"]):
        base[i].append((2, int(chars[a] - chars[offsets[i]]), int(chars[b] - chars[offsets[i]])))
    for i, a, b, is_part in _candidate_runs(data, offsets):
        # Around a part there is only the rest of its run, which is no context.
        left, right = (a, b) if is_part else (int(offsets[i]), int(offsets[i + 1]))
        for low, high in _along(a, b):
            first, last = int(chars[low] - chars[offsets[i]]), int(chars[high] - chars[offsets[i]])
            label = int(any(s < last and first < e for _, s, e in base[i]))
            candidates[i].append((first, last, label, window(data, left, right, low, high)))
    candidates = [sorted(set(own)) for own in candidates]
    ordered = [sorted(own, key=lambda s: (s[1], s[0])) for own in base]
    whole = pa.int32()
    span = pa.struct([("kind", whole), ("start", whole), ("end", whole)])
    candidate = pa.struct([("start", whole), ("end", whole), ("label", whole), ("window", pa.binary())])
    return (
        pa.array([[dict(zip(span.names, s)) for s in own] for own in ordered], pa.list_(span)),
        pa.array(
            [[dict(zip(candidate.names, c)) for c in own] for own in candidates], pa.list_(candidate)
        ),
    )


def _along(start: int, end: int) -> list[tuple[int, int]]:
    """The windows in which a run is read: itself, or overlapping ones from end to end."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, STRIDE), end - INSIDE]]


def _candidate_runs(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(text, start, end, is_part) of all candidates, a long run's parts among them."""
    digits, letters = (np.concatenate([[0], np.cumsum(m[data])]) for m in (_DIGITS, _LETTERS))

    def likely(starts, ends):
        both = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
        return (ends - starts >= CANDIDATE) | ((ends - starts >= SHORT) & both)

    whole_starts, whole_ends, _ = tx.runs(_SECRET[data], offsets)

    def part_of_long(starts, ends):
        run = np.searchsorted(whole_starts, starts, side="right") - 1
        size = whole_ends[run] - whole_starts[run]
        return likely(starts, ends) & (size > INSIDE) & (size > ends - starts)

    runs = _long_runs(_SECRET[data], offsets, SHORT, likely)
    parts = _long_runs((_DIGITS | _LETTERS)[data], offsets, SHORT, part_of_long)
    return [(*run, False) for run in runs] + [(*part, True) for part in parts]


def _long_runs(
    member: np.ndarray, offsets: np.ndarray, least: int, also=lambda starts, ends: True
) -> list[tuple[int, int, int]]:
    """(text, start, end) of every maximal run of at least ``least`` member bytes for which
    ``also`` holds."""
    starts, ends, firsts = tx.runs(member, offsets)
    long = np.flatnonzero((ends - starts >= least) & also(starts, ends))
    texts = np.searchsorted(firsts, long, side="right") - 1
    return list(zip(texts.tolist(), starts[long].tolist(), ends[long].tolist()))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and candidates of every row, in code points."""
    ship(docs.sparkSession)

    def work(batch):
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *scan_texts(batch.column(1))], ["doc_id", "base", "candidates"]
        )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(over_slices(work, 1), SCANNED)


@dataclass
class Network:
    """Embedding, one convolution, the maximum over each of three regions, one output."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0

    REGIONS = ((0, BEFORE), (BEFORE - 4, BEFORE + INSIDE), (BEFORE + INSIDE - 4, WIDTH - 4))
    SPAN = 5

    @classmethod
    def fresh(cls, rng: np.random.Generator, dims: int = 8, filters: int = 24) -> Network:
        wide = cls.SPAN * dims
        return cls(
            rng.normal(0, 0.5, (130, dims)),
            rng.normal(0, wide**-0.5, (wide, filters)),
            np.zeros(filters),
            rng.normal(0, 0.1, 3 * filters),
            0.0,
        )

    @staticmethod
    def symbols(windows: list[bytes]) -> np.ndarray:
        """ASCII as it is, all else as one symbol; zeros as blank surroundings."""
        data = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)
        return np.minimum(data, 128).astype(np.int64)

    def forward(self, x: np.ndarray):
        seen = self.embed[x]
        n, dims = len(x), seen.shape[2]
        steps = WIDTH - self.SPAN + 1
        view = np.lib.stride_tricks.sliding_window_view(seen, self.SPAN, axis=1)
        columns = view.transpose(0, 1, 3, 2).reshape(n * steps, self.SPAN * dims)
        value = (columns @ self.filters + self.bias).reshape(n, steps, -1)
        tops, where = [], []
        for a, b in self.REGIONS:
            at = value[:, a:b].argmax(axis=1) + a
            where.append(at)
            tops.append(np.take_along_axis(value, at[:, None], axis=1)[:, 0])
        top = np.concatenate(tops, axis=1)
        pooled = np.maximum(top, 0)
        return pooled @ self.out + self.shift, (columns, top, pooled, where, steps)

    def margins(self, windows: list[bytes]) -> np.ndarray:
        x = self.symbols(windows)
        parts = [self.forward(x[i : i + 256])[0] for i in range(0, len(x), 256)]
        return np.concatenate([*parts, np.zeros(0)])

    def scores(self, windows: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(windows) + self.offset, -30, 30)))

    def step(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted log loss, by array."""
        margin, (columns, top, pooled, where, steps) = self.forward(x)
        delta = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(x)
        into = (delta[:, None] * self.out) * (top > 0)
        n, filters = len(x), self.filters.shape[1]
        value = np.zeros((n, steps, filters))
        rows, cols = np.arange(n)[:, None], np.arange(filters)[None, :]
        for r, at in enumerate(where):
            value[rows, at, cols] += into[:, r * filters : (r + 1) * filters]
        flat = value.reshape(n * steps, filters)
        back = (flat @ self.filters.T).reshape(n, steps, self.SPAN, -1)
        seen = np.zeros((n, WIDTH, back.shape[3]))
        for j in range(self.SPAN):
            seen[:, j : j + steps] += back[:, :, j]
        embed = np.zeros_like(self.embed)
        np.add.at(embed, x.ravel(), seen.reshape(-1, seen.shape[2]))
        return [embed, columns.T @ flat, flat.sum(0), pooled.T @ delta, np.array(delta.sum())]


class Adam:
    """The moves of a network's arrays. Gradients of second order are kept as roots, so
    that they can be averaged over shards like the arrays themselves."""

    def __init__(self, net: Network):
        self.net = net
        self.arrays = [net.embed, net.filters, net.bias, net.out, np.array([net.shift])]
        self.first = [np.zeros_like(a) for a in self.arrays]
        self.root = [np.zeros_like(a) for a in self.arrays]
        self.done = 0.0

    def epoch(self, x_all: np.ndarray, labels: np.ndarray, weight: np.ndarray, rng) -> None:
        """One pass over the rows, half of them with blanked surroundings."""
        order = rng.permutation(len(x_all))
        for i in range(0, len(order), 64):
            pick = order[i : i + 64]
            x = x_all[pick].copy()
            blank = rng.random(len(x)) < 0.5
            x[blank, :BEFORE] = 0
            x[blank, BEFORE + INSIDE :] = 0
            self.done += 1
            grads = self.net.step(x, labels[pick], weight[pick])
            for g, a, first, root in zip(grads, self.arrays, self.first, self.root):
                first += 0.1 * (g - first)
                root[...] = np.sqrt(root * root + 0.001 * (g * g - root * root))
                a -= 0.01 * (first / (1 - 0.9**self.done)) / (
                    root / np.sqrt(1 - 0.999**self.done) + 1e-8
                )
            self.net.shift = float(self.arrays[4][0])

    def state(self) -> np.ndarray:
        """Values, means and roots of all gradients, and the number of steps, as a matrix."""
        columns = [np.concatenate([a.ravel() for a in own]) for own in (self.arrays, self.first, self.root)]
        return np.vstack([np.stack(columns, axis=1), [[self.done, 0, 0]]])

    @classmethod
    def of(cls, state: np.ndarray) -> Adam:
        out = cls(Network.fresh(np.random.default_rng(7)))
        for own, column in zip((out.arrays, out.first, out.root), state.T):
            at = 0
            for a in own:
                a[...] = column[at : at + a.size].reshape(a.shape)
                at += a.size
        out.net.shift, out.done = float(out.arrays[4][0]), float(state[-1, 0])
        return out


def _weights(positive: float, negative: float) -> tuple[float, float]:
    """The weight of a row of label 0 and of one of label 1."""
    share = positive / (positive + negative)
    return 0.5 / (1 - share), 0.5 / share


def fit(samples: list[tuple[bytes, int]], recall: float = 0.98, epochs: int = 6) -> Network | None:
    """A network for labelled windows; None unless there are enough of both labels."""
    labels = np.array([label for _, label in samples], float)
    if min(labels.sum(), (1 - labels).sum()) < LEAST_OF_EACH:
        return None
    held = np.array([hashlib.blake2b(w, digest_size=1).digest()[0] % 4 == 0 for w, _ in samples])
    for label in (0, 1):  # both parts need both labels
        own = np.flatnonzero(labels == label)
        held[own[0]], held[own[1]] = True, False
    rng = np.random.default_rng(7)
    adam = Adam(Network.fresh(rng))
    x_all, y = Network.symbols([w for w, _ in samples])[~held], labels[~held]
    weight = np.array(_weights(y.sum(), (1 - y).sum()))[y.astype(int)]
    for _ in range(epochs):
        adam.epoch(x_all, y, weight, rng)
    windows = [w for (w, _), h in zip(samples, held) if h]
    margins = adam.net.margins(windows)
    return _settle(adam.net, margins, labels[held], np.ones(len(margins)), recall)


def _settle(net: Network, margin: np.ndarray, y: np.ndarray, count: np.ndarray, recall: float) -> Network:
    """The network with slope, offset and threshold from margins of rows held back."""
    _calibrate(net, margin, y, count)
    own = np.argsort(margin)
    own = own[y[own] == 1]
    reached = np.cumsum(count[own])
    at = int(np.searchsorted(reached, int((1 - recall) * reached[-1]), side="right"))
    margin = margin[own[at]]
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * margin + net.offset, -30, 30))))
    return net


def _calibrate(net: Network, margin: np.ndarray, y: np.ndarray, count: np.ndarray) -> None:
    """Platt scaling: slope and offset of the log odds, by damped Newton steps with
    smoothed targets."""
    positive, negative = (count * y).sum(), (count * (1 - y)).sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = np.array([(count * (p - target) * margin).sum(), (count * (p - target)).sum()])
        w = count * (p * (1 - p) + 1e-6)
        hessian = np.array([[(w * margin**2).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        move = np.linalg.solve(hessian + 1e-3 * np.eye(2), g)
        move *= min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
        slope, offset = slope - move[0], offset - move[1]
    net.slope, net.offset = float(max(slope, 1e-3)), float(offset)


def _trained(scanned: DataFrame, shard_rows: int, recall: float, epochs: int = 6) -> Network | None:
    """A network for all distinct windows; None unless there are enough of both labels."""
    seen = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.window").alias("window"))
        .agg(F.max("c.label").alias("label"))
        .withColumn("held", F.pmod(F.xxhash64("window"), F.lit(4)) == 0)
    )
    seen = land(seen, "windows")
    each, train, judge = learning.parts(seen)
    if min(each.values()) < LEAST_OF_EACH:
        return None
    rows = learning.dealt(train.select("window", "label"), "window", sum(each.values()), shard_rows)
    rows = land(rows, "dealt")
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    weight = np.array(_weights(counts[1], counts[0]))
    state = Adam(Network.fresh(np.random.default_rng(7))).state()
    for turn in range(epochs):

        def learn(shard, values, batches, turn=turn):
            whole = pa.Table.from_batches(list(batches))
            y = whole.column("label").to_numpy()
            adam = Adam.of(values)
            x = Network.symbols(whole.column("window").to_pylist())
            adam.epoch(x, y.astype(float), weight[y], np.random.default_rng([7, turn, shard]))
            return adam.state()

        state = learning.mixed(rows, learn, state)
    net = Adam.of(state).net

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = pa.array(net.margins(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(1), margin], ["label", "margin"])

    judged = judge.select("window", "label").mapInArrow(margins, "label int, margin double")
    found = learning.folded(judged)
    margin, y, count = (found.column(c).to_numpy() for c in ("margin", "label", "count"))
    return _settle(net, margin, y.astype(float), count.astype(float), recall)


def _settled(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts and short runs as they are, and windows that meet none of them, joined where
    they overlap."""
    parts = [s for s in found if s[1] - s[0] != INSIDE]
    out: list[tuple[int, int]] = []
    for a, b in sorted(s for s in found if s[1] - s[0] == INSIDE):
        if any(c < b and a < d for c, d in parts):
            continue
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return parts + out


def found_spans(batch: pa.RecordBatch, base: int, candidates: int, net: Network | None):
    """All spans (kind, start, end) of each row, by start, then kind as listed."""
    spans = [[tuple(s.values()) for s in b] for b in batch.column(base).to_pylist()]
    rows = enumerate(batch.column(candidates).to_pylist())
    open_ones = [(row, c) for row, cs in rows for c in cs if not c["label"]]
    if net is not None and open_ones:
        scores = net.scores([c["window"] for _, c in open_ones])
        likely: dict[int, list[tuple[int, int]]] = {}
        for (row, c), score in zip(open_ones, scores.tolist()):
            if score >= net.threshold:
                likely.setdefault(row, []).append((c["start"], c["end"]))
        for row, found in likely.items():
            spans[row] += [(3, a, b) for a, b in _settled(found)]
    return [sorted(own, key=lambda s: (s[1], s[0])) for own in spans]


def findings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_rows: int = SHARD,
    recall: float = 0.98,
) -> DataFrame:
    """doc_id and spans (kind:start:end, comma-joined) of every row."""
    scanned = land(scan(docs, id_col, text_col), "scanned")
    held = docs.sparkSession.sparkContext.broadcast(_trained(scanned, shard_rows, recall))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in own)
                for own in found_spans(batch, 1, 2, held.value)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "spans"]
            )

    return scanned.mapInArrow(work, "doc_id long, spans string")


def cover(text: str | None, spans: list[tuple[int, int, int]], mask: str) -> str | None:
    """The text with every stretch that spans cover, together, replaced by ``mask``."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked(
    docs: DataFrame,
    mask: str = "[secret]",
    text_col: str = "text",
    shard_rows: int = SHARD,
    recall: float = 0.98,
) -> DataFrame:
    """All rows and columns, secrets in the text replaced by ``mask``. Rows are scanned
    and masked where they are, so nothing is joined; ``n_chars`` follows the text where
    there is such a column."""
    sample = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scanned = land(scan(sample).select("candidates").filter("size(candidates) > 0"), "candidates")
    held = docs.sparkSession.sparkContext.broadcast(_trained(scanned, shard_rows, recall))

    @F.pandas_udf("string")
    def covered(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            whole = pa.array(part, pa.string())
            out = []
            for piece in slices(pa.RecordBatch.from_arrays([whole], ["text"]), 0):
                base, candidates = scan_texts(piece.column(0))
                row = pa.RecordBatch.from_arrays([base, candidates], ["base", "candidates"])
                spans = found_spans(row, 0, 1, held.value)
                out += [cover(t, s, mask) for t, s in zip(piece.column(0).to_pylist(), spans)]
            yield pd.Series(out, dtype=object)

    changed = docs.withColumn(text_col, covered(F.col(text_col).cast("string")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length(text_col).cast(kind))
    return changed
