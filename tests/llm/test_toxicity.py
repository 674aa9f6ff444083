"""The toxicity classifier: held-out labels, whole texts, and pooling by brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries
from tripweave.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def made_up(n, seed=1, languages=("en", "de")):
    """Prose of two languages; odd ids hold a few of a language's bad words."""
    rng = random.Random(seed)
    bad = {"en": ["vile", "scoundrel", "rubbish"], "de": ["halunke", "schurke", "mist"]}
    docs, labels = [], []
    for i in range(n):
        language = languages[i // 2 % len(languages)]
        words = [rng.choice(toxicity.LANGUAGES[language].split()) for _ in range(25)]
        words += [f"w{rng.randrange(60)}" for _ in range(25)]
        if i % 2:
            words += rng.sample(bad[language], 2)
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, i % 2))
    return docs, labels


@pytest.fixture(scope="module")
def net():
    docs, labels = made_up(400)
    hashes, firsts = toxicity.word_hashes(pa.array([t for _, t in docs]))
    texts = [hashes[s:e] for s, e in zip(firsts[:-1], firsts[1:])]
    return toxicity.fit(texts, np.array([y for *_, y in labels]))


def scores(net, *texts):
    return net.scores(pa.array(texts, pa.string())).tolist()


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = queries()["op11_cnn_toxicity"](spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == pq.read_metadata(f"{sf_dir}/documents.parquet").num_rows
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    labels = [(r["doc_id"], r["toxic"]) for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()]
    judged = [(y, rows[i].predicted) for i, y in labels if rows[i].held_out]
    recall = np.mean([p for y, p in judged if y == 1])
    clean = np.mean([1 - p for y, p in judged if y == 0])
    # Some 300 toxic rows of four languages to learn from; with 1,700 it is 0.99 (README).
    assert recall >= 0.75 and clean >= 0.98


def test_bad_words_are_met_anywhere_and_alone(net):
    docs, labels = made_up(100, seed=9)
    got = scores(net, *(t for _, t in docs))
    assert np.mean([(s >= 0.5) == y for s, (*_, y) in zip(got, labels)]) > 0.95
    filler = "the of and to w1 w2 w3 " * 20_000
    hidden, clean = scores(net, filler + "vile scoundrel " + filler, filler + filler)
    assert hidden >= 0.5 > clean
    for text, score in zip([t for _, t in docs], got):
        assert scores(net, text)[0] == pytest.approx(score, abs=1e-5)


def test_pooling_equals_brute_force_in_blocks_of_any_size(net, monkeypatch):
    rng = np.random.default_rng(3)
    firsts = np.array([0, 0, 1, 3, 60, 60, 200])
    words = rng.integers(0, len(net.embeddings), firsts[-1])
    want = np.zeros((len(firsts) - 1, len(net.weights)))
    for t, (s, e) in enumerate(zip(firsts[:-1], firsts[1:])):
        own = np.concatenate([net.embeddings[words[s:e]], np.zeros((3, toxicity.DIM))])
        for i, (width, filters) in enumerate(zip(toxicity.WIDTHS, net.filters)):
            for f in range(toxicity.FILTERS):
                c = i * toxicity.FILTERS + f
                for at in range(e - s):
                    seen = (own[at : at + width] * filters[:, :, f]).sum() + net.bias[c]
                    want[t, c] = max(want[t, c], seen)
    for block in (1, 7, 64, 1 << 15):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.allclose(net.pooled(words, firsts), want, atol=1e-5)


def test_gradients_of_a_batch_lower_the_loss(net):
    docs, labels = made_up(60, seed=4)
    hashes, firsts = toxicity.word_hashes(pa.array([t for _, t in docs]))
    texts = [hashes[s:e] for s, e in zip(firsts[:-1], firsts[1:])]
    trained = toxicity.train_network(texts, np.array([y for *_, y in labels]))
    margin = trained.margins(trained.words(hashes), firsts)
    y = np.array([y for *_, y in labels])
    assert np.log1p(np.exp(np.where(y == 1, -margin, margin))).mean() < 0.3


def test_language_is_told_from_the_text():
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el perro y los gatos", "xyzzy", ""]
    hashes, firsts = toxicity.word_hashes(pa.array(texts))
    assert toxicity.languages(hashes, firsts).tolist() == [0, 1, 2, 3, 4, 4]


def test_thresholds():
    margins, labels = np.array([-2.0, -1.0, 1.0, 3.0]), np.array([0, 0, 1, 1])
    assert toxicity.best_threshold(margins, labels, 0.5) == 0.0
    assert toxicity.best_threshold(np.array([0.0, 0.0]), np.array([0, 1]), 0.9) <= 0.0


def test_odd_rows(spark):
    docs, labels = made_up(200)
    more = [(900, None), (901, ""), (902, " \n "), (None, "vile rubbish the of"), (903, "é" * 3), (5, docs[5][1])]
    frame = spark.createDataFrame([(*d, "x", 0.5) for d in docs + more], "doc_id long, text string, label string, score double")
    odd = [(900, 1, 1), (None, 1, 1), (901, 0, None), (902, 0, 7), (3, 1, 0)]
    table = spark.createDataFrame(labels + odd, LABELS)
    got = toxicity.scored(frame, table)
    assert got.columns == ["doc_id", "text", "label", "score", "held_out", "predicted"]
    rows = got.collect()
    assert len(rows) == 206
    by_id = {r.doc_id: r for r in rows}
    assert by_id[900].score == by_id[901].score == by_id[902].score
    assert by_id[None].predicted == 1 and by_id[None].held_out is False
    assert sum(r.doc_id == 5 for r in rows) == 2


def test_one_label_none_and_empty_tables(spark):
    docs, labels = made_up(20)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    ones = spark.createDataFrame([(i, 1, 1) for i, *_ in labels], LABELS)
    assert {r.predicted for r in toxicity.scored(frame, ones).collect()} == {1}
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.scored(frame, none).collect()} == {0.5}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.scored(empty, ones).count() == 0


def test_all_labelled_rows_are_learnt_or_judged_by(spark, monkeypatch):
    """More than 3,072 rows of a label, the cut there once was, in several shards."""
    docs, labels = made_up(8600, languages=("en",))
    docs.append((3, "a repeated id"))
    seen = {"learnt": []}
    mixed, folded = toxicity.learning.mixed, toxicity.learning.folded

    def spy_mixed(rows, *args, **more):
        seen["learnt"].append(rows.count())
        return mixed(rows, *args, **more)

    def spy_folded(margins, *by):
        seen["judged"] = margins.count()
        return folded(margins, *by)

    monkeypatch.setattr(toxicity.learning, "mixed", spy_mixed)
    monkeypatch.setattr(toxicity.learning, "folded", spy_folded)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = toxicity.scored(frame, spark.createDataFrame(labels, LABELS), shard_rows=2000).collect()
    usable = [y for i, _, y in labels if zlib.crc32(str(i).encode()) % 5]
    assert min(usable.count(0), usable.count(1)) > 3072
    assert len(seen["learnt"]) == toxicity.ROUNDS and len(set(seen["learnt"])) == 1
    assert seen["learnt"][0] + seen["judged"] == len(usable)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95


def test_best_windows_equal_pooling_in_blocks_of_any_size(net, monkeypatch):
    rng = np.random.default_rng(5)
    words = [rng.integers(0, len(net.embeddings), n) for n in (0, 1, 3, 60, 0, 140)]
    firsts = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    want = net.pooled(np.concatenate(words), firsts)
    for block in (1, 7, 64, 1 << 15):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        pooled, won = toxicity._best(net, words)
        assert np.allclose(pooled, want, atol=1e-5) and won.shape == (6, len(net.weights), 3)


def test_labels_too_large_to_broadcast_do_not_shuffle_texts_twice(spark, monkeypatch):
    docs, labels = made_up(200, languages=("en",))
    plans, own = [], toxicity.learning.land

    def spy(table, name):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return own(table, name)

    def no_more(rows):
        return {0: 0, 1: rows.count()}, rows, rows

    monkeypatch.setattr(toxicity.learning, "land", spy)
    monkeypatch.setattr(toxicity.learning, "parts", no_more)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        toxicity.train(frame, spark.createDataFrame(labels, LABELS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0]
