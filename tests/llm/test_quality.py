"""Quality classifier: held-out accuracy, edge cases, and the parts of the method."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tripweave.llm import quality
from tripweave.llm.runtime import screened


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_query_learns_the_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries()["op1_nbsvm_quality"](spark, sf_dir).toPandas()
    assert list(got.columns)[:4] == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    known = got.merge(spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas(), on="doc_id")
    held = known[known.held_out]
    assert (held.predicted == held.quality).mean() > 0.9
    assert held[held.quality == 1].predicted.mean() > 0.95


def test_held_out_labels_are_never_learnt(spark, docs_of):
    rows = [(i, ("good words here %d" if i % 2 else "bad!! %%%% %d") % i) for i in range(200)]
    out = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    true = [(i, i % 2, 0) for i, _ in rows]
    wrong = [(i, 1 - q if i in out else q, t) for i, q, t in true]
    a, b = (
        quality.scored(docs_of(*rows), labels_of(spark, labels)).orderBy("doc_id").collect()
        for labels in (true, wrong)
    )
    assert a == b
    assert sum(r.predicted == r.doc_id % 2 for r in a) > 190


def test_odd_rows(spark, odd_docs, no_docs):
    labels = labels_of(spark, [(4, 1, 0), (4, 0, 0), (7, 1, None), (9, None, 0), (5, 7, 0), (None, 1, 0)])
    got = quality.scored(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len({r.score for r in got if not r.text}) == 1 and empty
    assert quality.scored(no_docs, labels).count() == 0
    none = quality.scored(odd_docs, labels_of(spark, [])).collect()
    assert {r.score for r in none} == {0.5}


def test_features_are_distinct_n_grams():
    column = pa.array(["ab ab ab", "ab ab ab ab", "", None, "x"])
    a, b, empty, null, one = quality.Features().of(column)
    assert len(set(a.tolist())) == len(a) and len(empty) == len(null) == 0 and len(one) == 1
    # One more repetition adds no word, pair or string, only a mark of repetition.
    assert len(set(b.tolist()) - set(a.tolist())) <= 1


def test_descent_separates_and_reaches_the_margin():
    rows = [(np.array([0]), np.array([1.0])), (np.array([1]), np.array([1.0]))] * 5
    y = np.array([1.0, -1.0] * 5)
    w, bias = quality.descend(rows, y, cost=10, rounds=200)
    margins = [s * (w[i] @ v + bias) for (i, v), s in zip(rows, y)]
    assert min(margins) > 0.99


def test_one_class_gives_the_prior():
    model = quality.fit([np.array([1, 2]), np.array([3])], np.array([1, 1]))
    assert model.score(np.array([1])) == model.score(np.zeros(0, int)) > 0.7


def test_features_of_a_text_do_not_depend_on_the_rows_around_it():
    texts = ["a b c d", "d d e f g", "", "g", "g h g i", "i g h g i", "i g h g i"]
    together = [sorted(s.tolist()) for s in quality.Features().of(pa.array(texts))]
    alone = [sorted(next(quality.Features().of(pa.array([t]))).tolist()) for t in texts]
    assert together == alone


def test_all_labelled_rows_are_counted_fitted_or_judged_by(spark, docs_of, monkeypatch):
    """More than 4,096 rows, the cut there once was, in several shards."""
    rows = [(i, ("good words here %d" if i % 2 else "bad!! %%%% %d") % i) for i in range(7000)]
    seen = {}

    def spy(module, name):
        own = getattr(module, name)

        def run(table, *args, **more):
            seen[name] = table.count()
            return own(table, *args, **more)

        monkeypatch.setattr(module, name, run)

    spy(quality, "_counts")
    spy(quality.learning, "mixed")
    spy(quality.learning, "folded")
    labels = labels_of(spark, [(i, i % 2, 0) for i, _ in rows])
    got = quality.scored(docs_of(*rows, (3, "a repeated id")), labels, shard_rows=1000).collect()
    usable = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)
    assert usable > 4096 and seen["_counts"] == seen["mixed"]
    assert seen["mixed"] + seen["folded"] == usable
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.99


def test_byte_planes_give_the_numbers_back():
    numbers = np.array([0, 1, -1, 2**40, -(2**40), 7], np.int64)
    assert (quality.learning._numbers(quality.learning._planes(numbers)) == numbers).all()


def test_labels_too_large_to_broadcast_do_not_shuffle_texts_twice(spark, docs_of, monkeypatch):
    """Nor do texts without a label travel, but for a few."""
    rows = [(i, f"text {i}") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 10)], "doc_id long, label int")
    plans, own = [], quality.learning.land

    def spy(table, name):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return own(table, name)

    monkeypatch.setattr(quality.learning, "land", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = docs_of(*rows, (10, "a second text"), (None, "none"))
        got = quality.learning.labelled(docs, labels, 300, F.lit(True), "doc_id", "text", 100, 5).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plans[0]
    want = [(i % 2, "a second text" if i == 10 else f"text {i}") for i in range(0, 3000, 10)]
    assert sorted((r.label, r.text) for r in got) == sorted(want)
    assert len({r.shard for r in got}) == 3 and 50 <= sum(r.held for r in got) <= 70


def test_screened_rows_hold_all_that_are_wanted(spark):
    ids = spark.range(0, 40_000, 4).select(F.col("id").alias("doc_id"))
    rows = spark.range(40_000).select("id", F.when(F.col("id") > 0, F.col("id")).alias("key"))
    got = screened(rows, "key", ids, 10_000).collect()
    assert len(got) == 40_000 and all(r._perhaps for r in got if r.id and r.id % 4 == 0)
    assert sum(r._perhaps for r in got) < 10_000 + 0.1 * 30_000
    assert not any(r._perhaps for r in screened(rows, "key", ids.limit(0), 0).collect())
