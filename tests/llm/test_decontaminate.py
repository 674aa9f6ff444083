"""Benchmark decontamination against brute force."""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from __spark_entry__ import queries
from tripweave.llm import decontaminate as dc


def words(text):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def weights(ws):
    k, out = min(5, len(ws)), Counter()
    for i in range(len(ws) - k + 1 if ws else 0):
        out[tuple(ws[i : i + k])] += sum(len(w.encode()) for w in ws[i : i + k])
    return out


def brute(docs, items, similarity=0.8):
    """The best similarity of every item and document, by all stretches that share a
    shingle with the item."""
    of_item = {i: (len(words(t)), weights(words(t))) for i, t in items if words(t)}
    index = defaultdict(set)
    for i, (_, shingles) in of_item.items():
        for s in shingles:
            index[s].add(i)
    found = {}
    for doc_id, text in docs:
        ws = words(text)
        for a in range(len(ws)):
            for k in range(1, 6):
                for i in index.get(tuple(ws[a : a + k]), ()):
                    n, shingles = of_item[i]
                    for b in range(max(0, a - n + 1), a + 1):
                        s = dc.weighted_jaccard(weights(ws[b : b + n]), shingles)
                        if s >= similarity and s > found.get((doc_id, i), 0):
                            found[doc_id, i] = s
    return found


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = brute(docs, [(r.item_id, r.text) for r in items])
    rows = queries()["op2_simhash_decontamination"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in rows} == want
    texts = {r.doc_id: r.text for r in docs}
    item = {r.item_id: r.text for r in items}
    for r in rows:
        if r.similarity == 1:
            assert words(texts[r.doc_id][r.start : r.end]) == words(item[r.item_id])


def made(seed, n):
    rng = random.Random(seed)
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(10**6):x}" for _ in range(n)]


def test_near_copies_anywhere_in_a_text(spark, docs_of):
    item = made(1, 60)
    edits = {
        1: item,
        2: item[:-2] + ["changed", "words"],
        3: ["new"] + item[1:],
        4: item[:30] + ["swapped"] + item[31:],
        5: item[:30],
        6: made(2, 60),
    }
    docs = docs_of(*((k, " ".join(made(k + 10, 200) + v + made(k + 20, 100))) for k, v in edits.items()))
    items = spark.createDataFrame([(7, " ".join(item).upper())], "item_id long, text string")
    got = {r.doc_id: r for r in dc.contaminated(docs, items).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].similarity == 1.0


def test_parts_give_what_one_pass_gives(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = dc.contaminated(docs, items).orderBy("doc_id", "item_id").collect()
    many = dc.contaminated(docs, items, part=9).orderBy("doc_id", "item_id").collect()
    assert one == many and one
    plan = dc.contaminated(docs, items, part=9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # documents are read once for all parts


def test_groups_of_batches_keep_every_row():
    batches = [pa.RecordBatch.from_pydict({"t": ["x" * (i % 50)] * i}) for i in (0, 1, 300, 700)]
    for most in (0, 100, 10**9):
        groups = list(dc._groups(iter(batches), most))
        assert sum(b.num_rows for g in groups for b in g) == 1001 and all(groups)
    assert len(groups) == 1


def test_odd_rows(spark, odd_docs, no_docs):
    schema = "item_id long, text string"
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, "one")],
        schema,
    )
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(odd_docs, items).collect()}
    assert got == {(7, 3), (None, 3), (4, 4), (7, 4), (None, 4)}
    assert dc.contaminated(no_docs, items).count() == 0
    assert dc.contaminated(odd_docs, spark.createDataFrame([], schema)).count() == 0


def test_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(3)
    index = dc.build_index([(1, " ".join(made(4, 40)))])
    width, own = next(iter(index.widths.items()))
    for _ in range(300):
        bits = rng.choice(64, rng.integers(0, dc.RADIUS + 1), replace=False)
        flip = np.uint64(sum(1 << int(b) for b in bits))
        windows, entries = index.look_up(width, own["prints"][:1] ^ flip)
        assert 0 in entries[windows == 0]


def test_a_worker_that_moves_between_parts_uses_the_index_of_each():
    class Held:
        def __init__(self, data):
            self.value = pickle.loads(data)

    old, new = (pickle.dumps([(n, " ".join(made(n, 40)))]) for n in (1, 2))
    held = Held(old)
    assert [item.item_id for item in dc._index_of(held).items] == [1]
    address, others = id(held.value), []
    del held
    while len(others) < 2000 and id((other := Held(new)).value) != address:
        others.append(other)
    assert [item.item_id for item in dc._index_of(other).items] == [2]
    assert dc._index_of(other) is dc._index_of(other)


def test_items_that_a_text_cuts_off_are_found():
    rng = random.Random(11)
    for trial in range(60):
        n = rng.choice([23, 47, 60, 90, 1400])
        item = [f"w{trial}x{rng.randrange(10**6):06x}" for _ in range(n)]
        index = dc.build_index([(7, " ".join(item))])
        m = n * 87 // 100 + 1
        foreign = [f"f{trial}x{rng.randrange(10**6):06x}" for _ in range(150)]
        texts = {
            "ends in it": foreign + item[:m],
            "begins in it": item[n - m :] + foreign,
            "its beginning": item[:m],
            "its ending": item[n - m :],
            "its middle": item[(n - m) // 2 : (n - m) // 2 + m],
        }
        column = pa.array([" ".join(t) for t in texts.values()] + [" ".join(foreign)])
        got = {text: score for text, _, score, _, _ in dc.search(index, column, 0.8)}
        assert set(got) == set(range(len(texts))), (trial, n, got)
        assert all(score == pytest.approx((m - 4) / (n - 4), abs=0.06) for score in got.values())


def test_the_reviewed_cases_of_cut_off_items():
    item = [f"w{i:04d}" for i in range(47)]
    index = dc.build_index([(7, " ".join(item))])
    texts = [[f"f{i}" for i in range(99)] + item[:41], item[:40]]
    got = dc.search(index, pa.array([" ".join(t) for t in texts]), 0.8)
    assert [round(score, 2) for _, _, score, _, _ in got] == [0.86, 0.84]


def test_words_without_spaces_weigh_their_bytes(spark, docs_of):
    """A long foreign word in place of an item's own weighs as much as it is long."""
    item = made(21, 12)
    item[5] = "日" * 40
    near = item[:11] + ["other"]
    far = [*item[:5], "月" * 40, *item[6:]]
    docs = docs_of((1, " ".join(item)), (2, " ".join(near)), (3, " ".join(far)))
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.similarity for r in dc.contaminated(docs, items, similarity=0.5).collect()}
    want = {i: dc.weighted_jaccard(weights(t), weights(item)) for i, t in ((2, near[:11]), (3, far))}
    assert got == pytest.approx({1: 1.0, 2: want[2]}) and want[3] < 0.5


def test_equal_items_are_looked_up_once_and_reported_by_every_id(spark, docs_of):
    item = " ".join(made(31, 30))
    rows = [(i, item.upper() if i % 2 else f" {item.replace(' ', '  ')}") for i in range(3000)] + [(None, item)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = dc.contaminated(docs_of((1, f"before {item} after"), (2, "nothing")), items).collect()
    assert sorted((r.item_id for r in got if r.item_id is not None)) == list(range(3000)) and len(got) == 3001
    assert {(r.doc_id, r.similarity, r.start) for r in got} == {(1, 1.0, 7)}
