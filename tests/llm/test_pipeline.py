"""The corpus pipeline, stage by stage, and its registration."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests_llm_paths import TOKENIZER
from tripweave.llm import catalog, runtime

SF_DIR = "/root/testdata/sf0.01"


def test_every_operator_is_registered_once():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(catalog.ORACLE) <= set(oracle_sql())


def test_stages_take_effect_and_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
    assert seen[0] > seen[1] > seen[2] > seen[3] == seen[4] == seen[5]
    texts = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert not any(re.search("[0-9a-f]{32}", r.text or "") for r in texts.values())
    assert any("[secret]" in r.text and r.n_chars == len(r.text) for r in texts.values())
    library = Tokenizer.from_file(TOKENIZER)
    for r in docs.collect():
        ids = library.encode(texts[r.doc_id].text or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_odd_rows_pass_every_stage(spark, tmp_path):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    whole = " ".join(f"Word{i} of the text." if i % 5 else f"It is number {i}," for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, whole, "en", "s", len(whole)),
            (3, whole, "en", "s", len(whole)), (4, whole + " End.", "en", "s", None), (None, whole, "en", "s", 5)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        ids = [r.doc_id for r in docs.collect()]
        assert 4 not in ids and len(ids) <= len(given)


def test_documents_without_copies_are_not_shuffled_to_drop_copies(spark, tmp_path, monkeypatch):
    """However many copies there are: only rows that may be one are joined."""
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    rows = [(i, f"the same words for every fifth {i % 5 or i}, and so on", "en", "s", 1) for i in range(1, 400)]
    rows += [(1000 + i, " ".join(f"w{i}x{j}" for j in range(30)), "en", "s", 1) for i in range(400)]
    rows += [(None, "no id", "en", "s", 1)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    joined = []
    own = corpus_pipeline.without

    def spy(table, key, ids, count):
        marked = runtime.screened(table, key, ids, count)
        joined.append((marked.filter("_perhaps").count(), ids.count(), count))
        return own(table, key, ids, count)

    monkeypatch.setattr(corpus_pipeline, "without", spy)
    kept = [r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF_DIR).collect()]
    met, copies, count = joined[0]
    assert copies == count == 800 - len(kept) and copies <= met < copies + 60
    assert set(kept) >= {None, *range(1000, 1400), 1, 2, 3, 4, 5} and 6 not in kept
