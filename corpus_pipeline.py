"""A corpus pipeline: every stage takes the documents its predecessor kept.

Rejected by quality, near copies, contaminated by a benchmark: such documents go.
Secrets are cut out of the texts that hold them. The last stage encodes what is left.
Each stage works on whole texts and keeps the columns of ``documents``.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import bpe, decontaminate, quality, secrets
from tripweave.llm.jaccard_join import jaccard_components
from tripweave.llm.runtime import land, let_go, without

TOKENIZER = "word_bpe_49k.json"
MASK = "[secret]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.7 stay."""
    scored = quality.scored(docs, _table(spark, sf_dir, "labels"), threshold=0.7)
    return scored.filter("predicted = 1").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the document with the
    smallest id stays; documents without an id stay too."""
    groups = jaccard_components(docs, k=5, percent=80)
    gone = land(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "copies")
    let_go(spark)
    return without(docs, "doc_id", gone, gone.count())


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    hits = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"), similarity=0.8)
    gone = land(hits.select("doc_id").distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.masked(docs, mask=MASK).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's ids, and digest of the decoded text."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("BPE encoding and decoding", bpe_encoding),
]

#: SQL can express neither the classifier nor the network nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what passes between two stages is a written table."""
    docs = _table(spark, sf_dir, "documents")
    steps = [lambda d, f=f: land(f(spark, d, sf_dir), "stage") for _, f in STAGES[:-1]]
    return STAGES[-1][1](spark, reduce(lambda d, step: step(d), steps, docs), sf_dir)
