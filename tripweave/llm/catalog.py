"""The queries of this package by name, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripweave.llm import (
    alignment,
    bpe,
    codebooks,
    decontaminate,
    maxscore,
    oracle,
    quality,
    secrets,
    sharding,
    spans,
    toxicity,
    warc,
    wavelet,
)
from tripweave.llm.jaccard_join import jaccard_components
from tripweave.llm.runtime import land
from tripweave.sources.writers import shared_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
PAIR = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.scored(docs.select("doc_id", "text"), labels).drop("text")


def op2_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items, similarity=0.8)


def op3_cnn_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings(_table(spark, sf_dir, "documents"))
    each = F.filter(F.split("spans", ","), lambda s: s != "")
    base = F.filter(each, lambda s: ~s.startswith("found:"))

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s.startswith(f"{kind}:"))).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        "spans",
    )


def op4_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), k=3, percent=90)


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = _table(spark, sf_dir, "documents")
    wavelet.write_shards(docs, folder, public_tokenizers.path(TOKENIZER), END_ID)
    return wavelet.read_shards(spark, folder)


def op7_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=16)


def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    files = warc.write_monolithic(_table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return warc.read_files(spark, warc.normalise_files(files, folder), folder)


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose repeated passages: the ranges, where they stand first, and a
    digest of what is left."""
    docs = _table(spark, sf_dir, "documents")
    left = spans.cut(docs.select("doc_id", "text"), spans.repeated_spans(docs))
    span = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return left.select(
        "doc_id",
        F.size("spans").alias("n_spans"),
        F.array_join(span, ",").alias("spans"),
        "first_doc_ids",
        F.length("text").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op11_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.scored(docs.select("doc_id", "text"), labels).drop("text")


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.scored(alignment.summaries(docs, *map(public_tokenizers.path, PAIR)))


def op13_value_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codebooks.compressed(_table(spark, sf_dir, "embeddings"))
    whole = codebooks.label_errors(land(coded, "codes")).drop("label")
    sha = F.lit(None if books is None else codebooks.digest(books)).cast("string")
    return whole.withColumn("codebooks_sha256", sha)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nbsvm_quality": op1_nbsvm_quality,
    "op2_simhash_decontamination": op2_simhash_decontamination,
    "op3_cnn_secrets": op3_cnn_secrets,
    "op4_maxscore_topk": op4_maxscore_topk,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_wavelet_shards": op6_wavelet_shards,
    "op7_lpt_sharding": op7_lpt_sharding,
    "op8_warc_normaliser": op8_warc_normaliser,
    "op9_bpe_tree": op9_bpe_tree,
    "op10_sentence_spans": op10_sentence_spans,
    "op11_cnn_toxicity": op11_cnn_toxicity,
    "op12_lockstep_alignment": op12_lockstep_alignment,
    "op13_value_dictionaries": op13_value_dictionaries,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = dict(oracle.ORACLE)
