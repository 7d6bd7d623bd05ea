"""Registered queries of this subpackage: one ``opN_<name>`` per operator over its
whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabmine.llm import (bpe, decision_list, extract, jaccard, langid, merkle, packing, periodic, quality, resample, topk,
                         toxicity, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; profiles from the documents that name theirs."""
    return langid.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract_pages(_table(spark, sf_dir, "pages"))


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of all documents."""
    return packing.best_fit(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document and of its edited text."""
    return merkle.fingerprints(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best candidates of every query vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, _table(spark, sf_dir, "labels")).drop("text")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by 3-word shingle Jaccard >= 0.9."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels")).drop("text")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of the learned decision list."""
    return decision_list.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document; the target are the benchmark texts."""
    return resample.importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic word runs of every document, as digests."""
    return periodic.run_digests(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_main_text, op3_best_fit, op4_warc, op5_merkle, op6_bpe, op7_top_k, op8_quality, op9_jaccard_join,
    op10_toxicity, op11_quality_rules, op12_resampling, op13_periodic_runs)}
