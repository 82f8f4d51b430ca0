"""Queries of this subpackage, and their SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, feature_join, html_text, langid, minhash, mixing, quality, simhash, spotsigs, token_store, toxicity, url_filter
from .common import table


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    return simhash.simhash_near_dups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op1_token_store(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token ids of all documents, written as a keyed binary store and read back by key."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_store.digest(docs, path or public_tokenizers.path("word_bpe_49k.json"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.predict(docs, langid.train(docs)).select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op6_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token ids of all documents and what they decode to."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode(docs, path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of the boosted trees for all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, model).select("doc_id", *quality.BASE, "base_failed", "score", "kept")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or template verdict of all pages' urls."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages", "page_id", "url")).drop("purity", "labels")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of all documents and of their edited texts."""
    return spotsigs.edited_and_next(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all whole embeddings after ten rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usable version of its document's source for every label."""
    return feature_join.label_features(table(spark, sf_dir, "labels", "doc_id"), table(spark, sf_dir, "documents", "doc_id", "source", "n_chars", "lang"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by circulant MinHash."""
    return minhash.near_dups(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name: query."""
    known = [op1_token_store, op2_html_text, op3_toxicity, op4_langid, op5_mixing, op6_bpe, op7_quality, op8_url_filter, op9_spotsigs, op10_simhash, op11_centroids, op12_feature_join, op13_minhash]
    return {f.__name__: f for f in known}


def oracle_sql() -> dict[str, str]:
    """Name: DuckDB SQL of the same rows."""
    return {"op8_url_filter": url_filter.sql(), "op12_feature_join": feature_join.sql()}
