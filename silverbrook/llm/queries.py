"""Queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverbrook.llm import divergence, fingerprints, jaccard_join, language_id, mixing, motion_jpeg, oracles, packing, page_text, quotations, substring_dedup, token_counts, vector_codes, vector_search
from silverbrook.llm.storage import let_workers_import

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where this machine has a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(_documents(spark, sf_dir))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(_table(spark, sf_dir, "pages"))


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_conversations(_table(spark, sf_dir, "conversations"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_documents(spark, sf_dir), n=4, percent=85)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_pages(_table(spark, sf_dir, "pages"), language_id.document_model(_documents(spark, sf_dir)))


def op6_motion_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motion_jpeg.media_digests(_documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_documents(spark, sf_dir), window=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path())


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


_ALL = (
    op1_document_fingerprints,
    op2_html_extraction,
    op3_quotation_linking,
    op4_ngram_jaccard_join,
    op5_language_id,
    op6_motion_jpeg,
    op7_token_counts,
    op8_substring_dedup,
    op9_mix_sources,
    op10_pack_sequences,
    op11_nearest_neighbours,
    op12_vector_codes,
    op13_source_divergence,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
