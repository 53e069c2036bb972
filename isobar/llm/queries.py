"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.workspace import shared_folder

from . import bpe, collocations, discriminant, lexical, licences, neardup, packed_ids, packing, pages, rules, substrings, tokens, topk
from .encode import tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), limit=2048)


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"), window=20)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op7_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    documents = table(spark, sf_dir, "documents")
    packed_ids.write_ids(documents, path, tokenizer_file("byte_bpe_50k.json"), vocabulary_size=50_257, end_id=2)
    return packed_ids.checksums(packed_ids.read_ids(spark, path))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_decode(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, most=2000)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_top_k, op3_substring_dedup, op4_quality_rules, op5_licence_scan, op6_near_duplicates,
        op7_packed_ids, op8_best_fit_packing, op9_html_text, op10_byte_bpe, op11_ranked_search, op12_quality_classifier, op13_collocations,
    )
}
