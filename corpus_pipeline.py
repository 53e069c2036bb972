"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, written as
Parquet and read again.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import neardup, packing, rules, substrings
from isobar.llm.encode import tokenizer_file
from isobar.workspace import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and every rule; null texts go.

    The verdict is a filter on each row, so repeated rows share one and rows need no ids.
    """
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("text"))
    verdict = rules.judged(whole, id_column="doc")
    # a filter would be pushed below the counts and repeat them in every rule
    kept = verdict.select(F.explode(F.when(F.col("kept"), F.array("doc_id"))).alias("doc"))
    return kept.select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    The row with the group's least id stays, rows without ids last; of several such rows the one
    with the least hash of its text, and of rows equal in id and text one.  Null texts and texts
    without words are like no other: one row of each id and text stays.  Further columns pass,
    whatever their names; an empty table gives no rows.
    """
    kept = neardup.representatives(docs, size=5, percent=80)
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & F.xxhash64("d.text").eqNullSafe(F.col("k.text_hash"))
    return docs.alias("d").join(kept.alias("k"), same, "left_semi").dropDuplicates(["doc_id", "text"])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of 20 words; no row is dropped, n_chars follows the text.

    Of rows with one id and text none counts as a repeat of the other.  Null texts stay null; further
    columns pass; an empty table gives no rows.
    """
    shorter = substrings.without_repeats(docs, window=20)
    return shorter.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else shorter


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences.

    Null texts are empty and hold the end id only; rows with null or repeated ids are packed one by
    one; further columns are left out; an empty table gives no rows.
    """
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("substring removal", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: SQL has no tokenizer, so the rows of run() have no SQL answer; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
