"""Documents in blocks whose distinct words meet once in buckets.

A block is a run of documents of one task.  It keeps its documents as numbers into its own list
of distinct words, and cuts that list into buckets by a hash of the word.  A bucket gathers the
lists of all blocks, so each distinct word of the corpus is worked on once; the results travel
back to the blocks that asked.  All that moves are packed lists: a word costs one entry for each
block it occurs in, however often, and a hot word is spread over its blocks.

Blocks are written to the shared folder before they are used, as their make-up depends on the
order of rows.  The files are bucketed by block, so joining the answers moves only the answers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.workspace import shared_folder

from . import text as X

BLOCK_BYTES = 16 << 20
#: Bytes of the table for each bucket of words, and what counts as no known size.
BUCKET_BYTES, UNKNOWN_BYTES = 32 << 20, 1 << 60
BLOCK = "block long, doc_ids array<long>, n_bytes array<long>, body binary, buckets array<struct<bucket: int, first: int, words: binary>>"
_PART = pa.struct([("bucket", pa.int32()), ("first", pa.int32()), ("words", pa.binary())])
_BLOCK_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_bytes", pa.list_(pa.int64())),
        ("body", pa.binary()),
        ("buckets", pa.list_(_PART)),
    ]
)


def _make(cut: Callable[[np.ndarray, np.ndarray], X.Words], body: Callable[[X.Words], bytes], buckets: int, block_bytes: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, chunk in enumerate(X.chunks(batches, "text", block_bytes)):
            data, places = X.flat(chunk["text"])
            found = cut(data, places)
            # by bucket, and in a bucket frequent words first, so that numbers stay short
            bucket = (X.hashes(found.vocabulary) % np.uint64(buckets)).astype(np.int64)
            often = np.bincount(found.codes, minlength=len(bucket))
            order = np.lexsort((-often, bucket))
            renumbered = np.empty(len(bucket), np.int64)
            renumbered[order] = np.arange(len(bucket))
            vocabulary = [found.vocabulary[i] for i in order.tolist()]
            used, firsts = np.unique(bucket[order], return_index=True)
            edges = [*firsts.tolist(), len(bucket)]
            parts = [
                {"bucket": b, "first": i, "words": X.pack(*X.joined(vocabulary[i:j]))}
                for b, i, j in zip(used.tolist(), edges[:-1], edges[1:])
            ]
            row = {
                "block": (task << 32) + number,
                "doc_ids": chunk["doc_id"].to_pylist(),
                "n_bytes": np.diff(places).tolist(),
                "body": body(X.Words(renumbered[found.codes], vocabulary, found.bounds)),
                "buckets": parts,
            }
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

    return make


def blocks_of(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    cut: Callable[[np.ndarray, np.ndarray], X.Words],
    body: Callable[[X.Words], bytes],
    block_bytes: int,
    buckets: int | None,
) -> DataFrame:
    """One row per block: its documents, what ``body`` packs of their words, and its words by bucket."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by the size that the plan's statistics give, if they know one
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    buckets = buckets or max(2 * partitions, size // BUCKET_BYTES if size < UNKNOWN_BYTES else 0)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    made = texts.mapInArrow(X.tidy(_make(cut, body, buckets, block_bytes)), BLOCK)
    name = f"blocks_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"
    made.write.bucketBy(partitions, "block").option("path", path).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    return stored


def by_bucket(blocks: DataFrame) -> DataFrame:
    """The words of all blocks, a bucket's rows one after another."""
    return blocks.select("block", F.inline("buckets")).repartition("bucket").sortWithinPartitions("bucket")


def answered(blocks: DataFrame, answers: DataFrame, *columns: str | Column) -> DataFrame:
    """Blocks with the answers (block, first, answer) of their buckets in the order of their words."""
    listed = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("first", "answer"))).alias("answers"))
    return blocks.select("block", *columns).join(listed, "block", "left")
