"""Token counts without ids: pieces per distinct pre-token, joined to each document's frequencies.

The pre-tokens are the words between white space, which the tokenizer drops before anything
else.  A block of documents holds the frequencies of each document; its distinct pre-tokens meet
those of the other blocks in buckets, where each is counted once, and the counts are joined to
the frequencies and summed.

Null texts count as empty; rows with null or repeated ids are counted one by one; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import text as X
from .encode import Encoder

_ANSWER = pa.schema([("block", pa.int64()), ("first", pa.int32()), ("answer", pa.binary())])


def _frequencies(found: X.Words) -> bytes:
    """Ends of the documents, gaps between their word numbers in ascending order, and times."""
    size, n = max(len(found.vocabulary), 1), len(found.bounds) - 1
    document = np.repeat(np.arange(n), np.diff(found.bounds))
    keys, times = np.unique(document * size + found.codes, return_counts=True)
    ends = np.searchsorted(keys, np.arange(1, n + 1) * size)
    numbers = keys % size
    gaps = np.diff(numbers, prepend=0)
    heads = np.concatenate([[0], ends[:-1]])
    heads = heads[heads < ends]
    gaps[heads] = numbers[heads]  # each document begins anew
    return X.pack(ends, X.narrow(gaps), X.narrow(times))


def _counted(tokenizer: str):
    """Count the pieces of each distinct word of a bucket once; rows come sorted by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bucket, known = Encoder.of(tokenizer, True), None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                listed = X.parted(*X.unpack(row["words"]))
                new = [w for w in listed if w not in known]
                known.update(zip(new, encoder.counts([w.decode() for w in new]).tolist()))
                counts = np.fromiter(map(known.__getitem__, listed), np.int64, len(listed))
                out.append({"block": row["block"], "first": row["first"], "answer": X.pack(X.narrow(counts))})
            yield pa.RecordBatch.from_pylist(out, schema=_ANSWER)

    return count


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            answers = [X.unpack(x["answer"])[0].astype(np.int64) for x in row["answers"].to_pylist()[0] or []]
            counts = np.concatenate([np.zeros(0, np.int64), *answers])
            ends, gaps, times = X.unpack(row["body"].to_pylist()[0])
            begins = np.concatenate([[0], ends[:-1]])
            sums = np.concatenate([[0], np.cumsum(gaps.astype(np.int64))])
            numbers = sums[1:] - np.repeat(sums[begins], ends - begins)
            total = np.concatenate([[0], np.cumsum(counts[numbers] * times)])
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].flatten(), row["n_bytes"].flatten(), pa.array(total[ends] - total[begins], pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = B.BLOCK_BYTES,
    buckets: int | None = None,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and whether it has more tokens than ``limit``.

    ``tokenizer`` is a file of the tokenizers library whose normalizer drops white space.
    """
    blocks = B.blocks_of(docs, id_column, text_column, X.words, _frequencies, block_bytes, buckets)
    counts = B.by_bucket(blocks).mapInArrow(_counted(tokenizer), "block long, first int, answer binary")
    sums = B.answered(blocks, counts, "doc_ids", "n_bytes", "body").mapInArrow(
        _summed, "doc_id long, n_bytes long, n_tokens long"
    )
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
