"""Token ids in files: every id in as few bits as the vocabulary needs.

A store is a Parquet folder; each row is one block of whole documents in ascending order of
doc_id.  ``payload`` holds the block's ids one after another, ``bits`` bits each, lowest bit
first, so id i starts at bit ``i * bits`` and any span can be read without the rest.  ``doc_ids``
and ``sizes`` list the documents of the block; ``first`` is the block's place in its shard, and
shards follow each other in ascending order of doc_id.

A null doc_id comes first; documents that share a doc_id are ordered by a hash of their text.
An id that many rows share, or none at all, takes as many shards as its share of the rows asks
for, each a range of that hash; only rows equal in id and text stay in one.
Null texts are empty and hold the end id only; extra columns are ignored; an empty table gives
a store without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import text as X
from .encode import Encoder

#: Ids after which a block is closed.
BLOCK_IDS = 1 << 16
#: Bytes of text encoded at once.
ENCODED_BYTES = 6 << 20
STORE = "shard int, block int, first long, n_ids long, bits int, payload binary, doc_ids array<long>, sizes array<long>"
_STORE_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("bits", pa.int32()),
        ("payload", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
    ]
)


def width(vocabulary_size: int) -> int:
    """Bits for ids below ``vocabulary_size``."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits], bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` up to ``first + count`` of a block, reading only their bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype("<u4")
    begin, end = first * bits, (first + count) * bits
    some = np.unpackbits(np.frombuffer(payload, np.uint8)[begin // 8 : -(-end // 8)], bitorder="little")
    each = np.zeros((count, 32), np.uint8)
    each[:, :bits] = some[begin % 8 : begin % 8 + count * bits].reshape(count, bits)
    return np.packbits(each, axis=1, bitorder="little").reshape(-1).view("<u4")


def _shards(ids: np.ndarray, null: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, without_id: int) -> np.ndarray:
    """The shard of each document.  The first ``without_id`` are for null ids; the others end at ``bounds``.

    An id that is several bounds has the shards that end there, in ranges of the text's hash.
    """
    first = np.searchsorted(bounds, ids, "left")
    own = np.searchsorted(bounds, ids, "right") - first
    first, own = np.where(null, 0, first + without_id), np.where(null, without_id, own).astype(np.uint64)
    rising = (hashes.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
    return (first + (rising * own >> np.uint64(32)).astype(np.int64)).astype(np.int32)


def _encoded(tokenizer: str, end_id: int, bits: int, bounds: list[int], without_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, edges = Encoder.of(tokenizer, False), np.array(bounds, np.int64)
        for chunk in X.chunks(batches, "text", ENCODED_BYTES):
            ids, ends = encoder.encode(*X.flat(chunk["text"]))
            packed = [pack_ids(np.append(ids[a:b], end_id), bits) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            null = chunk["doc_id"].is_null().to_numpy(zero_copy_only=False)
            numbers, hashes = chunk["doc_id"].fill_null(0).to_numpy(), chunk["text_hash"].to_numpy()
            shards = _shards(numbers, null, hashes, edges, without_id)
            sizes = np.diff(ends) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards), chunk["doc_id"], chunk["text_hash"], pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                names=["shard", "doc_id", "text_hash", "size", "packed"],
            )

    return encode


def _blocks(bits: int, block_ids: int):
    """Blocks of the documents of each shard; rows come sorted by shard and document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first, ids, docs, sizes = None, 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            n = sum(sizes)
            row = {
                "shard": shard, "block": block, "first": first, "n_ids": n, "bits": bits,
                "payload": pack_ids(np.concatenate(ids), bits), "doc_ids": docs, "sizes": sizes,
            }
            return pa.RecordBatch.from_pylist([row], schema=_STORE_ARROW)

        for batch in batches:
            for row in batch.to_pylist():
                if docs and (row["shard"] != shard or sum(sizes) >= block_ids):
                    yield close()
                    first, block, ids, docs, sizes = first + sum(sizes), block + 1, [], [], []
                if row["shard"] != shard:
                    shard, block, first = row["shard"], 0, 0
                ids.append(unpack_ids(row["packed"], bits, 0, row["size"]))
                docs.append(row["doc_id"])
                sizes.append(row["size"])
        if docs:
            yield close()

    return make


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    vocabulary_size: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, append ``end_id`` and write the ids to a store at ``path``.

    Shards are ranges of doc_id, their bounds approximate quantiles of that column alone.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = width(max(vocabulary_size, end_id + 1))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    shares = [i / shards for i in range(1, shards)] or [0.5]
    bounds, rows, with_id = texts.agg(
        F.percentile_approx("doc_id", shares, 20 * shards), F.count("*"), F.count("doc_id")
    ).first()
    bounds = sorted(bounds or []) if shards > 1 else []
    without_id = -(-shards * (rows - with_id) // max(rows, 1))
    (
        texts.withColumn("text_hash", F.xxhash64("text"))
        .mapInArrow(
            X.tidy(_encoded(tokenizer, end_id, bits, bounds, without_id)), "shard int, doc_id long, text_hash long, size long, packed binary"
        )
        .repartitionById(shards + without_id, F.col("shard"))
        .sortWithinPartitions("shard", "doc_id", "text_hash")
        .mapInArrow(X.tidy(_blocks(bits, block_ids)), STORE)
        .write.parquet(path)
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sizes = np.array(row["sizes"], np.int64)
            starts = np.cumsum(sizes) - sizes
            ids = unpack_ids(row["payload"], row["bits"], 0, row["n_ids"])
            texts = [ids[a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["base"] + row["first"], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the store: doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit)."""
    blocks = spark.read.schema(STORE).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    # as many rows as shards, a setting of the writer
    base = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    return blocks.join(F.broadcast(base), "shard").mapInArrow(X.tidy(_documents), "doc_id long, start long, n_tokens long, ids binary")


def checksums(documents: DataFrame) -> DataFrame:
    """Replace the ids of ``read_ids`` by their unsigned crc32."""
    return documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
