"""Exact top-k search by inner product: matrix tiles, partial selection, merging in a tree.

Vectors are quantised to integers and packed into shards, matrices of some thousand rows, in the
shared folder.  Queries are packed the same way.  A tile is a block of queries against a shard:
one matrix product, whose k best scores of each query are selected without sorting the rest.
The top lists of a query then meet level by level, ``FAN`` lists at a time.

Query blocks are dealt to groups of shards: a block is copied once per group, not once per
shard, and there are as many groups as the session has shuffle partitions.  Products are exact:
in floating point while sums stay below 2**53, else in Python integers.

Vectors that are null or hold a null or non-finite component take no part.  Vectors meet those
of their own length only.  A row is never its own candidate; other rows that repeat its id are.
A vector of no components scores 0.  Scores beyond 64 bits are clipped.  Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.workspace import materialise

SHARD_ROWS, BLOCK_QUERIES, FAN = 8192, 1024, 8
SHARD = "shard long, dim int, wide boolean, ids binary, matrix binary"
_SHARD_ARROW = pa.schema(
    [("shard", pa.int64()), ("dim", pa.int32()), ("wide", pa.bool_()), ("ids", pa.binary()), ("matrix", pa.binary())]
)
LARGEST = 2**53


def _shards(scale: int, rows: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, waiting = TaskContext.get().partitionId(), 0, {}

        def shard(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, values = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            matrix = np.floor(scale * values)
            most = float(np.abs(matrix).max()) if matrix.size else 0.0
            wide = most * most * max(dim, 1) >= LARGEST
            kind = "<f8" if wide else "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
            packed = {
                "shard": (task << 32) + made, "dim": dim, "wide": wide,
                "ids": ids.astype("<i8").tobytes(), "matrix": kind.encode() + matrix.astype(kind).tobytes(),
            }
            made += 1
            return pa.RecordBatch.from_pylist([packed], schema=_SHARD_ARROW)

        for batch in batches:
            usable = pc.and_(batch["vec_id"].is_valid(), batch["vector"].is_valid())
            batch = batch.filter(usable)
            vectors = batch["vector"]
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten()
            bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False).astype(float)) | flat.is_null().to_numpy(zero_copy_only=False)
            values = np.where(bad, 0.0, flat.fill_null(0).to_numpy(zero_copy_only=False).astype(float))
            ends = np.cumsum(lengths)
            broken = np.concatenate([[0], np.cumsum(bad)])
            fit = broken[ends] == broken[ends - lengths]
            ids = batch["vec_id"].to_numpy()
            for dim in np.unique(lengths[fit]).tolist():
                own = np.flatnonzero(fit & (lengths == dim))
                if dim:
                    matrix = values[((ends - lengths)[own][:, None] + np.arange(dim)).reshape(-1)].reshape(len(own), dim)
                else:
                    matrix = np.zeros((len(own), 0))
                for i in range(0, len(own), rows):
                    waiting.setdefault(dim, []).append((ids[own[i : i + rows]], matrix[i : i + rows]))
                    if sum(len(x) for x, _ in waiting[dim]) >= rows:
                        yield shard(dim)
        for dim in list(waiting):
            yield shard(dim)

    return make


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["matrix"], row["matrix"][:3].decode(), offset=3).reshape(len(ids), row["dim"])


def _query_blocks(every: int, size: int):
    """The rows whose id is divisible by ``every``, with the shard and row they come from."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, matrix = _read(row)
                own = np.flatnonzero(ids % every == 0)
                for i in range(0, len(own), size):
                    some = own[i : i + size]
                    out.append(
                        {
                            "q_shard": row["shard"], "dim": row["dim"], "q_wide": row["wide"], "q_rows": some.astype("<i8").tobytes(),
                            "q_ids": ids[some].tobytes(), "q_matrix": row["matrix"][:3] + matrix[some].tobytes(),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=_QUERY_ARROW)

    return make


_QUERY_ARROW = pa.schema(
    [("q_shard", pa.int64()), ("dim", pa.int32()), ("q_wide", pa.bool_()), ("q_rows", pa.binary()), ("q_ids", pa.binary()), ("q_matrix", pa.binary())]
)
QUERY = "q_shard long, dim int, q_wide boolean, q_rows binary, q_ids binary, q_matrix binary"
LIST = "q_shard long, q_row long, query_id long, node long, best array<struct<vec_id: long, score: long>>"
_BEST = pa.struct([("vec_id", pa.int64()), ("score", pa.int64())])


def _product(queries: np.ndarray, shard: np.ndarray, wide: bool) -> np.ndarray:
    if not wide:
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * max(shard.shape[1], 1)
        wide = most >= LARGEST
    if not wide:
        return (queries.astype(float) @ shard.astype(float).T).astype(np.int64)
    exact = np.array(queries.tolist(), object).astype(float)
    integers = [np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape) for m in (exact, shard)]
    scores = integers[0] @ integers[1].T if shard.shape[1] else np.zeros((len(queries), len(shard)), object)
    return np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)


def _tiles(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in batch.schema.names}
                ids, shard = _read(row)
                q_ids, q_rows = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_rows"], "<i8")
                _, queries = _read({"ids": row["q_ids"], "matrix": row["q_matrix"], "dim": row["dim"]})
                scores = _product(queries, shard, row["wide"] or row["q_wide"])
                allowed = np.ones(scores.shape, bool)
                if row["q_shard"] == row["shard"]:
                    allowed[np.arange(len(q_rows)), q_rows] = False
                size = min(k + 1, len(ids))  # one more, as a row itself may be among its best
                least = np.partition(scores, len(ids) - size, axis=1)[:, len(ids) - size]
                at, candidate = np.nonzero((scores >= least[:, None]) & allowed)
                found, found_ids = scores[at, candidate], ids[candidate]
                order = np.lexsort((found_ids, -found.astype(object) if found.min(initial=0) == -(2**63) else -found, at))
                at, found, found_ids = at[order], found[order], found_ids[order]
                best = np.arange(len(at)) - np.searchsorted(at, at, "left") < k
                at, found, found_ids = at[best], found[best], found_ids[best]
                ends = np.searchsorted(at, np.arange(len(q_ids) + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(found_ids), pa.array(found)], fields=list(_BEST))
                )
                n = len(q_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["q_shard"])), pa.array(q_rows), pa.array(q_ids), pa.array(np.full(n, row["node"])), lists],
                    names=["q_shard", "q_row", "query_id", "node", "best"],
                )

    return score


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    groups: int | None = None,
) -> DataFrame:
    """For each row with an id divisible by ``every``: its ``k`` best other rows.

    Columns query_id, rank (from 1), vec_id, score; components are floor(scale * x); ties go to
    the smaller id.
    """
    groups = groups or int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    shards = materialise(rows.mapInArrow(_shards(scale, shard_rows), SHARD))
    dealt = shards.withColumn("node", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    queries = shards.mapInArrow(_query_blocks(every, block_queries), QUERY)
    copies = queries.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    lists = dealt.join(copies, ["node", "dim"]).mapInArrow(_tiles(k), LIST)
    order = "(a, b) -> case when a.score > b.score then -1 when a.score < b.score then 1 when a.vec_id < b.vec_id then -1 when a.vec_id > b.vec_id then 1 else 0 end"
    nodes = groups
    while True:
        lists = (
            lists.groupBy("q_shard", "q_row", "query_id", F.floor(F.col("node") / FAN).alias("node"))
            .agg(F.flatten(F.collect_list("best")).alias("all"))
            .select("q_shard", "q_row", "query_id", "node", F.slice(F.expr(f"array_sort(all, {order})"), 1, k).alias("best"))
        )
        nodes = -(-nodes // FAN)
        if nodes == 1:
            break
    found = lists.select("query_id", F.posexplode("best").alias("place", "hit"))
    return found.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
