"""Ranked lexical search of many items at once, with shared partial sums.

Items of a search share terms, so the set of items is planned as a whole.  Term sets that
several items have in common are mined first: of all items and sets found so far, the two with
the largest intersection give a new set, which then stands in both for its terms.  What results
is a graph without cycles whose leaves are terms and whose inner nodes are term sets; each item
is one node.  For a run of documents the score that a term adds to each document is a row of
numbers, and each node of the graph adds up the rows of its children once, however many items
need it.  All numbers are integers, so the order of additions does not matter.

Documents are cut into terms once: blocks of packed postings, of the items' terms only, are
stored, and their sums give the corpus figures.  The scoring pass reads the blocks; a task keeps
the best documents of each item and the tasks' lists are merged in two steps.

The items are the query set.  They go to the workers in batches of about ``BATCH_BYTES`` of text,
one pass over the documents for each batch, so that what a worker gets is bounded.

Null texts have no terms.  Documents are rows: null or repeated ids are ranked row by row, null
ids last among equal scores.  Rows of items with one id (null is one) are one item with the terms
of all its texts; items without terms, or whose terms occur nowhere, have no rows.  Extra columns
are ignored.  Empty documents or items give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.workspace import materialise

from . import text as X
from .runs import runs, separators

#: All ASCII but digits and letters.
SEPARATOR = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
BATCH_BYTES = 1 << 20
#: Items whose shared sets are mined together.
MINED_TOGETHER = 256
#: Numbers that a worker adds up at once.
CELLS = 1 << 22
#: Lists of tasks that the first merging step brings together.
LISTS = 256
POSTINGS = "documents long, terms long, codes array<int>, counts array<long>, payload binary"
FOUND = "item_id long, doc_id long, score long, part int"


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all terms one after another, the distinct terms, and where each text's terms begin and end."""
    data, places = X.flat(texts)
    found = runs(X.lower(data), places, SEPARATOR)
    return found.codes, found.vocabulary, found.bounds


# --- the graph of shared term sets ----------------------------------------------------------


def _mined(sets: list[list[int]], first: int) -> tuple[list[list[int]], list[list[int]]]:
    """The children of each set and of each node found; nodes are numbered from ``first`` on."""
    terms, times = np.unique(np.array([t for s in sets for t in s], np.int64), return_counts=True)
    shared = terms[times > 1]
    column = {t: i for i, t in enumerate(shared.tolist())}
    rows, columns = len(sets), len(shared)
    has = np.zeros((2 * rows + 16, columns + rows + 16), np.float32)
    for i, s in enumerate(sets):
        has[i, [column[t] for t in s if t in column]] = 1
    common = has @ has.T
    np.fill_diagonal(common, 0)
    items = rows
    while True:
        a, b = np.unravel_index(int(common.argmax()), common.shape)
        if common[a, b] < 2:
            break
        both = has[a] * has[b]
        whole = next((r for r in (a, b) if r >= items and both.sum() == has[r].sum()), None)
        if whole is None:
            if rows == has.shape[0]:
                has = np.pad(has, ((0, rows), (0, 0)))
                common = np.pad(common, ((0, rows), (0, rows)))
            if columns + rows - items == has.shape[1]:
                has = np.pad(has, ((0, 0), (0, has.shape[1])))
                both = np.pad(both, (0, has.shape[1] - len(both)))
            whole = rows
            has[whole] = both
            rows += 1
        for r in (a, b):
            if r != whole:
                has[r] -= both
                has[r, columns + whole - items] = 1
        for r in {int(a), int(b), int(whole)}:
            common[r] = common[:, r] = has @ has[r]
            common[r, r] = 0
    names = np.append(shared, first + np.arange(rows - items))
    inner = [names[np.flatnonzero(has[r][: len(names)])].tolist() for r in range(rows)]
    own = [[t for t in s if t not in column] + inner[i] for i, s in enumerate(sets)]
    return own, inner[items:]


def sharing(sets: list[list[int]], n_terms: int) -> tuple[list[tuple[int, np.ndarray]], list[int]]:
    """The nodes (number, children) of the graph, children first, and the node of each set.

    Terms are 0 to ``n_terms`` - 1; a child is a term or a node.
    """
    children: dict[int, list[int]] = {}
    tops: list[int] = []
    number = n_terms
    for at in range(0, len(sets), MINED_TOGETHER):
        own, inner = _mined(sets[at : at + MINED_TOGETHER], number)
        children |= dict(enumerate([*inner, *own], number))
        tops += range(number + len(inner), number + len(inner) + len(own))
        number += len(inner) + len(own)
    order: list[int] = []
    done: set[int] = set()
    waiting = [(top, False) for top in reversed(tops)]
    while waiting:
        node, ready = waiting.pop()
        if ready:
            order.append(node)
        elif node not in done:
            done.add(node)
            waiting.append((node, True))
            waiting += [(c, False) for c in children[node] if c >= n_terms and c not in done]
    return [(n, np.array(children[n], np.int64)) for n in order], tops


# --- postings ---------------------------------------------------------------------------------


def _postings(vocabulary: list[str]):
    """A chunk's documents with the occurrences of the vocabulary's terms, and its sums."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(vocabulary, pa.large_string())
        for chunk in X.chunks(batches, "text"):
            codes, listed, bounds = terms_of(chunk["text"])
            number = pc.fill_null(pc.index_in(listed, value_set=wanted), -1).to_numpy(zero_copy_only=False)
            n = np.diff(bounds)
            codes = number[codes] if len(codes) else codes.astype(np.int64)
            at = np.flatnonzero(codes >= 0)
            document = np.repeat(np.arange(chunk.num_rows), n)[at]
            keys, times = np.unique(document * len(vocabulary) + codes[at], return_counts=True)
            document, codes = np.divmod(keys, max(len(vocabulary), 1))
            used, counts = np.unique(codes, return_counts=True)
            null = chunk["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = chunk["doc_id"].fill_null(0).to_numpy()
            sizes = np.bincount(document, minlength=chunk.num_rows)
            payload = X.pack(ids, null, n, sizes, X.narrow(codes), times)
            yield pa.RecordBatch.from_pylist(
                [{"documents": int((n > 0).sum()), "terms": int(n.sum()), "codes": used, "counts": counts, "payload": payload}],
                schema=pa.schema([
                    ("documents", pa.int64()), ("terms", pa.int64()), ("codes", pa.list_(pa.int32())),
                    ("counts", pa.list_(pa.int64())), ("payload", pa.binary()),
                ]),
            )

    return make


# --- scores -----------------------------------------------------------------------------------


def _lengths(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Each document's length figure m; exact also where the product passes 64 bits."""
    if len(n) and int(n.max()) * documents >= (1 << 63) // 50:
        return np.array([50 + 50 * x * documents // terms for x in n.tolist()], np.int64)
    return 50 + 50 * n * documents // terms


class _Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores by item and document; the least score in a full list is still a candidate, as ids decide ties."""
        item, document = np.nonzero(scores >= self.least[:, None])
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[item, document]])
        self.id = np.concatenate([self.id, ids[document]])
        self.null = np.concatenate([self.null, null[document]])
        order = np.lexsort((self.id, self.null, -self.score, self.item))
        heads = np.searchsorted(self.item[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - heads[self.item[order]]
        order = order[place < self.k]
        self.item, self.score, self.id, self.null = (x[order] for x in (self.item, self.score, self.id, self.null))
        held = np.bincount(self.item, minlength=len(self.least))
        full = held == self.k
        self.least[full] = self.score[np.cumsum(held)[full] - 1]


def _scored(item_ids: list, nodes: list, tops: list[int], weights: np.ndarray, documents: int, terms: int, k: int):
    """The best documents of each item among the blocks of a task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(tops), k)
        n_rows = len(weights) + len(nodes)
        width = max(1, CELLS // max(n_rows, 1))
        for batch in batches:
            for payload in batch["payload"]:
                ids, null, n, sizes, codes, times = X.unpack(payload.as_py())
                null = null.astype(bool)
                m = _lengths(n, documents, terms)
                document = np.repeat(np.arange(len(ids)), sizes)
                adds = weights[codes] * (1_000_000_000 * times // (1000 * times + 20 * m[document]))
                for first in range(0, len(ids), width):
                    last = min(first + width, len(ids))
                    i, j = np.searchsorted(document, [first, last])
                    used, row = np.unique(codes[i:j], return_inverse=True)
                    table = np.zeros((len(used) + len(nodes), last - first), np.int64)
                    table[row, document[i:j] - first] = adds[i:j]
                    place = np.full(n_rows, -1, np.int64)
                    place[used] = np.arange(len(used))
                    free = len(used)
                    for node, children in nodes:
                        rows = place[children]
                        rows = rows[rows >= 0]
                        if len(rows) == 1:
                            place[node] = rows[0]
                        elif len(rows):
                            np.sum(table[rows], axis=0, out=table[free])
                            place[node] = free
                            free += 1
                    at = place[tops]
                    scores = np.where(at[:, None] >= 0, table[at], 0)
                    best.add(scores, ids[first:last], null[first:last])
        names = pa.array(item_ids, pa.int64())
        part = TaskContext.get().partitionId() % LISTS
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(best.item)), pa.array(best.id, pa.int64(), mask=best.null), pa.array(best.score),
             pa.array(np.full(len(best.item), part, np.int32))],
            names=["item_id", "doc_id", "score", "part"],
        )

    return score


def _batch(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The best ``k`` documents of each of some items, whose texts fit the driver."""
    spark = docs.sparkSession
    listed = items.toArrow()
    ids = listed["item_id"].to_pylist()
    codes, vocabulary, bounds = terms_of(listed["text"].combine_chunks())
    sets: dict[int | None, set[int]] = {}
    for i, name in enumerate(ids):
        sets.setdefault(name, set()).update(codes[bounds[i] : bounds[i + 1]].tolist())
    nodes, tops = sharing([sorted(s) for s in sets.values()], len(vocabulary))
    blocks = materialise(docs.mapInArrow(_postings(vocabulary.to_pylist()), POSTINGS))
    totals = blocks.agg(F.sum("documents"), F.sum("terms")).first()
    documents, terms = (int(x or 0) for x in totals)
    if not terms or not len(vocabulary):
        return spark.createDataFrame([], FOUND)
    # at most one row for each term of the batch
    counted = blocks.select(F.inline(F.arrays_zip("codes", "counts"))).groupBy("codes").agg(F.sum("counts").alias("df")).collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for code, df in counted:
        weights[code] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    return blocks.select("payload").mapInArrow(_scored(list(sets), nodes, tops, weights, documents, terms, k), FOUND)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents with a score above 0."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    named = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = named.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    batches = max(1, math.ceil(size / batch_bytes))
    own = F.pmod(F.xxhash64("item_id"), F.lit(batches))
    found = reduce(DataFrame.unionByName, [_batch(texts, named.filter(own == b), k) for b in range(batches)])
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item_id", "part"], ["item_id"]):
        # the limit also cuts what each task sends
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
