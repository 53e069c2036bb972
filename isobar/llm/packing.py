"""Packing token sequences: a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits one sequence.  Only the histogram of piece
lengths reaches the driver, at most ``capacity`` numbers for any corpus.  There the program is
solved by multiplicative weights.  Each round prices all open lengths; one knapsack table by
dynamic programming gives, for every length, the dearest configuration that it is the longest of.
Those whose price comes within ``WITHIN`` of the dearest get a share of what is left, ``SHARE`` of a
length's pieces at most in a round, and lengths covered ahead of the others then become cheaper.
Amounts are rounded down; what rounding leaves, and what no good configuration took, goes best fit,
longest first, by length and not by piece.  Should best fit of all pieces need fewer sequences, its
plan counts.  The plan is a list of configurations with multiplicities; its size depends on
``capacity`` alone.

Pieces learn their sequence from their rank among the pieces of equal length.  Ranks come from
counts per task, so a length that a third of all pieces share is still numbered by all tasks.

Null texts are empty and hold the end id only; rows with null or repeated ids are packed one by
one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.workspace import materialise

from . import text as X
from .encode import Encoder
from .packed_ids import crc32

#: Rounds of the multiplicative weights, and the part of a length's pieces that one round may use.
ROUNDS, SHARE = 80, 0.06
#: How fast the price of a length falls that is covered ahead of the others.
RATE = 0.0005
#: How far below the dearest configuration others of a round may be.
WITHIN = 0.003

Plan = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, times), ..), sequences


def _table(weights: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """taken[i, c]: whether the best choice among the first i + 1 items with room c takes item i."""
    best, trial = np.zeros(capacity + 1), np.empty(capacity + 1)
    taken = np.zeros((len(weights), capacity + 1), bool)
    for i, (weight, value) in enumerate(zip(weights.tolist(), values.tolist())):
        with_it, without = trial[: capacity + 1 - weight], best[weight:]
        np.add(best[: capacity + 1 - weight], value, out=with_it)
        np.greater(with_it, without, out=taken[i, weight:])
        np.maximum(without, with_it, out=without)
    return taken


def configurations(lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> tuple[list[dict[int, int]], np.ndarray]:
    """For each length (ascending) the dearest configuration it is the longest of, as index -> times, and their prices.

    Each length is taken ``most`` times at most.
    """
    n = len(lengths)
    of, times = [], []
    for i, length in enumerate(lengths.tolist()):
        left, step = int(min(most[i], capacity // length)) - 1, 1  # one stands for the longest itself
        while left > 0:
            step = min(step, left)
            of.append(i)
            times.append(step)
            left, step = left - step, step * 2
    # the longest pieces have no second copy: a length needs an item of its own to be a filler
    singles = [i for i in range(n) if most[i] < 2 or 2 * lengths[i] > capacity]
    of, times = np.array(of + singles, np.int64), np.array(times + [1] * len(singles), np.int64)
    order = np.argsort(of, kind="stable")
    of, times = of[order], times[order]
    weights = lengths[of] * times
    taken = _table(weights, prices[of] * times, capacity)
    room = capacity - lengths
    chosen: list[dict[int, int]] = [{i: 1} for i in range(n)]
    total = prices.astype(float).copy()
    for item in range(len(of) - 1, -1, -1):
        first = int(of[item])
        own = first if most[first] > 1 else first + 1  # a single piece cannot be its own filler
        hit = np.flatnonzero(taken[item, room[own:]]) + own
        if len(hit):
            room[hit] -= weights[item]
            total[hit] += prices[first] * times[item]
            for seed in hit.tolist():
                chosen[seed][first] = chosen[seed].get(first, 0) + int(times[item])
    return chosen, total


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Fractional amounts of configurations that together use no length beyond its count."""
    lengths = np.flatnonzero(counts)
    have = counts[lengths].astype(float)
    left, weight, amounts = have.copy(), np.ones(len(lengths)), defaultdict(float)
    for _ in range(rounds):
        open_ = np.flatnonzero(left >= 1)
        if not len(open_):
            break
        own = lengths[open_]
        chosen, total = configurations(own, weight[open_] * own / capacity, np.floor(left[open_]), capacity)
        least = (1 - WITHIN) * total.max()
        budget = np.minimum(np.maximum(SHARE * have[open_], 1), left[open_]).tolist()
        before = np.array(budget)
        for seed in range(len(own) - 1, -1, -1):  # the longest pieces choose first
            if total[seed] < least:
                continue
            step = min(budget[i] / times for i, times in chosen[seed].items())
            if step > 0:
                for i, times in chosen[seed].items():
                    budget[i] -= step * times
                amounts[tuple((int(own[i]), times) for i, times in sorted(chosen[seed].items()))] += step
        left[open_] = np.maximum(left[open_] - before + np.array(budget), 0)
        covered = 1 - left / have
        weight *= np.exp(-RATE * (covered - covered.mean()))
    return amounts


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best fit, longest first, with equal sequences handled as one."""
    open_: dict[int, Counter] = defaultdict(Counter)  # room left: contents and how many such
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = capacity // length
                if n >= each:
                    open_[capacity - each * length][((length, each),)] += n // each
                    n %= each
                else:
                    open_[capacity - n * length][((length, n),)] += 1
                    n = 0
                continue
            content, many = next(iter(open_[room].items()))
            each = min(room // length, n)
            used = min(many, n // each)
            open_[room][content] -= used
            if not open_[room][content]:
                del open_[room][content]
            if not open_[room]:
                del open_[room]
            open_[room - each * length][(*content, (length, each))] += used
            n -= used * each
    return [(content, many) for kinds in open_.values() for content, many in kinds.items()]


def plan(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> Plan:
    """Configurations and numbers of sequences that hold each length exactly ``counts`` times."""
    counts = counts.astype(np.int64)
    left, out = counts.copy(), []
    for config, amount in solve(counts, capacity, rounds).items():
        many = min([int(amount + 1e-9), *(int(left[length]) // times for length, times in config)])
        if many:
            out.append((config, many))
            for length, times in config:
                left[length] -= many * times
    out += best_fit(left, capacity)
    return min(out, best_fit(counts, capacity), key=lambda found: sum(many for _, many in found))


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.of(tokenizer, True), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for chunk in X.chunks(batches, "text"):
            ids, ends = encoder.encode(*X.flat(chunk["text"]))
            totals = np.diff(ends) + 1
            parts = -(-totals // capacity)
            row = np.repeat(np.arange(len(totals)), parts)
            piece = X.spread(parts)
            start = piece * capacity
            length = np.minimum(totals[row] - start, capacity)
            sums = []
            for r, s, n in zip(row.tolist(), start.tolist(), length.tolist()):
                own = ids[ends[r] + s : min(ends[r] + s + n, ends[r + 1])]
                sums.append(crc32(np.append(own, end_id) if len(own) < n else own))
            # number equal lengths on from what this task has seen
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            firsts = np.searchsorted(sorted_, sorted_, "left")
            number = np.empty(len(length), np.int64)
            number[order] = seen[sorted_] + np.arange(len(length)) - firsts
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [chunk["doc_id"].take(pa.array(row)), *(pa.array(a, pa.int64()) for a in (piece, start, length)),
                 pa.array(sums, pa.int64()), pa.array(np.full(len(row), task), pa.int64()), pa.array(number, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"],
            )

    return make


def _places(packed: Plan, capacity: int):
    """Look the sequence and offset of a piece up by its length and rank."""
    entries: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    used, first_sequence = np.zeros(capacity + 1, np.int64), 0
    for config, many in packed:
        offset = 0
        for length, times in config:
            entries[length].append((int(used[length]), times, first_sequence, offset, length))
            used[length] += times * many
            offset += length * times
        first_sequence += many
    heads = sorted(entries)
    table = np.array([e for length in heads for e in entries[length]], np.int64).reshape(-1, 5)
    # one ascending key over all lengths: pieces of shorter lengths come first
    before = np.zeros(capacity + 2, np.int64)
    before[1:] = np.cumsum(used)
    keys = table[:, 0] + before[table[:, 4]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            first, times, sequence, offset, _ = table[np.searchsorted(keys, before[length] + number, "right") - 1].T
            columns = {c: batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            columns["sequence_id"] = pa.array(sequence + (number - first) // times)
            columns["offset"] = pa.array(offset + (number - first) % times * length)
            yield pa.RecordBatch.from_pydict(columns)

    return place


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset in that sequence.

    Documents are encoded by a file of the tokenizers library whose normalizer drops white
    space, and get ``end_id`` at the end.  Longer ones are cut every ``capacity`` ids.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = materialise(
        texts.mapInArrow(
            X.tidy(_pieces(tokenizer, end_id, capacity)),
            "doc_id long, piece long, start long, length long, ids_crc32 long, task long, number long",
        )
    )
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        histogram[length] = n
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.groupBy("length", "task").count().select(
        "length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    numbered = pieces.join(bases, ["length", "task"]).withColumn("number", F.col("number") + F.col("base"))
    return numbered.mapInArrow(
        X.tidy(_places(plan(histogram, capacity, rounds), capacity)),
        "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
