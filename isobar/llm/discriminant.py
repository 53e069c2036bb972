"""Quality scores of documents by a regularised quadratic discriminant.

Each whole text gives a row of statistics: shares of kinds of characters, words, repeats and
lines, transformed so that they spread evenly.  Two normal densities, one for each label, are
fitted to the statistics of the labelled documents; each class covariance is shrunk towards the
common one and that towards its diagonal.  A score is the logistic of the difference of the two
log densities (Mahalanobis distances through Cholesky factors, which a worker computes once) plus
that of the class shares.  Only the text speaks: labels, languages, sources and ids are no
statistics.

The fit uses all labelled documents outside the held-out fold.  Statistics are whole multiples of
1 / ``GRID``, so that counts, sums and products of a class add up exactly, in any order and
however the rows are split; only these few sums reach the driver.

Null and empty texts have statistics as any other and get a score.  A document with null id has
no label and is not held out.  Rows with one id share its label; an id with contradictory labels,
or labels other than 0 and 1, teaches nothing.  If a class has no labelled documents every score
is the smoothed share of label 1.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.workspace import materialise

from . import text as X
from .rules import STOP_WORDS
from .runs import runs, separators

GRID = 1 << 12
#: Weight of the common covariance in a class's, and of the diagonal in both.
TOWARDS_COMMON, TOWARDS_DIAGONAL = 0.15, 0.02
#: Spread that every statistic has besides, so that one that never varies divides by no zero.
LEAST_SPREAD = 0.01
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

UPPER = separators((ord("A"), ord("Z")))
LOWER = separators((ord("a"), ord("z")))
DIGIT = separators((ord("0"), ord("9")))
SPACE = separators((0x20, 0x20), (0x09, 0x0D))
STOP = separators(*((ord(c), ord(c)) for c in ".,;:?"))
WIDE = separators((0x80, 0xFF))
MARK = ~(UPPER | LOWER | WIDE | DIGIT | SPACE | STOP)
TRIMMED = ".,;:?!"
STOPPED = sorted({w for line in STOP_WORDS for w in line.split()})
NAMES = (
    "length", "word length", "word spread", "upper case", "marks", "marked words", "digits", "stops", "stop words", "variety",
    "same neighbour", "repeated triples", "repeated lines", "words a line", "wide bytes",
)


def _sums(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many of ``flags`` lie between neighbouring places."""
    out = np.zeros(len(places) - 1, np.int64)
    filled = np.flatnonzero(places[1:] > places[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(flags, places[filled], dtype=np.int64)
    return out


def _distinct(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """How many different keys each text has; owner and the upper bits of a mixed key are sorted as one number."""
    bits = np.uint64(max(1, texts).bit_length())
    mixed = (keys.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    both = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (mixed >> bits))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return np.bincount((both[new] >> (np.uint64(64) - bits)).astype(np.int64), minlength=texts)


def _lines(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a visible character of each text, and how many of them repeat another."""
    n = len(places) - 1
    starts = np.unique(np.concatenate([places[:-1], np.flatnonzero(data == 0x0A) + 1]))
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    owner = np.searchsorted(places, starts, "right") - 1
    seen = _sums(~SPACE[data], np.append(starts, len(data))) > 0
    codes, _ = X.distinct(data, starts, len(data))
    lines = np.bincount(owner[seen], minlength=n)
    return lines, lines - _distinct(codes[seen], owner[seen], n)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text, in units of 1 / ``GRID``."""
    data, places = X.flat(texts)
    data, n = np.ascontiguousarray(data), len(texts)
    found = runs(data, places, SPACE)
    words, codes = np.diff(found.bounds), found.codes
    document = np.repeat(np.arange(n), words)
    # of each distinct word
    whole, ends = X.flat(found.vocabulary)
    characters = _sums((whole & 0xC0) != 0x80, ends)
    marked = _sums(MARK[whole], ends) > 0
    bare = pc.utf8_lower(pc.ascii_trim(found.vocabulary, characters=TRIMMED))
    stop = pc.is_in(bare, value_set=pa.array(STOPPED, pa.large_string())).to_numpy(zero_copy_only=False)

    def share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
        return count / np.maximum(of, 1)

    def of_words(values: np.ndarray) -> np.ndarray:
        return _sums(values[codes], found.bounds)

    def of_bytes(table: np.ndarray) -> np.ndarray:
        return _sums(table[data], places)

    visible, letters = of_bytes(~SPACE), of_bytes(UPPER | LOWER)
    length = share(of_words(characters), words)
    spread = np.sqrt(np.maximum(share(of_words(characters**2), words) - length**2, 0))
    same = np.flatnonzero((document[1:] == document[:-1]) & (codes[1:] == codes[:-1]))
    third = np.flatnonzero(document[2:] == document[:-2])
    wide = codes.astype(np.uint64)
    triples = (wide[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + wide[1:-1]) * np.uint64(0x165667B19E3779F9) + wide[2:]
    n_triples = np.bincount(document[third], minlength=n)
    lines, repeated_lines = _lines(data, places)
    columns = [
        np.log1p(words),
        np.log1p(length),
        np.log1p(spread),
        np.sqrt(share(of_bytes(UPPER), letters)),
        np.sqrt(share(of_bytes(MARK), visible)),
        np.sqrt(share(of_words(marked), words)),
        np.sqrt(share(of_bytes(DIGIT), visible)),
        np.sqrt(share(of_bytes(STOP), visible)),
        np.sqrt(share(of_words(stop), words)),
        np.sqrt(share(_distinct(codes, document, n), words)),
        np.sqrt(share(np.bincount(document[same], minlength=n), words)),
        np.sqrt(share(n_triples - _distinct(triples[third], document[third], n), words)),
        np.sqrt(share(repeated_lines, lines)),
        np.log1p(share(words, lines)),
        np.sqrt(share(of_bytes(WIDE), visible)),
    ]
    return np.rint(np.stack(columns, axis=1) * GRID).astype(np.int64)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in X.chunks(batches, "text"):
        values = statistics(chunk["text"])
        listed = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel().astype(np.int32)), len(NAMES)).cast(pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([chunk["doc_id"], listed], names=["doc_id", "statistics"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, len(NAMES))


# --- the fit ----------------------------------------------------------------------------------


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sums and products of the statistics of each label; place 0 stands for the number 1."""
    total = {0: 0, 1: 0}
    for batch in batches:
        rows, labels = _matrix(batch["statistics"]), batch["label"].to_numpy(zero_copy_only=False)
        rows = np.concatenate([np.ones((len(rows), 1), np.int64), rows], axis=1)
        for label in total:
            own = rows[labels == label]
            total[label] = total[label] + (own.T @ own).astype(object)  # Python integers, without bounds
    out = [(label, i, j, t[i, j]) for label, t in total.items() if np.ndim(t) for i in range(len(t)) for j in range(i + 1)]
    label, i, j, value = zip(*out) if out else ([],) * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(label, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(v) for v in value], pa.decimal128(38, 0))],
        names=["label", "i", "j", "value"],
    )


class Density(NamedTuple):
    """A normal density: its mean, the inverse of its covariance's Cholesky factor, and its logarithm at the mean plus the class share's."""

    mean: np.ndarray
    inverse: np.ndarray
    top: float


class Model(NamedTuple):
    """The densities of labels 0 and 1 (none if a class has no rows), and the smoothed share of label 1."""

    densities: tuple[Density, ...]
    share: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.densities:
            return np.full(len(rows), self.share)
        logs = []
        for d in self.densities:
            z = (rows / GRID - d.mean) @ d.inverse.T
            logs.append(d.top - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fitted(sums: dict[int, np.ndarray]) -> Model:
    """The model of exact sums by label (see ``_summed``), as symmetric matrices of Python integers."""
    counts = {c: int(sums[c][0, 0]) if c in sums else 0 for c in (0, 1)}
    everything = sum(counts.values())
    share = (counts[1] + 1) / (everything + 2)
    if not all(counts.values()):
        return Model((), share)
    means, spreads = {}, {}
    for c, n in counts.items():
        first, products = sums[c][0, 1:], sums[c][1:, 1:]
        means[c] = np.array([int(x) / n for x in first]) / GRID
        exact = products * n - np.outer(first, first)
        spreads[c] = np.array([[int(x) / n**2 for x in row] for row in exact]) / GRID**2
    common = sum(spreads[c] * counts[c] for c in counts) / everything
    diagonal = np.diag(np.diag(common))
    densities = []
    for c, n in counts.items():
        shrunk = (1 - TOWARDS_COMMON) * spreads[c] + TOWARDS_COMMON * common
        shrunk = (1 - TOWARDS_DIAGONAL) * shrunk + TOWARDS_DIAGONAL * diagonal + LEAST_SPREAD**2 * np.eye(len(diagonal))
        factor = np.linalg.cholesky(shrunk)
        top = math.log(n / everything) - float(np.log(np.diag(factor)).sum())
        densities.append(Density(means[c], np.linalg.inv(factor), top))
    return Model(tuple(densities), share)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """The model of stored statistics (doc_id, statistics) whose doc_id has a row (doc_id, label)."""
    taught = stats.join(labels, "doc_id")
    sums = taught.select("statistics", "label").mapInArrow(_summed, "label int, i int, j int, value decimal(38,0)")
    # a few hundred rows, whatever the number of documents
    found = sums.groupBy("label", "i", "j").agg(F.sum("value").alias("value")).collect()
    size = len(NAMES) + 1
    out: dict[int, np.ndarray] = {}
    for label, i, j, value in found:
        matrix = out.setdefault(label, np.zeros((size, size), object))
        matrix[i, j] = matrix[j, i] = int(value)
    return fitted(out)


def _scored(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch["statistics"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], names=["doc_id", "score"])

    return score


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_id_column: str = "doc_id",
    label_column: str = "quality",
) -> DataFrame:
    """Per row: doc_id, whether it is held out, its score, and 1 if that reaches ``threshold``, else 0."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    stats = materialise(texts.mapInArrow(_measured, "doc_id long, statistics array<int>"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    named = labels.select(F.col(label_id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    agreed = named.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    agreed = agreed.filter((F.col("label") == F.col("most")) & F.col("label").isin(0, 1)).select("doc_id", "label")
    model = fit(stats.filter(~held_out), agreed)
    scored = stats.mapInArrow(_scored(model), "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
