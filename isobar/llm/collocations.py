"""Phrases whose words stand together more often than their parts would suggest.

Texts are cut at punctuation and line ends into pieces, and pieces into words.  Blocks of
documents are stored as packed word numbers.  Prefix polynomials of the words' hashes give every
n-gram of a piece a Rabin-Karp fingerprint; a block sends its distinct fingerprints with their
counts to buckets by range, and a bucket answers each block with one bit for each fingerprint it
sent: whether all blocks together hold it often enough.  So fingerprints only ever rule phrases
out.  The occurrences of what is left are looked up in the block's own words, where n-grams of
one fingerprint are compared word by word and parted if they differ, and only such phrases are
written out and counted, by their text.  Counts are therefore exact whatever fingerprints agree.

A phrase costs one entry for each block it occurs in, however often, so hot phrases and hot
languages are spread over all blocks.

Null texts are empty; null languages count as ``und``; ids play no part, so null or repeated ids
count row by row; extra columns are ignored; tables without words give no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.workspace import materialise, shared_folder

from . import blocks as B
from . import text as X
from .runs import runs, separators

#: Words end at blanks, pieces at the others.
PIECE_END = separators((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
SEPARATOR = PIECE_END | separators((0x09, 0x09), (0x20, 0x20))
MOST_WORDS = 4
BLOCK_BYTES = 8 << 20
#: Fingerprints of one bucket, on average and at most, and their bits.
ENTRIES = 4 << 20
BITS = 48
#: Lists into which a language's phrases are dealt for the first ranking step.
LISTS = 64
BLOCK = "block long, langs array<string>, words array<long>, payload binary"
SENT = "bucket int, block long, payload binary"
ANSWER = "block long, first int, answer binary"
PHRASE = "lang string, phrase string, size int, times long"
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# --- blocks -----------------------------------------------------------------------------------


def _make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word numbers of a chunk, words in each piece, and the language of each piece."""
    task, number = TaskContext.get().partitionId(), 0
    for chunk in X.chunks(batches, "text", BLOCK_BYTES):
        data, places = X.flat(chunk["text"])
        data = X.lower(np.ascontiguousarray(data))
        found = runs(data, places, SEPARATOR)
        if not len(found.codes):
            continue
        document = np.repeat(np.arange(chunk.num_rows), np.diff(found.bounds))
        cuts = np.flatnonzero(PIECE_END[data])
        before = np.searchsorted(cuts, found.starts)
        heads = np.flatnonzero((np.diff(before, prepend=-1) != 0) | (np.diff(document, prepend=-1) != 0))
        langs = pc.fill_null(chunk["lang"], "und").dictionary_encode()
        lang = langs.indices.to_numpy()[document]
        # frequent words first, so that numbers stay short
        often = np.bincount(found.codes, minlength=len(found.vocabulary))
        order = np.argsort(-often, kind="stable")
        renumbered = np.empty(len(order), np.int64)
        renumbered[order] = np.arange(len(order))
        words = [w.encode() for w in found.vocabulary.take(pa.array(order)).to_pylist()]
        payload = X.pack(
            X.narrow(renumbered[found.codes]), X.narrow(np.diff(np.append(heads, len(document)))), X.narrow(lang[heads]), *X.joined(words)
        )
        row = {
            "block": (task << 32) + number,
            "langs": langs.dictionary.to_pylist(),
            "words": np.bincount(lang, minlength=len(langs.dictionary)).tolist(),
            "payload": payload,
        }
        number += 1
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
            ("block", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.int64())), ("payload", pa.binary()),
        ]))


class _Block:
    """The n-grams of a block by their fingerprints."""

    def __init__(self, langs: list[str], payload: bytes) -> None:
        codes, sizes, lang, data, lengths = X.unpack(payload)
        self.codes, self.langs = codes, langs
        self.words = X.parted(data, lengths)
        self.left = np.repeat(np.cumsum(sizes.astype(np.int64)), sizes) - np.arange(len(codes))  # words to the end of the piece
        self.lang = np.repeat(lang, sizes)
        powers = np.ones(len(codes), np.uint64)
        powers[1:] = _BASE
        hashes = X.hashes(self.words)[codes] * np.cumprod(powers)
        self.prefix = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(hashes, out=self.prefix[1:])
        powers[1:] = _BACK
        self.back = np.cumprod(powers)
        self.seed = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in langs), np.uint64, len(langs))[self.lang]

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the n-grams of ``size`` words start, and their fingerprints."""
        at = np.flatnonzero(self.left >= size)
        value = (self.prefix[at + size] - self.prefix[at]) * self.back[at]
        return at, _mixed(value + self.seed[at] * np.uint64(2 * size + 1)) >> np.uint64(64 - BITS)

    def counted(self, at: np.ndarray, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each distinct phrase among ``at``, and how often it occurs, compared by words."""
        order = np.argsort(prints)
        at, prints = at[order], prints[order]
        new = np.diff(prints, prepend=np.uint64(1 << BITS)) != 0
        first = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        same = self.lang[at] == self.lang[first]
        for i in range(size):
            same &= self.codes[at + i] == self.codes[first + i]
        if not same.all():  # different phrases with one fingerprint
            columns = np.stack([self.lang[at], *(self.codes[at + i] for i in range(size))], axis=1)
            _, heads, times = np.unique(columns, axis=0, return_index=True, return_counts=True)
            return at[heads], times
        heads = np.flatnonzero(new)
        return at[heads], np.diff(np.append(heads, len(at)))


def _sorted(prints: np.ndarray) -> np.ndarray:
    """The distinct fingerprints in order."""
    ordered = np.sort(prints)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def _among(prints: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which fingerprints are in a sorted list; their upper bits alone rule most of them out."""
    upper = np.uint64(BITS - 22)
    maybe = np.zeros(1 << 22, bool)
    maybe[listed >> upper] = True
    found = maybe[prints >> upper]
    at = np.flatnonzero(found)
    place = np.minimum(np.searchsorted(listed, prints[at]), max(len(listed) - 1, 0))
    found[at] = listed[place] == prints[at]
    return found


def _edges(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's fingerprints begin and end among sorted ones."""
    limits = [(b << BITS) // buckets for b in range(buckets)] + [1 << BITS]
    return np.searchsorted(distinct, np.array(limits, np.uint64))


def _sent(buckets: int):
    """A block's distinct fingerprints and counts for each bucket of each size."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["langs"], row["payload"])
                for size in range(1, MOST_WORDS + 1):
                    distinct, times = np.unique(block.grams(size)[1], return_counts=True)
                    edges = _edges(distinct, buckets)
                    used = np.flatnonzero(np.diff(edges))
                    out = []
                    for b in used.tolist():
                        own = slice(edges[b], edges[b + 1])
                        gaps = np.diff(distinct[own], prepend=np.uint64(0))
                        # the bytes of equal worth together, as the upper ones are nearly alike
                        planes = [(gaps >> np.uint64(8 * i)).astype(np.uint8) for i in range(BITS // 8)]
                        out.append(X.pack(*planes, X.narrow(times[own])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(used + (size - 1) * buckets, pa.int32()), pa.array([row["block"]] * len(used), pa.int64()), pa.array(out, pa.binary())],
                        names=["bucket", "block", "payload"],
                    )

    return send


def _answered(least: int):
    """One bit for each fingerprint that a block sent; rows come sorted by bucket."""

    def judged(blocks: list[int], payloads: list[bytes]) -> pa.RecordBatch:
        sent, times = [], []
        for payload in payloads:
            *planes, count = X.unpack(payload)
            gaps = reduce(lambda a, b: (a << np.uint64(8)) | b, (p.astype(np.uint64) for p in reversed(planes)))
            sent.append(np.cumsum(gaps))
            times.append(count.astype(np.int64))
        every = np.concatenate(sent)
        order = np.argsort(every, kind="stable")
        heads = np.flatnonzero(np.diff(every[order], prepend=np.uint64(1 << BITS)) != 0)
        sums = np.add.reduceat(np.concatenate(times)[order], heads)
        often = every[order][heads[sums >= least]]
        out_block, out = [], []
        if len(often):
            for block, prints in zip(blocks, sent):
                place = np.minimum(np.searchsorted(often, prints), len(often) - 1)
                bits = often[place] == prints
                if bits.any():
                    out_block.append(block)
                    out.append(X.pack(np.packbits(bits)))
        return pa.RecordBatch.from_arrays([pa.array(out_block, pa.int64()), pa.array(out, pa.binary())], names=["block", "answer"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks, waiting = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if waiting:
                found = judged(blocks, waiting)
                first = pa.array([bucket] * found.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([found["block"], first, found["answer"]], names=["block", "first", "answer"])

        for batch in batches:
            for number, block, payload in zip(*(batch[c].to_pylist() for c in ("bucket", "block", "payload"))):
                if number != bucket:
                    yield from done()
                    bucket, blocks, waiting = number, [], []
                blocks.append(block)
                waiting.append(payload)
        yield from done()

    return answer


def _phrases(buckets: int):
    """The phrases of a block that may be frequent, with their counts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                answers = {a["first"]: a["answer"] for a in row["answers"] or ()}
                if not answers:
                    continue
                block = _Block(row["langs"], row["payload"])
                words = pa.array([w.decode() for w in block.words], pa.large_string())
                langs = pa.array(block.langs, pa.string())
                for size in range(1, MOST_WORDS + 1):
                    at, prints = block.grams(size)
                    distinct = _sorted(prints)
                    edges = _edges(distinct, buckets)
                    often = np.zeros(len(distinct), bool)
                    for b in range(buckets):
                        mask = answers.get((size - 1) * buckets + b)
                        if mask is not None:
                            often[edges[b] : edges[b + 1]] = np.unpackbits(X.unpack(mask)[0], count=int(edges[b + 1] - edges[b]))
                    wanted = _among(prints, distinct[often])
                    if not wanted.any():
                        continue
                    places, times = block.counted(at[wanted], prints[wanted], size)
                    parts = [words.take(pa.array(block.codes[places + i])) for i in range(size)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(block.lang[places])), phrase.cast(pa.string()),
                         pa.array(np.full(len(places), size, np.int32)), pa.array(times, pa.int64())],
                        names=["lang", "phrase", "size", "times"],
                    )

    return find


def phrase_counts(docs: DataFrame, least: int, lang_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Stored: lang, phrase, size and f of every phrase of one to four words with f >= ``least``; and lang, n."""
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    name = f"phrases_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bucketed, so that only the answers move when they are joined
    texts.mapInArrow(X.tidy(_make), BLOCK).write.bucketBy(partitions, "block").option("path", path).saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
    words = blocks.select(F.inline(F.arrays_zip("langs", "words"))).groupBy(F.col("langs").alias("lang")).agg(F.sum("words").alias("n"))
    total = blocks.agg(F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    buckets = max(1, math.ceil(total / ENTRIES))
    sent = blocks.select("block", "langs", "payload").mapInArrow(X.tidy(_sent(buckets)), SENT)
    answers = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(X.tidy(_answered(least)), ANSWER)
    found = B.answered(blocks, answers, "langs", "payload").mapInArrow(X.tidy(_phrases(buckets)), PHRASE)
    counted = found.groupBy("lang", "phrase", "size").agg(F.sum("times").alias("f")).filter(F.col("f") >= least)
    return materialise(counted), words


# --- scores -----------------------------------------------------------------------------------


def _wide(column: str):
    return F.col(column).cast("decimal(30,0)")


def collocations(
    docs: DataFrame,
    least: int = 30,
    most: int = 2000,
    covered_percent: int = 80,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """Each language's ``most`` best phrases of two to four words that occur ``least`` times.

    lang, rank, phrase, a (its occurrences), l and r (those of the two parts of the cut with the
    lowest score), n (the language's words) and score.  A phrase inside a longer one that has at
    least ``covered_percent`` of its occurrences is left out.
    """
    counts, words = phrase_counts(docs, least, lang_column, text_column)
    parts = F.split("phrase", " ")
    candidates = counts.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), parts.alias("w"))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    # every part of a candidate occurs at least as often, so it is among the counts
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = F.array(F.struct(F.lit("l").alias("side"), part(1, k).alias("part")), F.struct(F.lit("r").alias("side"), part(k + 1, F.col("size") - k).alias("part")))
    asked = cuts.select("lang", "phrase", "a", "size", "k", F.inline(sides))
    known = counts.select("lang", F.col("phrase").alias("part"), "f")
    place = lambda side, cut: F.max(F.when((F.col("side") == side) & (k == cut), F.col("f"))).alias(f"{side}{cut}")
    cut_range = range(1, MOST_WORDS)
    wide = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*[place(s, c) for c in cut_range for s in "lr"])

    def scored(cut):
        # null where the phrase is too short for the cut; integer division of decimals is exact
        score = F.expr(f"(2000000 * cast(a as decimal(30,0))) div cast(l{cut} + r{cut} as decimal(30,0))")
        return F.when(F.col(f"l{cut}").isNotNull(), F.struct(score.alias("score"), F.lit(cut).alias("k"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))

    best = wide.select("lang", "phrase", "a", F.least(*[scored(c) for c in cut_range]).alias("cut"))
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " ")),
    ))
    inside = candidates.filter("size > 2").select("lang", F.col("a").alias("longer"), F.explode(spans).alias("phrase"))
    covering = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(covering, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * _wide("longer") < covered_percent * _wide("a"))
    )
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    ranked = kept.withColumn("list", F.pmod(F.xxhash64("phrase"), F.lit(LISTS)))
    for keys in (["lang", "list"], ["lang"]):
        # one language may hold nearly all phrases: its lists are cut before they meet
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        ranked = ranked.withColumn("rank", place).filter(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
