"""Removing passages that repeat: windows of words counted exactly by super-k-mers.

A window is ``window`` consecutive words.  Its minimiser is the least of the hashed grams of
``GRAM`` words inside it.  Consecutive windows of one document that share a minimiser travel as
one packed string, a super-k-mer, to the bucket of that minimiser; all copies of a window meet
there.  A bucket sorts its windows by a hash and compares the words of neighbours with equal
hashes, so counts are exact.  Every window but the first of its kind (by document, then place)
covers words that are removed.

Hot passages: super-k-mers that repeat inside a chunk of text are judged where they are and only
their first copy travels.  Grams that are frequent in the corpus (found by a first pass) come
last in the order of grams, so that a window at the edge of a common passage is sent by the rare
words next to it and not to the one bucket of the passage.

Documents are ordered by id (null first), then by a hash of their text; rows equal in both are
one document.  Null texts have no words.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.workspace import materialise

from . import text as X

GRAM = 3
CHUNK_BYTES = 16 << 20
#: Buckets for each shuffle partition, and frequent grams that are looked for, also for each.
BUCKETS, FREQUENT = 1, 20
MARK = "doc_id long, text_hash long, start int, count int"
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD))
_TOP = np.uint64(1) << np.uint64(63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _D
    return x ^ (x >> np.uint64(29))


def _grams(found: X.Words) -> np.ndarray:
    """A hash (below 2**63) of the three words from each place on; the last two of all are left out."""
    h = X.hashes(found.vocabulary)[found.codes]
    if len(h) < GRAM:
        return np.zeros(0, np.uint64)
    return _mixed(h[:-2] * _A + h[1:-1] * _B + h[2:] * _C) >> np.uint64(1)


def _inside(bounds: np.ndarray, n: int, size: int) -> np.ndarray:
    """Whether the ``size`` words from each of the first ``n`` places on belong to one document."""
    lengths = np.diff(bounds)
    to_end = np.repeat(bounds[1:], lengths) - np.arange(bounds[-1])
    return to_end[:n] >= size


def _frequent(share: float):
    """Grams that make up at least ``share`` of a chunk, with their counts, and the size of the chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, "text", CHUNK_BYTES):
            found = X.words(*X.flat(chunk["text"]))
            grams = _grams(found)
            grams = np.sort(grams[_inside(found.bounds, len(grams), GRAM)])
            heads = np.flatnonzero(np.diff(grams, prepend=_TOP) != 0)
            times = np.diff(np.append(heads, len(grams)))
            often = times >= max(2, share * len(grams))
            keys = np.append(grams[heads[often]].astype(np.int64), -1)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.append(times[often], len(grams)))], names=["gram", "times"])

    return count


def frequent_grams(texts: DataFrame, most: int) -> np.ndarray:
    """Every gram that is more than 2 / ``most`` of all; at most ``most`` of them, in order.

    A chunk leaves out grams below 1 / most of its own, so a gram's sum falls short by at most
    that share of all grams.
    """
    counted = texts.select("text").mapInArrow(X.tidy(_frequent(1 / most)), "gram long, times long")
    counts = materialise(counted.groupBy("gram").agg(F.sum("times").alias("times")))
    total = counts.where("gram = -1").select("times").first()  # all grams
    least = (total[0] if total else 0) / most
    found = counts.where((F.col("gram") != -1) & (F.col("times") > least)).select("gram").collect()  # at most ``most`` rows
    return np.sort(np.array([g for (g,) in found], np.uint64))


def _ordered(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Frequent grams behind all others."""
    if not len(frequent):
        return grams
    low = np.uint64(0xFFFF)
    maybe = np.zeros(1 << 16, bool)
    maybe[(frequent & low).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(grams & low).astype(np.int64)])
    place = np.minimum(np.searchsorted(frequent, grams[at]), len(frequent) - 1)
    out = grams.copy()
    hot = at[frequent[place] == grams[at]]
    out[hot] |= _TOP
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _same(codes: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the spans of ``sizes`` codes from a and from b on are equal."""
    if not len(a):
        return np.zeros(0, bool)
    equal = codes[X.gather(a, sizes)] == codes[X.gather(b, sizes)]
    return np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)


def _document_order(chunk: pa.RecordBatch) -> np.ndarray:
    """Rank of each row by (id, hash), null first; equal rows share one."""
    null = chunk["doc_id"].is_null().to_numpy(zero_copy_only=False)
    ids, hashes = chunk["doc_id"].fill_null(0).to_numpy(), chunk["text_hash"].to_numpy()
    return _ranks(~null, ids, hashes)


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Rank by the first key, then the second and so on; equal ones share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


_PACKED = "bucket int, payload binary"


def _super_kmers(window: int, buckets: int, frequent: np.ndarray):
    """Packed super-k-mers of a chunk by bucket; those judged here travel with bucket -1 - n."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in X.chunks(batches, "text", CHUNK_BYTES):
            found = X.words(*X.flat(chunk["text"]))
            n = len(found.codes) - window + 1
            if n <= 0:
                continue
            least = _least(_ordered(_grams(found), frequent), window - GRAM + 1)[:n]
            at = np.flatnonzero(_inside(found.bounds, n, window))
            if not len(at):
                continue
            document = np.repeat(np.arange(chunk.num_rows), np.diff(found.bounds))
            new = np.ones(len(at), bool)
            new[1:] = (least[at][1:] != least[at][:-1]) | (np.diff(at) != 1)
            heads = np.flatnonzero(new)
            start, windows = at[heads], np.diff(np.append(heads, len(at)))
            sizes = windows + window - 1
            bucket = (_mixed(least[start]) % np.uint64(buckets)).astype(np.int64)
            doc = document[start]
            place = start - found.bounds[doc]
            order_of = _document_order(chunk)
            # equal strings: the first stays, the others repeat it whole
            running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(X.hashes(found.vocabulary)[found.codes]))])
            sums = running[start + sizes] - running[start] ^ least[start]
            order = np.lexsort((place, order_of[doc], sizes, sums))
            repeats = np.zeros(len(order), bool)
            a, b = order[:-1], order[1:]
            like = np.flatnonzero((sums[a] == sums[b]) & (sizes[a] == sizes[b]))
            repeats[like + 1] = _same(found.codes, start[a[like]], start[b[like]], sizes[a[like]])
            firsts = np.maximum.accumulate(np.where(repeats, 0, np.arange(len(order))))
            first = order[firsts]
            itself = (order_of[doc[first]] == order_of[doc[order]]) & (place[first] == place[order])
            marked, sent = order[repeats & ~itself], order[~repeats]
            names = chunk["doc_id"].is_null().to_numpy(zero_copy_only=False), chunk["doc_id"].fill_null(0).to_numpy(), chunk["text_hash"].to_numpy()
            out_bucket, out = [], []
            for rows, sign in ((sent, 1), (marked, -1)):
                rows = rows[np.argsort(bucket[rows], kind="stable")]
                edges = np.flatnonzero(np.diff(bucket[rows], prepend=-1, append=-1))
                for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    own = rows[i:j]
                    docs, number = np.unique(doc[own], return_inverse=True)
                    listed = [names[0][docs], names[1][docs], names[2][docs], X.narrow(number), X.narrow(place[own])]
                    if sign > 0:
                        codes = found.codes[X.gather(start[own], sizes[own])]
                        times = np.bincount(codes, minlength=len(found.vocabulary))
                        used = np.flatnonzero(times)
                        used = used[np.argsort(-times[used], kind="stable")]  # frequent words get short codes
                        times[used] = np.arange(len(used))
                        codes = times[codes].astype(np.uint32)
                        vocabulary = X.joined([found.vocabulary[c] for c in used.tolist()])
                        listed += [X.narrow(sizes[own]), (codes & np.uint32(255)).astype(np.uint8), X.narrow(codes >> np.uint32(8)), *vocabulary]
                    else:
                        listed += [X.narrow(windows[own])]
                    out_bucket.append(int(bucket[own[0]]) if sign > 0 else -1 - int(bucket[own[0]]))
                    out.append(X.pack(*listed))
            yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(out, pa.binary())], names=["bucket", "payload"])

    return make


def _window_keys(codes: np.ndarray, heads: np.ndarray, window: int) -> np.ndarray:
    """A hash of the ``window`` codes from each of ``heads`` on."""
    words = _mixed((np.arange(codes.max() + 1 if len(codes) else 0).astype(np.uint64) + np.uint64(1)) * _A)
    key = np.zeros(len(heads), np.uint64)
    for i in range(window):
        key *= _B
        key += words[codes[heads + i]]
    return _mixed(key)


def _exact_keys(codes: np.ndarray, heads: np.ndarray, window: int) -> np.ndarray:
    """Ranks of the windows by their codes, for the case that hashes of different windows agree."""
    return np.unique(codes[heads[:, None] + np.arange(window)], axis=0, return_inverse=True)[1].astype(np.uint64)


def repeated_windows(codes: np.ndarray, start: np.ndarray, windows: np.ndarray, order: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(super-k-mer, place) of each window that is not the first of its kind.

    Super-k-mer i has ``windows[i]`` windows from ``codes[start[i]]`` on; it stands at ``place[i]``
    of the document that comes ``order[i]``-th.
    """
    by = np.lexsort((place, order)).astype(np.int32)
    heads, number = X.gather(start[by].astype(np.int32), windows[by]).astype(np.int32), np.repeat(by, windows[by])
    places = X.gather(place[by].astype(np.int32), windows[by]).astype(np.int32)
    keys = _window_keys(codes, heads, window)
    for exact in (False, True):
        sorted_ = np.argsort(keys, kind="stable")
        like = np.flatnonzero(keys[sorted_][1:] == keys[sorted_][:-1])
        a, b = heads[sorted_[like]], heads[sorted_[like + 1]]
        equal = np.ones(len(like), bool)
        for i in range(window):
            equal &= codes[a + i] == codes[b + i]
        if equal.all() or exact:
            break
        keys = _exact_keys(codes, heads, window)
    repeats = np.zeros(len(sorted_), bool)
    repeats[like + 1] = True
    first = sorted_[np.maximum.accumulate(np.where(repeats, 0, np.arange(len(sorted_))))]
    other = (order[number[sorted_]] != order[number[first]]) | (places[sorted_] != places[first])
    hit = sorted_[repeats & other]
    return number[hit], places[hit]


def _judged(window: int):
    """Places of repeated windows; rows come sorted by bucket."""

    def spans(null: np.ndarray, ids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, place: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[doc], mask=null[doc]), pa.array(hashes[doc]), pa.array(place, pa.int32()), pa.array(count, pa.int32())],
            names=["doc_id", "text_hash", "start", "count"],
        )

    def bucket_spans(payloads: list[bytes]) -> pa.RecordBatch | None:
        parts = [X.unpack(p) for p in payloads]
        null, ids, hashes = (np.concatenate([p[i] for p in parts]) for i in range(3))
        first_doc = np.cumsum([0, *(len(p[0]) for p in parts)])
        doc = np.concatenate([p[3].astype(np.int64) + d for p, d in zip(parts, first_doc)])
        place, sizes = (np.concatenate([p[i].astype(np.int64) for p in parts]) for i in (4, 5))
        lengths = np.concatenate([p[9] for p in parts]).astype(np.int64)
        listed, _ = X.distinct(np.concatenate([p[8] for p in parts]), np.cumsum(lengths) - lengths, int(lengths.sum()))
        first_word = np.cumsum([0, *(len(p[9]) for p in parts)])
        codes = np.concatenate([listed[w + p[6] + (p[7].astype(np.int64) << 8)] for p, w in zip(parts, first_word)])
        order = _ranks(~null.astype(bool), ids, hashes)
        start = np.cumsum(sizes) - sizes
        kmer, at = repeated_windows(codes, start, sizes - window + 1, order[doc], place, window)
        if not len(kmer):
            return None
        by = np.lexsort((at, kmer))
        kmer, at = kmer[by], at[by]
        heads = np.flatnonzero((np.diff(kmer, prepend=-1) != 0) | (np.diff(at, prepend=-9) != 1))
        count = np.diff(np.append(heads, len(at)))
        return spans(null.astype(bool), ids, hashes, doc[kmer[heads]], at[heads], count)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting = None, []
        for batch in batches:
            for number, payload in zip(batch["bucket"].to_pylist(), batch["payload"].to_pylist()):
                if number < 0:
                    null, ids, hashes, doc, place, count = X.unpack(payload)
                    yield spans(null.astype(bool), ids, hashes, doc.astype(np.int64), place.astype(np.int64), count.astype(np.int64))
                    continue
                if number != bucket and waiting:
                    if (out := bucket_spans(waiting)) is not None:
                        yield out
                    waiting = []
                bucket = number
                waiting.append(payload)
        if waiting and (out := bucket_spans(waiting)) is not None:
            yield out

    return judge


def repeated_spans(texts: DataFrame, window: int, partitions: int) -> DataFrame:
    """Per document (doc_id, text_hash): spans of ``count`` repeated windows from word ``start`` on."""
    frequent = frequent_grams(texts, max(1, FREQUENT * partitions))
    return (
        texts.mapInArrow(X.tidy(_super_kmers(window, BUCKETS * partitions, frequent)), _PACKED)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(X.tidy(_judged(window)), MARK)
    )


def _cleaned(window: int, emit: Callable[[list[bytes], np.ndarray], tuple], names: list[str], types: list[pa.DataType], carried: list[str]):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"]):
                words = (text.as_py() or "").encode().split()
                removed = np.zeros(len(words), bool)
                for span in spans.as_py() or ():
                    removed[span["start"] : span["start"] + span["count"] + window - 1] = True
                out.append(emit(words, removed))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(names), types)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in carried), *columns], names=[*carried, *names])

    return clean


def _kept(words: list[bytes], removed: np.ndarray) -> bytes:
    return b" ".join(compress(words, (~removed).tolist()) if removed.any() else words)


def _digest(words: list[bytes], removed: np.ndarray) -> tuple[int, int, str]:
    return len(words), int(removed.sum()), hashlib.sha256(_kept(words, removed)).hexdigest()


def _text(words: list[bytes], removed: np.ndarray) -> tuple[str | None]:
    return (_kept(words, removed).decode() if removed.any() else None,)


def _with_spans(docs: DataFrame, window: int, id_column: str, text_column: str, *others: str) -> DataFrame:
    """Columns doc_id, text, text_hash, the others, and the spans of repeated windows."""
    if window <= GRAM:
        raise ValueError(f"a window needs more than {GRAM} words")
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.xxhash64(F.col(text_column).cast("string")).alias("text_hash"),
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(others)),
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = repeated_spans(keyed.select("doc_id", "text", "text_hash"), window, partitions)
    listed = spans.groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(
        F.collect_list(F.struct("start", "count")).alias("spans")
    )
    return keyed.join(listed, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left").drop("own_id", "own_hash")


def removals(docs: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and the digest of the words that stay, joined by one space."""
    names, types = ["n_words", "n_removed", "kept_sha256"], [pa.int64(), pa.int64(), pa.string()]
    found = _with_spans(docs, window, id_column, text_column).select("doc_id", "text", "spans")
    return found.mapInArrow(
        X.tidy(_cleaned(window, _digest, names, types, ["doc_id"])), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The same rows and columns; texts that lose words become the rest joined by one space, others stay as they are."""
    others = [c for c in docs.columns if c not in (id_column, text_column)]
    found = _with_spans(docs, window, id_column, text_column, *others)
    carried = ["doc_id", "text", *(f"carried_{i}" for i in range(len(others)))]
    types = dict(found.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in carried) + ", shorter string"
    out = found.select(*carried, "spans").mapInArrow(X.tidy(_cleaned(window, _text, ["shorter"], [pa.string()], carried)), schema)
    back = {id_column: F.col("doc_id"), text_column: F.coalesce("shorter", "text")} | {c: F.col(f"carried_{i}") for i, c in enumerate(others)}
    return out.select(*(back[c].alias(c) for c in docs.columns))
