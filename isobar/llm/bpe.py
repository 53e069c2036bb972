"""Byte-level BPE as Spark expressions: ranked merges folded over the bytes of distinct words.

Python only cuts texts into words by the public pattern and numbers the distinct ones.  Each
distinct word of the corpus reaches one bucket (see ``blocks``), where Spark higher-order
functions merge its bytes, looking ranks up in a map that is a literal of the plan.  The ids go
back to the blocks, and decoding puts the binary pieces of a document's ids together.

A byte is written as the character of the same number (ISO-8859-1), so a piece is a short
string.  The rank map is cut into cells by crc32, as Spark searches a map from end to end; it stands
in the plan once.

A step of the fold rebuilds its lists, so a word costs the square of its length.  Words of more
than ``LONG`` bytes, such as text without blanks, are merged in Python with a priority queue.

Null texts are empty; rows with null or repeated ids are handled one by one; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from . import text as X

#: Smaller than elsewhere, for the lists of words that Python holds.
BLOCK_BYTES = 6 << 20
CELLS = 1 << 15
#: Words, and lists that blocks ask for, that one row holds; a bucket has as many rows as it needs.
ROW_WORDS, ROW_ASKS = 4096, 64
LONG = 256
NO_RANK = 2**31 - 1
#: What the pattern calls white space (Unicode's White_Space), for an engine that has a wider \s.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of each piece in a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, lines))}


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


class Ranks:
    """The rank table as a literal of a plan."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        cells: list[dict[str, int]] = [{} for _ in range(CELLS)]
        for piece, rank in ranks.items():
            name = piece.decode("latin-1")
            cells[zlib.crc32(name.encode()) % CELLS][name] = rank
        self.cells = _literal(cells, "array<map<string,int>>")

    def encode_all(self, words: str) -> Column:
        """The ids of each word of an array."""
        return _let(self.cells, lambda cells: F.transform(words, lambda word: _encoded(cells, word)))


def _rank(cells: Column, piece: Column) -> Column:
    cell = F.get(cells, (F.crc32(piece) % CELLS).cast("int"))
    return F.coalesce(F.try_element_at(cell, piece), F.lit(NO_RANK))


def _encoded(cells: Column, word: Column) -> Column:
    """Ids of a word that is written as ISO-8859-1 characters.

    The state lists the pieces, and the rank of each with the next one put together.  A step
    merges the leftmost pair of lowest rank and looks up the two ranks that change; a word
    of n bytes needs n - 1 steps at most.
    """

    def state(pieces: Column, ranks: Column) -> Column:
        return F.struct(pieces.alias("pieces"), ranks.alias("ranks"))

    def merge(pieces: Column, ranks: Column, at: Column) -> Column:
        """``at``: where the pair begins, from 1."""

        def with_piece(new: Column) -> Column:
            size = F.size(pieces)
            shorter = F.transform(
                F.slice(pieces, 1, size - 1), lambda x, i: F.when(i < at - 1, x).when(i == at - 1, new).otherwise(F.get(pieces, i + 1))
            )
            reranked = F.transform(
                F.slice(ranks, 1, size - 2),
                lambda x, i: F.when(i < at - 2, x)
                .when(i == at - 2, _rank(cells, F.concat(F.get(pieces, i), new)))
                .when(i == at - 1, _rank(cells, F.concat(new, F.get(pieces, at + 1))))
                .otherwise(F.get(ranks, i + 1)),
            )
            return state(shorter, reranked)

        return _let(F.concat(F.get(pieces, at - 1), F.get(pieces, at)), with_piece)

    def step(now: Column, _: Column) -> Column:
        def with_least(least: Column) -> Column:
            place = F.array_position(now["ranks"], least).cast("int")
            return F.when(least < NO_RANK, _let(place, lambda at: merge(now["pieces"], now["ranks"], at))).otherwise(now)

        return _let(F.array_min(now["ranks"]), with_least)

    def folded(letters: Column) -> Column:
        following = F.slice(letters, 2, F.size(letters))
        ranks = F.transform(following, lambda b, i: _rank(cells, F.concat(F.get(letters, i), b)))
        return F.aggregate(following, state(letters, ranks), step, lambda end: F.transform(end["pieces"], lambda p: _rank(cells, p)))

    def merged(whole: Column) -> Column:
        return F.when(whole < NO_RANK, F.array(whole)).otherwise(_let(F.split(word, ""), folded))

    # a long word is left empty
    return F.when(word == "", F.array().cast("array<int>")).otherwise(_let(_rank(cells, word), merged))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word, the leftmost pair of lowest rank first, in about n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, begins = list(range(1, n + 1)), list(range(-1, n)), [True] * n
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, e = heapq.heappop(waiting)
        middle = end[i]
        if not begins[i] or middle >= n or end[middle] != e:
            continue  # one of the two was merged since
        begins[middle], end[i], before[e] = False, e, i
        if e < n and (r := ranks.get(word[i : end[e]])) is not None:
            heapq.heappush(waiting, (r, i, end[e]))
        if i and (r := ranks.get(word[before[i] : e])) is not None:
            heapq.heappush(waiting, (r, before[i], e))
    return [ranks[word[i : end[i]]] for i in range(n) if begins[i]]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def word_pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern.replace(r"^\s", f"^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


def _cut(pattern: str):
    """Words by the pattern: each distinct piece between white space is cut once."""

    def cut(data: np.ndarray, places: np.ndarray) -> X.Words:
        find, pieces, numbers = word_pattern(pattern).findall, X.segments(data, places), {}
        codes, sizes = [], []
        for piece in pieces.vocabulary:
            # most pieces are a blank and ASCII letters, or those and a mark: one or two words
            letters = piece[1:] if piece[:1] == b" " else piece
            if letters.isalpha():
                own = (piece.decode(),)
            elif letters[:-1].isalpha() and letters[-1:] in (b".", b","):
                own = (piece[:-1].decode(), letters[-1:].decode())
            else:
                own = find(piece.decode())
            codes += [numbers.setdefault(w, len(numbers)) for w in own]
            sizes.append(len(own))
        codes, sizes = np.array(codes, np.int64), np.array(sizes, np.int64)
        each = sizes[pieces.codes]
        bounds = np.concatenate([[0], np.cumsum(each)])[pieces.bounds]
        sequence = codes[X.gather((np.cumsum(sizes) - sizes)[pieces.codes], each)]
        return X.Words(sequence, [w.encode() for w in numbers], bounds)

    return cut


def _sequence(found: X.Words) -> bytes:
    """Ends of the documents and their words: frequent ones in one byte, others in two more."""
    often = np.argsort(-np.bincount(found.codes, minlength=len(found.vocabulary)), kind="stable")
    place = np.empty(len(often), np.int64)
    place[often] = np.arange(len(often))
    short = place[found.codes]
    rest = short[short >= 255]
    return X.pack(found.bounds, X.narrow(often), np.minimum(short, 255).astype(np.uint8), (rest & 255).astype(np.uint8), X.narrow(rest >> 8))


def _words_of(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    bounds, often, first, low, high = X.unpack(body)
    short = first.astype(np.int64)
    short[first == 255] = low.astype(np.int64) + (high.astype(np.int64) << 8)
    return bounds, often.astype(np.int64)[short] if len(often) else short


_ASKED = pa.list_(pa.struct([("block", pa.int64()), ("first", pa.int32()), ("places", pa.binary())]))
DISTINCT = "words array<string>, long array<binary>, asked array<struct<block: long, first: int, places: binary>>, last boolean"


def _distinct(row_words: int):
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket's distinct words in rows, and then which of them each block asked for, also in rows.

        Long words are left empty among the words and stand beside them, in their order.
        """
        bucket, known, asked = None, {}, []

        def close() -> Iterator[pa.RecordBatch]:
            listed = list(known)
            parts = [listed[i : i + row_words] for i in range(0, len(listed), row_words)]
            asks = [asked[i : i + ROW_ASKS] for i in range(0, len(asked), ROW_ASKS)]
            for part in parts:
                words = ["" if len(w) > LONG else w.decode("latin-1") for w in part]
                yield row(words, [w for w in part if len(w) > LONG], [], False)
            for i, part in enumerate(asks):
                yield row([], [], part, i == len(asks) - 1)

        def row(words: list[str], long: list[bytes], part: list[dict], last: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([words], pa.list_(pa.string())), pa.array([long], pa.list_(pa.binary())), pa.array([part], _ASKED), pa.array([last])],
                names=["words", "long", "asked", "last"],
            )

        for batch in batches:
            for given in batch.to_pylist():
                if given["bucket"] != bucket:
                    yield from close()
                    bucket, known, asked = given["bucket"], {}, []
                listed = X.parted(*X.unpack(given["words"]))
                places = np.fromiter((known.setdefault(w, len(known)) for w in listed), np.int64, len(listed))
                asked.append({"block": given["block"], "first": given["first"], "places": X.pack(X.narrow(places))})
        yield from close()

    return distinct


def _routed(ranks: dict[bytes, int]):
    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's answer: the ids of the words it asked for; rows come in the order of ``_distinct``."""
        parts, whole = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lists = row["ids"].flatten()
                if len(lists):
                    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                    ids = lists.flatten().to_numpy().astype(np.uint32)
                    long = [np.array(merge_long(w.as_py(), ranks), np.uint32) for w in row["long"].flatten()]
                    if long:
                        at = np.flatnonzero(counts == 0)
                        ids = np.insert(ids, np.repeat(np.cumsum(counts)[at], [len(x) for x in long]), np.concatenate(long))
                        counts[at] = [len(x) for x in long]
                    parts.append((ids, counts))
                asked = row["asked"].to_pylist()[0]
                if not asked:
                    continue
                if whole is None:
                    flat, counts = (np.concatenate(each) for each in zip(*parts))
                    whole = flat, counts, np.cumsum(counts) - counts
                flat, counts, starts = whole
                out = []
                for x in asked:
                    places = X.unpack(x["places"])[0]
                    own = flat[X.gather(starts[places], counts[places])]
                    answer = X.pack(X.narrow(counts[places]), (own & 255).astype(np.uint8), X.narrow(own >> 8))
                    out.append({"block": x["block"], "first": x["first"], "answer": answer})
                if row["last"][0].as_py():
                    parts, whole = [], None
                yield pa.RecordBatch.from_pylist(
                    out, schema=pa.schema([("block", pa.int64()), ("first", pa.int32()), ("answer", pa.binary())])
                )

    return routed


def _documents(piece_of: dict[int, bytes]):
    """Digests of each document: its ids, and the pieces of its ids put together."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                written, decoded, counted = [], [], [np.zeros(0, np.int64)]
                for x in row["answers"].to_pylist()[0] or []:
                    counts, low, high = X.unpack(x["answer"])
                    ids = (low.astype(np.int64) + (high.astype(np.int64) << 8)).tolist()
                    numbers, pieces = list(map(str, ids)), list(map(piece_of.__getitem__, ids))
                    edges = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).tolist()
                    written += [" ".join(numbers[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                    decoded += [b"".join(pieces[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                    counted.append(counts.astype(np.int64))
                bounds, sequence = _words_of(row["body"].to_pylist()[0])
                total = np.concatenate([[0], np.cumsum(np.concatenate(counted)[sequence])])[bounds]
                ids_sha, bytes_sha = [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = sequence[a:b].tolist()
                    ids_sha.append(hashlib.sha256(" ".join([written[c] for c in own]).encode()).hexdigest())
                    bytes_sha.append(hashlib.sha256(b"".join([decoded[c] for c in own])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].flatten(), pa.array(np.diff(total), pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    buckets: int | None = None,
    row_words: int = ROW_WORDS,
) -> DataFrame:
    """Per row: doc_id, n_tokens, and digests of the ids and of the bytes decoded from them."""
    ranks = read_ranks(ranks_path)
    blocks = B.blocks_of(docs, id_column, text_column, _cut(pattern), _sequence, block_bytes, buckets)
    distinct = B.by_bucket(blocks).mapInArrow(X.tidy(_distinct(row_words)), DISTINCT)
    encoded = distinct.select("asked", "long", "last", Ranks(ranks).encode_all("words").alias("ids"))
    answers = encoded.mapInArrow(X.tidy(_routed(ranks)), "block long, first int, answer binary")
    return B.answered(blocks, answers, "doc_ids", "body").mapInArrow(
        X.tidy(_documents({rank: piece for piece, rank in ranks.items()})),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
