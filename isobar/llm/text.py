"""Whole texts of an Arrow batch as numpy arrays of words.

All functions work on the concatenated UTF-8 bytes of many texts at once.  White space is the
six ASCII characters ``\\x20\\x09-\\x0D``; they never occur inside a longer UTF-8 character, so
cutting bytes there is the same as cutting characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

#: Bytes of text handled at once; one longer text is handled alone, whole.
CHUNK_BYTES = 8 << 20

BLANKS = "\t\n\x0b\x0c\r "
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS.encode())] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` over a task's batches, whose freed memory goes back to the system at the end.

    A worker outlives its task and waits for another; what it keeps adds up beside its neighbours'.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return run


class Words(NamedTuple):
    """Words of many texts: ``vocabulary[codes[bounds[d]:bounds[d + 1]]]`` are those of text d."""

    codes: np.ndarray
    vocabulary: list[bytes]
    bounds: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the n + 1 places where they begin and end; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    places = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    if data is None or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def distinct(data: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, pa.Array]:
    """Codes of the byte strings that begin at ``starts`` (each up to the next), and the distinct strings."""
    places = pa.py_buffer(np.append(starts, end).astype(np.int64))
    values = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, pa.py_buffer(data)])
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def words(data: np.ndarray, places: np.ndarray) -> Words:
    """Maximal runs of characters other than white space."""
    data = np.ascontiguousarray(data)
    blank = IS_BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    heads = places[:-1][places[:-1] < places[1:]]
    begins[heads] = ~blank[heads]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, places)
    if not len(starts):
        return Words(np.zeros(0, np.int32), [], bounds)
    codes, with_blanks = distinct(data, starts, len(data))
    trimmed = pc.ascii_rtrim(with_blanks, characters=BLANKS).dictionary_encode()
    codes = trimmed.indices.to_numpy()[codes]
    return Words(codes, trimmed.dictionary.cast(pa.large_binary()).to_pylist(), bounds)


def segments(data: np.ndarray, places: np.ndarray) -> Words:
    """Cut texts before each run of white space that follows another character.

    The pieces add up to the text.  The public byte-level splitting patterns always end a match
    there, so a piece can be tokenized by itself.  A run right after one of the wider Unicode
    spaces is not cut off, since those patterns may match both together.
    """
    data = np.ascontiguousarray(data)
    blank = IS_BLANK[data]
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    heads = places[:-1][places[:-1] < places[1:]]
    begins[heads] = True
    starts = np.flatnonzero(begins)
    if not len(starts):
        return Words(np.zeros(0, np.int32), [], np.zeros(len(places), np.int64))
    one, two, three = (np.where(starts >= k, data[starts - k], 0) for k in (1, 2, 3))
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) & (one >= 0x80) | np.isin(one, (0xA8, 0xA9, 0xAF)))
    wide |= (three == 0xE2) & (two == 0x81) & (one == 0x9F)
    wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    starts = starts[~wide | np.isin(starts, heads)]
    codes, vocabulary = distinct(data, starts, len(data))
    return Words(codes, vocabulary.cast(pa.large_binary()).to_pylist(), np.searchsorted(starts, places))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes unchanged."""
    return LOWER[data]


def hashes(vocabulary: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))


def spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, .., c - 1 for each count c, one after another."""
    ends = np.cumsum(counts)
    out = np.arange(ends[-1] if len(ends) else 0)
    out -= np.repeat(ends - counts, counts)
    return out


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, .. of each span, one after another."""
    out = spread(counts)
    out += np.repeat(starts, counts)
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """One compressed byte string that holds the arrays."""
    heads = np.array([[ord(a.dtype.kind), a.dtype.itemsize, a.size] for a in arrays], "<i8")
    body = b"".join([np.array([len(arrays)], "<i8").tobytes(), heads.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpack(packed: bytes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(packed)
    (n,) = np.frombuffer(body, "<i8", 1)
    at, out = 8 + 24 * int(n), []
    for kind, width, size in np.frombuffer(body, "<i8", 3 * int(n), 8).reshape(-1, 3).tolist():
        out.append(np.frombuffer(body, f"<{chr(kind)}{width}", size, at))
        at += width * size
    return out


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as one array of bytes and their lengths."""
    return np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int32, len(parts))


def parted(data: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    whole, ends = data.tobytes(), np.cumsum(lengths).tolist()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def narrow(codes: np.ndarray) -> np.ndarray:
    """Non-negative integers in the fewest bytes of 1, 2 or 4."""
    most = int(codes.max()) if len(codes) else 0
    return codes.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
