"""Maximal runs of bytes between separators, for many texts at once.

Separators are ASCII bytes, which never occur inside a longer UTF-8 character, so cutting bytes
is the same as cutting characters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from . import text as X


class Runs(NamedTuple):
    """``vocabulary[codes[bounds[d]:bounds[d + 1]]]`` are the runs of text d; run i starts at byte ``starts[i]``."""

    codes: np.ndarray
    vocabulary: pa.Array
    bounds: np.ndarray
    starts: np.ndarray


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of all bytes, true for those in the ranges (both ends included)."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


def runs(data: np.ndarray, places: np.ndarray, separator: np.ndarray) -> Runs:
    """Runs of the texts that begin and end at ``places`` of ``data``."""
    data = np.ascontiguousarray(data)
    kept = ~separator[data]
    begins, ends = kept.copy(), kept.copy()
    begins[1:] &= ~kept[:-1]
    ends[:-1] &= ~kept[1:]
    heads = places[:-1][places[:-1] < places[1:]]  # texts with at least one byte
    begins[heads] = kept[heads]
    ends[heads[1:] - 1] = kept[heads[1:] - 1]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, places)
    if not len(starts):
        return Runs(np.zeros(0, np.int32), pa.array([], pa.large_string()), bounds, starts)
    sizes = np.flatnonzero(ends) + 1 - starts
    codes, vocabulary = X.distinct(data[kept], np.cumsum(sizes) - sizes, int(sizes.sum()))
    return Runs(codes, vocabulary, bounds, starts)
