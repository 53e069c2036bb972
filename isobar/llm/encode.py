"""Token ids of whole texts from the public tokenizer files, each distinct piece encoded once per worker."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash
from tokenizers import Tokenizer

from . import text as X

#: Pieces whose ids a worker remembers (about 30 bytes each); beyond it the memory starts anew.
REMEMBERED = 2_000_000
#: New pieces encoded in one call; what the library makes of a piece takes far more room than its ids.
AT_ONCE = 20_000


class Encoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    ``whole_words`` is for tokenizers that drop white space: pieces are the words between it.
    Otherwise white space belongs to the piece that it leads.  Known pieces are found by a
    128-bit hash, kept in sorted arrays.
    """

    _made: dict[tuple, Encoder] = {}

    def __init__(self, path: str, whole_words: bool, remembered: int = REMEMBERED) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut = X.words if whole_words else X.segments
        self.remembered = remembered
        self.forget()

    @classmethod
    def of(cls, path: str, whole_words: bool) -> Encoder:
        """One encoder for each file in a worker process."""
        key = (path, whole_words)
        if key not in cls._made:
            cls._made[key] = cls(path, whole_words)
        return cls._made[key]

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # first half of each key, sorted
        self.others = np.zeros(0, np.uint64)  # second half
        self.at = np.zeros(0, np.uint32)  # place of each key in starts
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each piece, and the ids one after another."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for first in range(0, len(pieces), AT_ONCE):
            texts = [piece.decode() for piece in pieces[first : first + AT_ONCE]]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(sizes), np.concatenate(ids)

    def numbers(self, vocabulary: list[bytes]) -> np.ndarray:
        """The place of each piece in ``starts``; new pieces are encoded."""
        if len(self.at) > self.remembered:
            self.forget()
        halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, vocabulary)), "<u8").reshape(-1, 2)
        keys, others = halves[:, 0].copy(), halves[:, 1].copy()
        order = np.argsort(keys)  # neighbouring searches touch neighbouring keys
        found = np.empty(len(keys), np.int64)
        found[order] = np.searchsorted(self.keys, keys[order])
        inside = np.minimum(found, max(len(self.at) - 1, 0))
        new = (self.keys[inside] != keys) | (self.others[inside] != others) if len(self.at) else np.ones(len(keys), bool)
        out = np.zeros(len(keys), np.int64)
        out[~new] = self.at[inside[~new]]
        fresh = np.flatnonzero(new)
        if len(fresh):
            sizes, ids = self._encoded([vocabulary[i] for i in fresh.tolist()])
            out[fresh] = np.arange(len(fresh)) + len(self.starts) - 1
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
            order = order[new[order]]
            places = found[order]
            self.keys = np.insert(self.keys, places, keys[order])
            self.others = np.insert(self.others, places, others[order])
            self.at = np.insert(self.at, places, out[order].astype(np.uint32))
        return out

    def encode(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (uint32), and the n + 1 places where texts begin and end."""
        pieces = self.cut(data, places)
        numbers = self.numbers(pieces.vocabulary)[pieces.codes]
        starts, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[X.gather(starts, sizes)], ends[pieces.bounds]

    def counts(self, vocabulary: list[str]) -> np.ndarray:
        """The number of ids of each piece, without remembering any."""
        encoded = self.tokenizer.encode_batch_fast(vocabulary, add_special_tokens=False)
        return np.fromiter(map(len, encoded), np.int64, len(encoded))


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer file is, as a default for the paths that operators take."""
    import public_tokenizers

    return public_tokenizers.path(name)
