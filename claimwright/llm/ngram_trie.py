"""An n-gram trie in Elias-Fano levels, for sorted arrays of fingerprints.

Level one holds the contexts, level two the successors of each context, addressed by monotone
pointers. Successors are keyed relative to their context: the context's number in the high half
and the successor's fingerprint in the low half make one rising sequence, and a query is a search
for the next value not below its key, inside the range of its context. Probabilities are stored
in one byte.
"""

from __future__ import annotations

import tempfile

import numpy as np

NOTHING = 255  # the code of an absent probability
STEP = 1 / 30  # of the decimal logarithm, between neighbouring codes
LEVELS = 10.0 ** (-STEP * np.arange(256))
LEVELS[NOTHING] = 0.0


def quantised(probabilities: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        codes = np.rint(-np.log10(probabilities) / STEP)
    return np.where(probabilities > 0, np.clip(codes, 0, NOTHING - 1), NOTHING).astype(np.uint8)


class EliasFano:
    """A rising sequence of unsigned 64-bit values in about two bits each plus their low bits."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        universe = int(values[-1]) + 1 if self.size else 1
        self.low_bits = max(0, (universe // max(1, self.size)).bit_length() - 1)
        shift = np.uint64(self.low_bits)
        low = values & np.uint64((1 << self.low_bits) - 1)
        high = (values >> shift).astype(np.int64)
        ones = high + np.arange(self.size)
        bits = np.zeros((int(ones[-1]) // 64 + 2) * 64 if self.size else 64, np.uint8)
        bits[ones] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        kind = np.uint32 if self.low_bits <= 32 else np.uint64
        self.low, self.words, self.before = low.astype(kind), words, before

    def arrays(self) -> list[str]:
        return ["low", "words", "before"]

    @staticmethod
    def _nth(words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Place of the n-th set bit (from 0) of each word, by halving."""
        place, rest = np.zeros(len(n), np.int64), n.copy()
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(words & np.uint64((1 << width) - 1)).astype(np.int64)
            beyond = rest >= count
            rest = np.where(beyond, rest - count, rest)
            place = np.where(beyond, place + width, place)
            words = np.where(beyond, words >> np.uint64(width), words)
        return place

    def _select(self, n: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the n-th one or zero of the upper bits; past the end where there is none."""
        ahead = self.before if ones else 64 * np.arange(len(self.before)) - self.before
        word = np.searchsorted(ahead, n, side="right") - 1
        inside = np.minimum(word, len(self.words) - 1)
        chosen = self.words[inside] if ones else ~self.words[inside]
        return np.where(word < len(self.words), 64 * inside + self._nth(chosen, n - ahead[inside]), 64 * len(self.words))

    def at(self, places: np.ndarray) -> np.ndarray:
        high = (self._select(places, True) - places).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self.low[places]

    def next_from(self, keys: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
        """First place in [first, last) whose value is not below the key, else last."""
        last = self.size if last is None else last
        high = (keys >> np.uint64(self.low_bits)).astype(np.int64)
        # values below a bucket end at the zero that closes the bucket before it
        end = np.minimum(self._select(high, False) - high, self.size)
        start = np.where(high > 0, np.minimum(self._select(np.maximum(high - 1, 0), False) - np.maximum(high - 1, 0), self.size), 0)
        low, up = np.clip(start, first, last), np.clip(end, first, last)
        wanted = (keys & np.uint64((1 << self.low_bits) - 1)).astype(self.low.dtype)
        active = np.flatnonzero(low < up)
        while len(active):
            middle = (low[active] + up[active]) // 2
            below = self.low[middle] < wanted[active]
            low[active] = np.where(below, middle + 1, low[active])
            up[active] = np.where(below, up[active], middle)
            active = active[low[active] < up[active]]
        return low

    def find(self, keys: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | int | None = None) -> np.ndarray:
        """Place of each key in its range, -1 where it is absent."""
        if not self.size:
            return np.full(len(keys), -1)
        places = self.next_from(keys, first, last)
        inside = places < (self.size if last is None else last)
        equal = np.zeros(len(keys), bool)
        equal[inside] = self.at(places[inside]) == keys[inside]
        return np.where(equal, places, -1)


class Trie:
    """Counts of words and smoothed probabilities of their successors.

    ``contexts`` are sorted fingerprints with the count of each as a token; ``keys`` are the
    sorted successor keys with their counts. The probability of a successor is discounted by
    ``discount``; what a context keeps for unseen successors is its ``rest``.
    """

    def __init__(self, contexts: np.ndarray, tokens: np.ndarray, keys: np.ndarray, counts: np.ndarray, discount: float) -> None:
        owner = (keys >> np.uint64(32)).astype(np.int64)
        total = np.bincount(owner, counts, len(contexts))
        kinds = np.bincount(owner, minlength=len(contexts))
        self.contexts, self.successors = EliasFano(contexts), EliasFano(keys)
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(kinds)]).astype(np.uint64))
        self.tokens = tokens.astype(np.int64)
        self.seen = quantised((counts - discount) / total[owner])
        self.rest = quantised(np.divide(discount * kinds, total, out=np.zeros(len(contexts)), where=total > 0))
        self._to_disk()

    def _to_disk(self) -> None:
        """Moves the levels to an unnamed temporary file and maps it; it goes with the trie."""
        parts = [(owner, name) for owner in (self.contexts, self.successors, self.pointers) for name in owner.arrays()]
        parts += [(self, name) for name in ("tokens", "seen", "rest")]
        self.file = tempfile.TemporaryFile()
        for owner, name in parts:
            values = getattr(owner, name)
            if values.nbytes:
                self.file.seek(0, 2)
                at = -(-self.file.tell() // 8) * 8
                self.file.seek(at)
                self.file.write(values.tobytes())
                self.file.flush()
                setattr(owner, name, np.memmap(self.file, values.dtype, "r", at, values.shape))

    def query(self, contexts: np.ndarray, lengths: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token count and rest code of each context, and the code of each of its successors in turn."""
        places = self.contexts.find(contexts)
        known = places >= 0
        tokens, rest = np.zeros(len(contexts), np.int64), np.full(len(contexts), NOTHING, np.uint8)
        tokens[known], rest[known] = self.tokens[places[known]], self.rest[places[known]]
        owner = np.repeat(places, lengths)
        codes = np.full(len(successors), NOTHING, np.uint8)
        asked = np.flatnonzero(owner >= 0)
        owner = owner[asked]
        first, last = self.pointers.at(owner).astype(np.int64), self.pointers.at(owner + 1).astype(np.int64)
        keys = (owner.astype(np.uint64) << np.uint64(32)) | successors[asked].astype(np.uint64)
        found = self.successors.find(keys, first, last)
        codes[asked[found >= 0]] = self.seen[found[found >= 0]]
        return tokens, rest, codes
