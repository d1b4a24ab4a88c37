"""The lattice of a vocabulary's pieces over many words at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
SLOT_BITS = 20


class Lattice:
    """Piece lookups for all substrings of equally long words, by rolling hashes."""

    LONGEST = 48  # characters of a word

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        if len(np.unique(self.hashes)) < len(pieces):
            raise ValueError("two pieces with one hash")
        # Slots by the top bits of a hash; pieces that share a slot go to the next table.
        self.tables, left = [], np.arange(len(pieces))
        while len(left):
            table = np.full(1 << SLOT_BITS, -1, np.int32)
            slots = self._slots(self.hashes[left], len(self.tables))
            table[slots] = left
            self.tables.append(table)
            left = left[table[slots] != left]
        with np.errstate(over="ignore"):
            most = max(self.LONGEST, self.longest) + 1
            self.power = np.cumprod(np.insert(np.repeat(_BASE, most), 0, np.uint64(1)))

    @staticmethod
    def _slots(hashes: np.ndarray, level: int) -> np.ndarray:
        mixer = np.uint64((int(_BASE) * (2 * level + 1)) & 0xFFFFFFFFFFFFFFFF)
        with np.errstate(over="ignore"):
            return ((hashes * mixer) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, ``len(pieces)`` where there is none."""
        found = self.tables[0][self._slots(hashes, 0)]
        # An empty slot ends it; few hashes meet a slot that another piece has.
        at = np.flatnonzero(found >= 0)
        out = np.full(len(hashes), len(self.pieces), np.int64)
        for level in range(len(self.tables)):
            if level:
                found[at] = self.tables[level][self._slots(hashes[at], level)]
                at = at[found[at] >= 0]
            same = self.hashes[found[at]] == hashes[at]
            out[at[same]] = found[at[same]]
            at = at[~same]
            if not len(at):
                break
        return out

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def factors(self, word: str) -> list[str]:
        """A word cut wherever no piece crosses: every segmentation passes there.

        The product over the factors is the sum over all segmentations of the word.
        """
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(codes)
        crossing = np.zeros(n + 1, np.int64)
        hashes = codes
        for length in range(2, min(self.longest, n) + 1):
            with np.errstate(over="ignore"):
                hashes = hashes[:-1] * _BASE + codes[length - 1:]
            starts = np.flatnonzero(self.find(hashes) < len(self.pieces))
            crossing[starts + 1] += 1
            crossing[starts + length] -= 1
        free = np.flatnonzero(np.cumsum(crossing)[1:n] == 0) + 1
        edges = [0, *free.tolist(), n]
        return [word[a:b] for a, b in zip(edges, edges[1:])]

    def arcs(self, words: list[str]) -> dict[tuple[int, int], np.ndarray]:
        """(start, end) -> piece per word, ``len(pieces)`` where there is none."""
        n, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, size).astype(np.uint64)
        prefix = np.zeros((n, size + 1), np.uint64)
        out = {}
        with np.errstate(over="ignore"):
            for i in range(size):
                prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i] + np.uint64(1)
            for end in range(1, size + 1):
                for start in range(max(0, end - self.longest), end):
                    h = prefix[:, end] - prefix[:, start] * self.power[end - start]
                    found = self.find(h)
                    if (found < len(self.pieces)).any():
                        out[start, end] = found
        return out
