"""Hashing the words of a text with numpy (inside tasks)."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Bytes that are not part of a word become spaces: words of a-z, 0-9 and
#: everything beyond ASCII, or tokens of anything but ASCII white space.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
TOKEN_BYTES = bytes(32 if c == 32 or 9 <= c <= 13 else c for c in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


PIECE = 1 << 20  # bytes hashed at a time, cut between words


class WordHasher:
    """64-bit hashes of all words of a text at once: sums of byte times a
    power of an odd base, taken between word bounds from one running sum."""

    def __init__(self, table: bytes) -> None:
        self.table = table
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        size = max(2 * len(self.powers), n + 1, 1 << 14)
        for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def spaced(self, text: str | None) -> bytes:
        """A-Z lower-cased UTF-8 with a space for each byte outside words."""
        return (text or "").encode("utf-8", "surrogatepass").lower().translate(self.table)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.of(self.spaced(text))

    def of(self, spaced: bytes) -> np.ndarray:
        parts, at = [], 0
        while len(spaced) - at > PIECE:
            cut = spaced.rfind(b" ", at, at + PIECE)
            cut = cut if cut > at else spaced.find(b" ", at + PIECE)
            if cut < 0:
                break
            parts.append(self._piece(spaced[at:cut]))
            at = cut
        parts.append(self._piece(spaced[at:]))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _piece(self, spaced: bytes) -> np.ndarray:
        b = np.frombuffer(spaced, np.uint8)
        if len(self.powers) <= len(b):
            self._grow(len(b))
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = b != 32
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(b * self.powers[:len(b)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(56)))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = h * np.uint64(_BASE) + words[i:i + n]
    return np.unique(mix(h + np.uint64(width)))
