"""Rabin-Karp fingerprints of word n-grams with numpy (inside tasks).

Both levels hash by prefix polynomials modulo 2 ** 64: the running sum of
``value * base ** position`` turns the hash of any stretch into one
difference and one multiplication with the inverse power of its start. Bytes
make words, scrambled words make n-grams. Two odd bases give a 64-bit
fingerprint and an independent 32-bit check value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .tokens import mix

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SLICE = 1 << 18  # bytes hashed at a time, cut between words

_WORD, _SPACE, _BREAK = 0, 1, 2


def byte_classes(spaces: bytes, breaks: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(spaces)] = _SPACE
    table[list(breaks)] = _BREAK
    return table


class Prefix:
    """Prefix polynomials of one base, with powers grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.powers) <= n:
            size = max(2 * len(self.powers), n + 1, 1 << 14)
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverses[start]


class Words:
    """Word bounds, hashes, pieces and documents of one slice of bytes."""

    def __init__(self, data: bytes, classes: np.ndarray, polynomials: list[Prefix],
                 doc_starts: list[int], docs: list[int], skip: int) -> None:
        self.data, self.polynomials, self.skip = data, polynomials, skip
        b = np.frombuffer(data, np.uint8)
        kind = classes[b]
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = kind == _WORD
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int64)[self.start] if len(self.start) else np.zeros(0, np.int64)
        at = np.asarray(doc_starts, np.int64)
        self.doc = np.asarray(docs, np.int64)[np.searchsorted(at, self.start, "right") - 1] if len(at) else np.zeros(0, np.int64)
        values = b.astype(np.uint64) + np.uint64(1)
        length = (self.end - self.start).astype(np.uint64)
        self.sums = [p.sums(mix(p.stretch(p.sums(values), self.start, self.end) + length * np.uint64(p.base)))
                     for p in polynomials]

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, n: int, seeds: tuple[np.ndarray, np.ndarray], bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, check) of the n words from each position on; seeds per document."""
        m = max(0, len(self) - n + 1)
        at = np.arange(m)
        doc = self.doc[:m]
        full = [mix(p.stretch(s, at, at + n) ^ mix(seed + np.uint64(n))[doc]) for p, s, seed in zip(self.polynomials, self.sums, seeds)]
        return full[0] >> np.uint64(64 - bits), full[1] >> np.uint64(32)

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each position on lie in one piece and are not all carried over."""
        m = max(0, len(self) - n + 1)
        ok = self.piece[:m] == self.piece[len(self) - m:]
        ok[:max(0, min(m, self.skip - n + 1))] = False
        return ok

    def text(self, at: int, n: int) -> str:
        return b" ".join(self.data[s:e] for s, e in zip(self.start[at:at + n], self.end[at:at + n])).decode("utf-8", "surrogatepass")


class Slicer:
    """Slices of some ``SLICE`` bytes of many short texts, or parts of a long
    one. A part repeats the last ``overlap`` words of the part before it, so
    every n-gram of up to overlap + 1 words is whole in exactly one slice."""

    def __init__(self, spaces: bytes, breaks: bytes, overlap: int) -> None:
        self.classes = byte_classes(spaces, breaks)
        self.polynomials = [Prefix(b) for b in BASES]
        self.overlap, self.separator = overlap, breaks[:1]

    def _words(self, data: bytes, starts: list[int], docs: list[int], skip: int = 0) -> Words:
        return Words(data, self.classes, self.polynomials, starts, docs, skip)

    def _cut(self, text: bytes, at: int, beyond: int) -> int:
        """The end of a part that starts at ``at``: after the last separator of the
        first slice that has one at or after ``beyond``; else the end of the text."""
        for low in range(at, len(text), SLICE):
            if low + SLICE >= len(text):
                break
            found = np.flatnonzero(self.classes[np.frombuffer(text, np.uint8, SLICE, low)] != _WORD) + low
            if len(found) and found[-1] >= beyond:
                return int(found[-1]) + 1
        return len(text)

    def __call__(self, texts: list[bytes]) -> Iterator[Words]:
        parts, starts, docs, size = [], [], [], 0
        for i, text in enumerate(texts):
            if len(text) > SLICE:
                at, skip, beyond = 0, 0, 0
                while at < len(text):
                    end = self._cut(text, at, beyond)
                    words = self._words(text[at:end], [0], [i], skip)
                    yield words
                    if end == len(text):
                        break
                    skip = min(self.overlap, len(words))
                    at = at + int(words.start[len(words) - skip]) if skip else end
                    beyond = end
                continue
            parts.append(text)
            starts.append(size)
            docs.append(i)
            size += len(text) + 1
            if size > SLICE:
                yield self._words(self.separator.join(parts), starts, docs)
                parts, starts, docs, size = [], [], [], 0
        if parts:
            yield self._words(self.separator.join(parts), starts, docs)
