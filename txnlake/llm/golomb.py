"""Golomb-Rice coding of sorted 64-bit fingerprints (numpy, inside tasks)."""

from __future__ import annotations

import struct

import numpy as np


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted uint64 values -> bytes: gaps as a unary quotient stream and a
    fixed-width remainder stream, the width fitted to the mean gap."""
    n = len(values)
    if n == 0:
        return struct.pack("<IB", 0, 0)
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    # The first value may be huge next to the gaps: it is stored plainly.
    first, gaps = int(values[0]), gaps[1:]
    mean = int(gaps.astype(np.float64).mean()) if n > 1 else 0
    k = max(0, mean.bit_length() - 1)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ones = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if n > 1 else 0, np.uint8)
    unary[ones] = 1
    low = np.empty((n - 1, k), np.uint8)
    for bit in range(k):
        low[:, bit] = (gaps >> np.uint64(bit)).astype(np.uint8) & 1
    head = struct.pack("<IBQI", n, k, first, len(unary))
    return head + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def rice_decode(data: bytes) -> np.ndarray:
    n, k = struct.unpack_from("<IB", data)
    if n == 0:
        return np.empty(0, np.uint64)
    first, n_unary = struct.unpack_from("<QI", data, 5)
    at = 17
    end = at + (n_unary + 7) // 8
    raw = np.frombuffer(data, np.uint8)
    ones = np.flatnonzero(np.unpackbits(raw[at:end], count=n_unary))
    quotient = np.diff(ones, prepend=-1) - 1
    gaps = quotient.astype(np.uint64) << np.uint64(k)
    if k and n > 1:
        low = np.unpackbits(raw[end:], count=(n - 1) * k).reshape(n - 1, k)
        for bit in range(k):
            gaps |= low[:, bit].astype(np.uint64) << np.uint64(bit)
    out = np.empty(n, np.uint64)
    out[0] = first
    out[1:] = gaps
    return np.cumsum(out, dtype=np.uint64)
