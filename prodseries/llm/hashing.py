"""Vectorised hashes of words and lines in a byte buffer (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240917)
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xC2B2AE3D27D4EB4F
_POWERS: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        steps = np.full(size, base & ((1 << 64) - 1), dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """64-bit hash of each buf[start:end]: equal bytes, equal hash, wherever they stand.
    Another odd ``base`` gives an independent hash."""
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(BYTE[buf] * powers(base, len(buf)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(buf) + 1)[starts]
    return mixed(h + (ends - starts).astype(np.uint64))


def ordered_spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 19) -> np.ndarray:
    """As spans_hash, for spans in ascending order, a stretch of about ``limit`` bytes at a time:
    the working arrays, eight times the bytes and more, stay small however long the buffer is."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, side="right")))
        a, b = starts[i], ends[j - 1]
        out[i:j] = spans_hash(buf[a:b], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs without ASCII white space."""
    edge = np.diff(np.concatenate(([True], SPACE[buf], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one buffer with a line break after each, and where each starts (and the end)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    return buf, starts


def in_slices(texts: list, size_of, limit: int = 1 << 19):
    """Index ranges of consecutive texts of about ``limit`` bytes together; one longer text is
    a range of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        n = size_of(t)
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)
