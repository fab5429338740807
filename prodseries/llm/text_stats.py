"""Counts and ratios of whole texts, with numpy inside tasks."""

from __future__ import annotations

import numpy as np

from prodseries.llm.hashing import SPACE, mixed, spans_hash, word_spans

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = [
    "log_words", "mean_word", "symbols", "upper", "digits", "marks", "dup_lines", "repeat_words", "distinct_words", "top_word",
]


def equal_earlier(hashes: np.ndarray) -> int:
    return len(hashes) - len(np.unique(hashes))


def text_stats(text: str | None) -> tuple[list[int], list[float]]:
    """COUNTS and RATIOS of one text; null and empty texts have zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    buf = np.frombuffer(data + b"\n", dtype=np.uint8)
    starts, ends = word_spans(buf)
    n = len(starts)
    if not n:
        return [0, 0, 0, 0, 0], [0.0] * len(RATIOS)
    tally = np.bincount(buf, minlength=256)
    chars = int(tally.sum() - tally[128:192].sum() - tally[SPACE].sum())
    symbols = int(tally[SYMBOLS].sum())
    words = spans_hash(buf, starts, ends)

    breaks = np.flatnonzero(buf == 10)
    at = np.concatenate(([0], breaks + 1))[:-1]
    first = np.searchsorted(starts, at)
    filled = np.append(first[1:], n) > first
    n_lines = int(filled.sum())
    dup_lines = equal_earlier(spans_hash(buf, at[filled], breaks[filled])) if n_lines > 1 else 0

    repeats = 0
    if n > 3:
        grams = mixed(mixed(words[:-2] + words[1:-1] * np.uint64(3)) + words[2:] * np.uint64(5))
        _, back, times = np.unique(grams, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[back] > 1)
        inside = np.zeros(n, dtype=bool)
        for j in range(3):
            inside[again + j] = True
        repeats = int(inside.sum())
    _, times = np.unique(words, return_counts=True)
    solid = max(chars, 1)
    letters = max(int(tally[_LETTER].sum()), 1)
    digits = int(tally[_DIGIT].sum())
    marks = int(tally[33:128].sum() - tally[_LETTER & (np.arange(256) < 128)].sum() - digits)
    return [n, chars, symbols, dup_lines, repeats], [
        float(np.log1p(n)), chars / n, symbols / solid, int(tally[_UPPER].sum()) / letters, digits / solid, marks / solid,
        dup_lines / max(n_lines, 1), repeats / n, len(times) / n, float(times.max()) / n,
    ]
