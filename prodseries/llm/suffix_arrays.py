"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes, to a depth.

Only the order of the first ``depth`` bytes matters to a search for repeats of that length, so
doubling stops there, and common prefixes are counted up to it.
"""

from __future__ import annotations

import numpy as np

LANES = 2048


def suffix_array(buf: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first ``depth`` bytes or more, rank of each position).

    Suffixes start in order of their first eight bytes. Each round sorts only the groups that
    are not yet single, by the group of the suffix ``h`` further on, and doubles ``h``; what is
    still equal after ``depth`` bytes keeps one rank.
    """
    n = len(buf)
    key = np.zeros(n, dtype=np.uint64)
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, dtype=np.int64)
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    h = 8
    while h < depth:
        single = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            break
        at = order[open_]
        group = rank[at]
        ahead = at + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 1) + second, kind="stable")
        at, group, second = at[by], group[by], second[by]
        order[open_] = at
        start = np.ones(len(at), dtype=bool)
        start[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        new[open_] = start
        heads = np.flatnonzero(start)
        rank[at] = np.repeat(open_[heads], np.diff(np.append(heads, len(at))))
        h *= 2
    return order, rank


def common_prefixes(buf: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to ``depth``.

    Suffixes of one rank have ``depth`` bytes in common at least. For the others, Kasai's walk
    in text order: a prefix is at most one shorter than that of the position before, as long as
    that position's order was settled. Many lanes walk at once, each over its own stretch.
    """
    n = len(buf)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(n, dtype=np.int64)
    lanes = max(1, min(LANES, n // 16))
    step = -(-n // lanes)
    first = np.arange(lanes) * step
    length = np.zeros(lanes, dtype=np.int64)
    padded = np.concatenate((buf, np.zeros(depth, np.uint8)))
    for t in range(step):
        at = first + t
        live = at < n
        if not live.all():
            first, at, length = first[live], at[live], length[live]
        prev = before[at]
        tied = (prev >= 0) & (rank[at] == rank[prev])
        length = np.where(prev < 0, 0, np.maximum(length - 1, 0))
        grow = np.flatnonzero((prev >= 0) & ~tied & (length < depth))
        while len(grow):
            a, b, k = at[grow], prev[grow], length[grow]
            same = (np.maximum(a, b) + k < n) & (padded[a + k] == padded[b + k])
            grow = grow[same]
            length[grow] += 1
            grow = grow[length[grow] < depth]
        prefix[at] = np.where(tied, depth, length)
        length[tied] = 0
    return prefix[order]


def repeat_classes(buf: np.ndarray, windows: np.ndarray, depth: int) -> np.ndarray:
    """A number for each of the positions ``windows``, equal where ``depth`` bytes are equal."""
    order, rank = suffix_array(buf, depth)
    number = np.cumsum(common_prefixes(buf, order, rank, depth) < depth)
    classes = np.empty(len(buf), dtype=np.int64)
    classes[order] = number
    return classes[windows]
