"""Column-wise construction of the sorted suffixes of many short strings.

One symbol of every string is inserted in each round, from the last column to the first. The
strings stand in the order of their suffixes from the column reached; the symbols in front of
them, in that order, are the Burrows-Wheeler column of the round, and a stable sort by these
symbols is the order of the next. The common prefix of neighbours grows by one where their
symbols agree (the least common prefix of those that stood between them) and is zero where
they differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def columns(symbols: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, order, common): the state after each round.

    ``symbols`` has a row per string; ``group`` numbers families (not decreasing) that are
    sorted apart from each other. ``order`` lists the strings, ``common[i]`` is the length of
    the common prefix of the suffixes at i - 1 and i (0 at the start of a group).
    """
    n, width = symbols.shape
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    common[1:n] = 0
    # before the first round all suffixes of a group are empty: their common prefix is 0
    for column in range(width - 1, -1, -1):
        key = group[order].astype(np.int64) << 10 | symbols[order, column]
        by = np.argsort(key, kind="stable")
        sorted_key = key[by]
        same = np.flatnonzero(sorted_key[1:] == sorted_key[:-1]) + 1
        before, here = by[same - 1], by[same]
        least = common[here]
        apart = np.flatnonzero(here > before + 1)  # others stood between them
        if len(apart):
            bounds = np.column_stack([before[apart] + 1, here[apart] + 1]).ravel()
            least = least.copy()
            least[apart] = np.minimum.reduceat(common, bounds)[::2]
        new = np.zeros(n + 1, np.int32)
        new[same] = least + 1
        order, common = order[by], new
        yield column, order, common[:n]


def repeated_windows(symbols: np.ndarray, group: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """A bit mask per string: bit c if its window at column c also stands there in a string of the
    same group with a smaller ``doc``."""
    n, width = symbols.shape
    masks = np.zeros(n, np.uint64)
    for column, order, common in columns(symbols, group):
        if n and column + window <= width:
            starts = np.flatnonzero(common < window)  # runs of equal windows
            owner = doc[order]
            least = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.append(starts, n)))
            masks[order[owner > least]] |= np.uint64(1 << column)
    return masks
