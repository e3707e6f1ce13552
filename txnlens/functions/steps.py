"""Counts per step of time, as sorted arrays."""

from __future__ import annotations

import numpy as np


def merged(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps in order, each once, with the sum of their counts."""
    steps, inverse = np.unique(at, return_inverse=True)
    return steps, np.bincount(inverse, weights=n, minlength=len(steps)).astype(np.int64)


def fullest(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """For each of some steps in order, the highest count of a window of ``size`` that covers it.

    The fullest window over a step can be taken to start at a step with rows. Running sums count the windows
    from each step; the best of those that reach a step is looked up in maxima over 1, 2, 4, … of them.
    """
    if not len(at):
        return n
    sums = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(len(at))
    from_here = sums[np.searchsorted(at, at + size, "left")] - sums[:-1]
    first = np.searchsorted(at, at - size, "right")
    levels = [from_here]
    while 2 ** len(levels) <= int((place - first).max()) + 1:
        last, span = levels[-1], 2 ** (len(levels) - 1)
        levels.append(np.concatenate((np.maximum(last[span:], last[:-span]), last[len(last) - span :])))
    level = np.floor(np.log2(place - first + 1)).astype(np.int64)
    stacked = np.stack(levels)
    return np.maximum(stacked[level, first], stacked[level, place - 2**level + 1])
