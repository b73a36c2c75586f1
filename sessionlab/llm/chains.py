"""Sequences of different lengths side by side, for recursions that run along them."""

from __future__ import annotations

import numpy as np


class SideBySide:
    """Lays sequences out step by step, the longest first.

    ``steps`` lists the slice of every step; the items of a slice are that step's items of all
    sequences that reach it, so the first ``k`` sequences of one step are those of the next.
    ``place`` maps items in the order of the sequences to this layout.
    """

    def __init__(self, lengths: np.ndarray) -> None:
        lengths = np.asarray(lengths, np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        longest = int(lengths.max(initial=0))
        reach = np.bincount(lengths, minlength=longest + 1)
        active = len(lengths) - np.cumsum(reach)[:longest]
        starts = np.cumsum(active) - active
        self.steps = [slice(a, a + n) for a, n in zip(starts.tolist(), active.tolist())]
        self.first = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(self.first, lengths)
        self.place = starts[step] + np.repeat(rank, lengths) if len(step) else step
