"""The best entries per key inside a task, by (score descending, id ascending), ties never dropped by arrival."""

from __future__ import annotations

import numpy as np


def first_of_each(keys: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first ``k`` places of every run of equal keys."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.zeros(0, int)
    lengths = np.diff(starts, append=len(keys))
    return np.arange(len(keys)) - np.repeat(starts, lengths) < k


class Best:
    """Up to ``k`` best entries for each of ``n_keys`` keys. An entry is a score, an id that may be null, which then
    comes last among equal scores, and a row number. ``floor`` holds what a score must reach to enter."""

    def __init__(self, n_keys: int, k: int, dtype):
        self.k, self.dtype = k, dtype
        self.parts: list[tuple] = []
        self.entries = self._empty()
        self.floor = np.full(n_keys, -np.inf)

    def _empty(self) -> tuple:
        return np.empty(0, np.int64), np.empty(0, self.dtype), np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, keys: np.ndarray, scores: np.ndarray, null: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(keys):
            self.parts.append((keys, scores, null, ids, rows))

    def settle(self) -> None:
        """Take the entries offered since the last call into account."""
        if not self.parts:
            return
        keys, scores, null, ids, rows = (np.concatenate(x) for x in zip(self.entries, *self.parts))
        order = np.lexsort((rows, ids, null, -scores, keys))
        order = order[first_of_each(keys[order], self.k)]
        self.entries = tuple(x[order] for x in (keys, scores, null, ids, rows))
        self.parts = []
        keys, scores = self.entries[:2]
        full = np.bincount(keys, minlength=len(self.floor)) == self.k
        ends = np.flatnonzero(np.diff(keys, append=-1))  # the last, hence worst, entry of each key
        self.floor[keys[ends]] = np.where(full[keys[ends]], scores[ends], -np.inf)
