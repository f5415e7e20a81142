"""Extremes over sliding windows, linear in the rows."""

from __future__ import annotations

from collections import deque

import numpy as np


def sliding_extreme(values: np.ndarray, first: np.ndarray, last: np.ndarray, largest: bool = True) -> np.ndarray:
    """The largest (or smallest) of values[first[i]:last[i]] for windows whose ends never go back; nan for empty ones.

    A queue holds the places that can still become an extreme, best first: each place enters and leaves once.
    """
    sign = 1.0 if largest else -1.0
    signed, out = (sign * values).tolist(), np.full(len(first), np.nan)
    queue: deque[int] = deque()
    taken = 0
    for i, (low, high) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        while taken < high:
            v = signed[taken]
            while queue and signed[queue[-1]] <= v:
                queue.pop()
            queue.append(taken)
            taken += 1
        while queue and queue[0] < low:
            queue.popleft()
        if queue and low < high:
            out[i] = sign * signed[queue[0]]
    return out
