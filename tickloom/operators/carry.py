"""Bars that run over days, day by day: what each day does to the sum of the bar that is open before it.

A bar ends with the tick that brings its sum to the limit and the next one starts at 0, so that all which
a day needs of the days before is the open bar's sum. As a function of that sum, the place of a day's
first closing tick is a step function, and everything after it depends on that place alone: the sum
carried out and the number of bars closed are piecewise constant, but for sums so small that the day
closes no bar, which only grow by the day's total. Such functions compose, piece by piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def next_bar(total: np.ndarray, start: np.ndarray, limit: float) -> np.ndarray:
    """For bars that begin at the ticks of start the first tick after each; beyond the last if a bar stays open.

    total holds 0 and the running sums of the ticks.
    """
    end = np.searchsorted(total[1:], total[start] + limit, "left") + 1
    return np.maximum(end, start + 1)


@dataclass
class CarryMap:
    """Sums carried in, from 0 to below the limit, to sums carried out and bars closed.

    A sum below bounds[0] (or any, without bounds) closes nothing and goes out larger by total; one from
    bounds[k] on, below bounds[k + 1], goes out as outs[k] after counts[k] bars.
    """

    total: float
    bounds: np.ndarray
    outs: np.ndarray
    counts: np.ndarray

    def at(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.bounds, x, "right") - 1
        if not len(self.bounds):
            return x + self.total, np.zeros(len(x), np.int64)
        return np.where(place < 0, x + self.total, self.outs[place]), np.where(place < 0, 0, self.counts[place])

    def then(self, other: CarryMap) -> CarryMap:
        """This run of ticks, and the other one after it."""
        head = self.bounds[0] if len(self.bounds) else np.inf
        later = other.bounds - self.total
        mine = later < head
        out, count = other.at(self.outs)
        bounds = np.concatenate([np.maximum(later[mine], 0), self.bounds])
        return CarryMap(self.total + other.total, *_merged(bounds, np.concatenate([other.outs[mine], out]), np.concatenate([other.counts[mine], self.counts + count])))


def _merged(bounds: np.ndarray, outs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring pieces that say the same as one; of pieces with one bound the last holds."""
    if len(bounds):
        last = np.r_[bounds[1:] != bounds[:-1], True]
        bounds, outs, counts = bounds[last], outs[last], counts[last]
        first = np.r_[True, (outs[1:] != outs[:-1]) | (counts[1:] != counts[:-1])]
        bounds, outs, counts = bounds[first], outs[first], counts[first]
    return bounds, outs, counts


def carry_map(size: np.ndarray, limit: float) -> CarryMap:
    """The map of one run of ticks (size 0 or more).

    The first close is at one of the ticks up to where the running sum reaches the limit; from each of
    them the bars are followed all together, one bar a turn, and paths that have met go on as one.
    """
    total = np.concatenate([[0], np.cumsum(size)]).astype(float)
    n = len(size)
    closers = np.arange(min(n, int(np.searchsorted(total[1:], limit, "left")) + 1))
    bounds = np.maximum(limit - total[closers + 1], 0)  # falls with the tick
    start, counts, outs = closers + 1, np.ones(len(closers), np.int64), np.zeros(len(closers))
    while True:
        different, which = np.unique(start, return_inverse=True)
        nxt = np.full(len(different), n + 1)
        inside = different < n
        nxt[inside] = next_bar(total, different[inside], limit)
        closed = nxt <= n
        if not closed.any():
            break
        counts = counts + closed[which]
        start = np.where(closed, nxt, different)[which]
    outs = total[-1] - total[start]
    return CarryMap(float(total[-1]), *_merged(bounds[::-1], outs[::-1], counts[::-1]))


def first_passages(run: np.ndarray, limit: np.ndarray | float, total: np.ndarray | None = None, cap: float = np.inf) -> np.ndarray:
    """Bar numbers of ticks whose bars end where the running sum has gone limit away from where they began.

    run and total are running sums; a bar also ends where total has grown by cap. limit may differ by tick.
    The end of a bar is searched in stretches that double, so that each tick is looked at a few times in
    bulk; where bars are short, the ends of all starts of a stretch are found at once.
    """
    n, ends, at = len(run), [], 0
    limits = np.broadcast_to(np.asarray(limit, float), n)
    before = np.concatenate([[0], run[:-1]]) if n else run
    grown = np.concatenate([[0], total[:-1]]) if total is not None and n else None
    near, base, stop, short = [], 0, 0, 0
    while at < n:
        if at >= stop and short >= 4:  # bars are short here: the ends of all starts of a stretch at once
            base, stop = at, min(at + STRETCH, n)
            near = _near_ends(run, before, limits, total, grown, cap, base, stop)
            short = 0
        found = near[at - base] if at < stop else -1
        if found < 0:
            low = at + NEAR if at < stop else at
            found = _far_end(run, before[at], limits, low, _cap_end(total, grown, cap, at))
        if found < 0:
            break
        short += found - at < NEAR
        ends.append(found)
        at = found + 1
    marks = np.zeros(n + 1, np.int64)
    marks[np.array(ends, np.int64) + 1] = 1
    return np.cumsum(marks)[:n]


NEAR, STRETCH = 32, 4096


def _cap_end(total: np.ndarray | None, grown: np.ndarray | None, cap: float, at: int) -> int | None:
    """The tick at which total has grown by cap since before tick at."""
    if grown is None or cap == np.inf:
        return None
    end = max(at, int(np.searchsorted(total, grown[at] + cap, "left")))
    return end if end < len(total) else None


def _far_end(run: np.ndarray, origin: float, limits: np.ndarray, low: int, cap_end: int | None) -> int:
    """The first tick from low on that is its limit away from origin, or cap_end before it; -1 without any."""
    last, width = len(run) if cap_end is None else cap_end + 1, NEAR
    while low < last:
        high = min(low + width, last)
        hit = np.abs(run[low:high] - origin) >= limits[low:high]
        k = int(hit.argmax())
        if hit[k]:
            return low + k
        low, width = high, width * 2
    return -1 if cap_end is None else cap_end


def _near_ends(run, before, limits, total, grown, cap, at: int, stop: int) -> list[int]:
    """For bars that begin at each tick of [at, stop) their last tick, -1 if it is not among the next NEAR."""
    n = len(run)
    place = np.arange(at, stop)[:, None] + np.arange(NEAR)
    real = place < n
    place = np.minimum(place, n - 1)
    hit = np.abs(run[place] - before[at:stop, None]) >= limits[place]
    if grown is not None:
        hit |= total[place] - grown[at:stop, None] >= cap
    hit &= real
    k = hit.argmax(axis=1)
    return np.where(hit[np.arange(stop - at), k], np.arange(at, stop) + k, -1).tolist()
