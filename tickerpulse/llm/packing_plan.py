"""Bin packing of a length histogram: configuration LP, priced by a knapsack.

A configuration is a multiset of lengths that fits a sequence. The LP takes
the least number of configurations that covers the histogram; its dual puts a
price on each length so that no configuration is worth more than one sequence.
It is solved by multiplicative weights twice over, and the better plan is taken.

First by single configurations: each round prices a length by its size and by
how little it is covered yet, the knapsack dynamic programme over the capacity
finds the configuration worth most, it is taken by a fraction of what it could
serve, and the prices of its lengths fall. Full configurations are taken by
whole numbers, best fit packs the rest. Where that meets the lower bound (the
sum of the sizes) it is the least number there can be.

Else in passes, for histograms whose sequences cannot all be filled. A pass
covers everything at given prices: one programme gives for each length the best
configuration that holds it; those within ``NEAR`` of the best are taken, full
or not, for ``PART`` of what they can serve, and the programme is solved anew
for what is left. A length whose sequences kept room has paid more than its
size, and its price is multiplied by that, so that it is placed earlier in the
next pass. The work depends on the histogram, not on the number of pieces.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np


LONG_FIRST, SPREAD = 1.05, 0.1
#: Configurations taken may be worth this much less than the best, by share.
NEAR = 0.0003
#: Share of what a configuration can serve that is taken at once.
PART = 0.8
#: Part of a pass in the prices of the next one.
STEP = 0.25


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` with ranks ``first`` to ``last`` (exclusive), ``per`` of them
    in each of the sequences from ``sequence`` on, placed from ``offset``."""

    length: int
    first: int
    last: int
    per: int
    sequence: int
    offset: int


def _table(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each room: the most it can be worth, the index of a length to put there first (or -1), and the room used then."""
    best, first, used = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")  # sizes ascend
    for c in range(1, capacity + 1):
        best[c], first[c], used[c] = best[c - 1], first[c - 1], used[c - 1]
        if fits[c]:
            value = best[c - sizes[:fits[c]]] + prices[:fits[c]]
            i = int(value.argmax())
            if value[i] > best[c]:
                best[c], first[c], used[c] = value[i], i, c
    return best, first, used


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Index -> copies of the most valuable multiset whose sizes sum to at most ``capacity``."""
    _, first, used = _table(sizes, prices, capacity)
    out: dict[int, int] = {}
    c = capacity
    while first[c] >= 0:
        i = int(first[c])
        out[i] = out.get(i, 0) + 1
        c = int(used[c] - sizes[i])
    return out


def _longest(sizes: list[int], left: list[int], chosen: dict[int, int], room: int) -> int:
    """Index of the longest length within ``room`` of which a piece is left, or -1."""
    k = bisect_right(sizes, room) - 1
    while k >= 0 and chosen.get(k, 0) >= left[k]:
        k -= 1
    return k


def _configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, part: float = 0.5,
                    eta: float = 1.0) -> list[tuple[dict[int, int], float]]:
    """(configuration, fractional number) by multiplicative weights."""
    covered, out = np.zeros(len(sizes)), []
    for _ in range(rounds):
        left = counts * (1 - covered)
        open_ = np.flatnonzero(left >= 1)
        if not len(open_):
            break
        weight = np.exp(-eta * covered[open_])
        # near the sizes, which are a feasible dual; long pieces first, since short ones fill any gap later
        prices = (sizes[open_] / capacity) ** LONG_FIRST * (1 + SPREAD * (weight - 0.5))
        chosen = {int(open_[i]): n for i, n in knapsack(sizes[open_], prices, capacity).items()}
        most = min(left[i] / n for i, n in chosen.items())
        amount = most if most < 4 else part * most
        for i, n in chosen.items():
            covered[i] += amount * n / counts[i]
        out.append((chosen, amount))
    return out


def _cover(sizes: np.ndarray, counts: np.ndarray, capacity: int, prices: np.ndarray) -> tuple[list[tuple[dict[int, int], int]], float]:
    """(configuration, times) that cover ``counts``, and what all pieces are worth in sequences: no packing needs fewer."""
    left, out, worth = counts.copy(), [], 0.0
    alive, fill = np.arange(len(sizes)), False
    while len(alive):
        s, y = sizes[alive], prices[alive]
        best, first, used = _table(s, y, capacity)
        worth = worth or float(counts @ prices / best[capacity])
        through = y + best[capacity - s]
        ss, have, first, used, before = s.tolist(), left[alive].tolist(), first.tolist(), used.tolist(), len(out)
        for i in np.flatnonzero(through >= (1 - NEAR) * through.max())[::-1].tolist():
            if have[i] <= 0:
                continue
            chosen, room = {i: 1}, capacity - ss[i]
            while first[room] >= 0:
                j = first[room]
                if chosen.get(j, 0) < have[j]:
                    room = used[room] - ss[j]
                elif fill and (j := _longest(ss, have, chosen, room)) >= 0:
                    room -= ss[j]  # too few are left for any best configuration: the longest that fits instead
                else:
                    break
                chosen[j] = chosen.get(j, 0) + 1
            if not fill and first[room] >= 0:
                continue  # used up meanwhile: the next programme knows
            times = min(have[j] // n for j, n in chosen.items())
            if times > 4:
                times = int(PART * times)
            for j, n in chosen.items():
                have[j] -= n * times
            out.append(({int(alive[j]): n for j, n in chosen.items()}, times))
        fill = len(out) == before
        left[alive] = have
        alive = alive[left[alive] > 0]
    return out, worth


def _best_fit(sizes: list[int], left: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) that cover ``left``: the longest that still fits, equal sequences at once."""
    alive, out = [i for i in range(len(sizes)) if left[i] > 0], []
    while alive:
        ss, have = [sizes[i] for i in alive], [left[i] for i in alive]
        chosen, room = {}, capacity
        while (k := _longest(ss, have, chosen, room)) >= 0:
            chosen[k] = chosen.get(k, 0) + 1
            room -= ss[k]
        times = min(have[k] // n for k, n in chosen.items())
        out.append(({alive[k]: n for k, n in chosen.items()}, times))
        for k, n in chosen.items():
            left[alive[k]] -= n * times
        alive = [i for i in alive if left[i] > 0]
    return out


def _by_size(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configuration, times) that cover ``counts`` and how many of them are not by best fit."""
    left, out = counts.copy(), []
    for chosen, amount in _configurations(sizes, counts.astype(float), capacity, rounds):
        times = min(int(amount), min(int(left[i]) // n for i, n in chosen.items()))
        if times > 0 and sum(int(sizes[i]) * n for i, n in chosen.items()) == capacity:
            out.append((chosen, times))
            for i, n in chosen.items():
                left[i] -= n * times
    return out + _best_fit(sizes.tolist(), left.tolist(), capacity), len(out)


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, passes: int) -> tuple[list[tuple[dict[int, int], int]], int, float]:
    """The best plan as (configuration, times), how many of these the LP gave, and a lower bound on the sequences."""
    found, own = _by_size(sizes, counts, capacity, rounds)
    total = sum(times for _, times in found)
    least = float(-(-int(sizes @ counts) // capacity))
    prices = (sizes / capacity) ** LONG_FIRST
    for _ in range(passes):
        if total <= np.ceil(least - 1e-6):
            break
        taken, worth = _cover(sizes, counts, capacity, prices)
        least = max(least, worth)
        n = sum(times for _, times in taken)
        if n < total:
            found, own, total = taken, len(taken), n
        paid = np.zeros(len(sizes))  # what a piece took of its sequences on average, empty room shared by size
        for chosen, times in taken:
            filled = sum(int(sizes[i]) * k for i, k in chosen.items())
            for i, k in chosen.items():
                paid[i] += times * k * int(sizes[i]) / filled
        prices = prices ** (1 - STEP) * (paid / counts) ** STEP
    return found, own, least


def plan(histogram: dict[int, int], capacity: int, rounds: int = 150, passes: int = 4) -> tuple[list[Run], int]:
    """Runs that place every piece, and the number of sequences."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    if not len(lengths):
        return [], 0
    if lengths[0] < 1 or lengths[-1] > capacity:
        raise ValueError("a piece is empty or longer than a sequence")
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    used = np.zeros(len(lengths), np.int64)
    runs: list[Run] = []
    sequences = 0
    for chosen, times in solve(lengths, counts, capacity, rounds, passes)[0]:
        offset = 0
        for i in sorted(chosen, reverse=True):
            n = chosen[i]
            runs.append(Run(int(lengths[i]), int(used[i]), int(used[i] + n * times), n, sequences, offset))
            used[i] += n * times
            offset += n * int(lengths[i])
        sequences += times
    return runs, sequences
