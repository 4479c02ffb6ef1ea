"""Cutting stock by column generation: which lengths share a sequence, and how often.

Works on a histogram whose size is bounded by the sequence length, so it runs on the
driver however many documents there are.
"""

from __future__ import annotations

import numpy as np


def knapsack(values: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of widths that fits; counts by width index."""
    worth = np.zeros(capacity + 1)
    np.maximum.at(worth, widths, values)
    which = np.zeros(capacity + 1, int)
    which[widths] = np.arange(len(widths))
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, int)  # width placed last, 0: one unit stays empty
    for room in range(1, capacity + 1):
        gains = worth[1:room + 1] + best[room - 1::-1] if room > 1 else worth[1:2] + best[0:1]
        at = int(np.argmax(gains))
        if gains[at] > best[room - 1] + 1e-12:
            best[room], last[room] = gains[at], at + 1
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(len(widths), int), capacity
    while room:
        if last[room]:
            counts[which[last[room]]] += 1
            room -= last[room]
        else:
            room -= 1
    return float(best[capacity]), counts


def column_generation(
    widths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000, gap: float = 5e-4,
) -> tuple[np.ndarray, np.ndarray]:
    """Basic solution of min sum(x), patterns @ x >= demand: patterns by column, and x.

    Revised simplex with an explicit inverse. The knapsack prices columns; it ends when
    the solution is within ``gap`` of a lower bound: the material, or the solution
    divided by the value of the best pattern. ``rounds`` bounds the time; the
    solution is valid at any point, only longer.
    """
    material = float(widths @ demand) / capacity
    rows = len(widths)
    patterns = np.zeros((rows, rows))
    np.fill_diagonal(patterns, capacity // widths)
    inverse = np.diag(1.0 / np.diag(patterns))
    x = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(axis=0)  # every sequence costs one
        value, column = knapsack(np.maximum(prices, 0), widths, capacity)
        if x.sum() <= max(material, x.sum() / max(value, 1.0)) * (1 + gap):
            break
        direction = inverse @ column
        positive = direction > 1e-9
        if not positive.any():
            break
        ratios = np.full(rows, np.inf)
        ratios[positive] = x[positive] / direction[positive]
        leaves = int(np.argmin(ratios))
        step = ratios[leaves]
        patterns[:, leaves] = column
        x = np.maximum(x - step * direction, 0)
        x[leaves] = step
        pivot = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, pivot)
        inverse[leaves] = pivot
    return patterns.astype(int), x


def best_fit(items: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Bins of item indices for (index, width) items, widest first, each into the fullest bin."""
    by_room: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for index, width in sorted(items, key=lambda item: -item[1]):
        room = next((r for r in range(width, capacity + 1) if by_room.get(r)), None)
        if room is None:
            bins.append([])
            at, room = len(bins) - 1, capacity
        else:
            at = by_room[room].pop()
        bins[at].append(index)
        by_room.setdefault(room - width, []).append(at)
    return bins


def plan(widths: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (count by width) and how often each is used; every item is placed once.

    Whole parts of the linear solution are used as they are. The fractional rest holds
    less than one sequence per width and is packed best fit, widest first.
    """
    if not widths:
        return []
    sizes, left = np.asarray(widths, int), np.asarray(demand, int)
    patterns, x = column_generation(sizes, left.astype(float), capacity)
    left = left.copy()
    used: list[tuple[dict[int, int], int]] = []
    for column in np.argsort(-x):
        pattern = patterns[:, column]
        on = np.flatnonzero(pattern)
        times = int(min(np.floor(x[column] + 1e-9), (left[on] // pattern[on]).min())) if len(on) else 0
        if times > 0:
            left -= times * pattern
            used.append(({int(sizes[k]): int(pattern[k]) for k in on}, times))
    # a pattern can have counted more than the demand; what is left over is packed item by item
    items = [(int(k), int(sizes[k])) for k in np.flatnonzero(left) for _ in range(left[k])]
    mixes: dict[tuple, int] = {}
    for members in best_fit(items, capacity):
        kinds, counts = np.unique(sizes[members], return_counts=True)
        key = tuple(zip(kinds.tolist(), counts.tolist()))
        mixes[key] = mixes.get(key, 0) + 1
    return used + [(dict(key), times) for key, times in mixes.items()]
