"""Anchors of texts: sampled positions that equal windows of bytes share.

Every window of ``window`` bytes has one anchor, the start of its gram with the least
hash (the first, on ties). The choice depends on the bytes of the window alone, so equal
windows, wherever they stand, have the same anchor at the same place. An anchor owns the
windows that chose it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from meseta.llm.shingles import mixed

_U64 = np.uint64
_BYTE = np.random.default_rng(20_10).integers(0, 2 ** 63, 256, np.uint64) * _U64(2) + _U64(1)
_BASE = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(_BASE, -1, 2 ** 64)
_PLACE_BITS = 24
SEGMENT = 1 << 21
"""Windows worked on at once; a longer text is cut between windows."""


class Anchors(NamedTuple):
    gram: np.ndarray  # hash of the anchor's gram
    context: np.ndarray  # hash of all bytes of the owned windows
    place: np.ndarray  # of the anchor in the text
    left: np.ndarray  # bytes of the owned windows before the anchor
    right: np.ndarray  # and from it on


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base & (2 ** 64 - 1), _U64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


_cached: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _cached:
        _cached.clear()
        _cached[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _cached[size]


def _segment(data: np.ndarray, window: int, gram: int) -> Anchors:
    n = len(data)
    powers, inverses = _tables(n + 1)
    sums = np.zeros(n + 1, _U64)
    np.cumsum(_BYTE[data] * powers[:n], out=sums[1:])
    grams = mixed((sums[gram:] - sums[:n - gram + 1]) * inverses[:n - gram + 1])
    mask = _U64((1 << _PLACE_BITS) - 1)
    least = (grams & ~mask) | np.arange(len(grams), dtype=_U64)
    wide, span = window - gram + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if wide > span:
        rest = wide - span
        least = np.minimum(least[:-rest], least[rest:])
    chosen = (least & mask).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(chosen)) + 1))
    last = np.concatenate((first[1:], [len(chosen)])) - 1
    place, end = chosen[first], last + window
    context = mixed((sums[end] - sums[first]) * inverses[first] + (end - first).astype(_U64) * _U64(_BASE))
    return Anchors(grams[place], context, place, place - first, end - place)


def distinct(found: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """The first of the anchors with each gram and context, in order, and the number of that kind of every anchor.

    Periodic text has an anchor in each period, all alike; one of them stands for all.
    """
    keys = found.gram ^ (found.context * _U64(_BASE))
    _, first, kind = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return first[order], rank[kind]


def anchors(data: bytes, window: int = 200, gram: int = 50, segment: int = SEGMENT) -> Anchors:
    """Anchors of a text, in order; none for texts shorter than a window."""
    body = np.frombuffer(data, np.uint8)
    windows = len(body) - window + 1
    parts = []
    for start in range(0, max(windows, 0), segment):
        end = min(start + segment, windows)
        found = _segment(body[start:end + window - 1], window, gram)
        parts.append(found._replace(place=found.place + start))
    if not parts:
        none = np.zeros(0, np.int64)
        return Anchors(none.astype(_U64), none.astype(_U64), none, none, none)
    return parts[0] if len(parts) == 1 else Anchors(*map(np.concatenate, zip(*parts)))
