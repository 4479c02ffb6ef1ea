"""Maximal repeats of a group of anchored contexts, from an enhanced suffix array.

A context is the text around an anchor: ``right`` starts with the anchor, ``left`` is
what stands before it. All contexts of a group start their right part alike.
"""

from __future__ import annotations

from collections.abc import Iterator


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size  # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def suffix_array(texts: list[bytes], members: list[int]) -> tuple[list[int], list[int]]:
    """Members in the order of their texts, and the common prefix of each with the next."""
    order = sorted(members, key=texts.__getitem__)
    return order, [common(texts[a], texts[b]) for a, b in zip(order, order[1:])]


def intervals(prefixes: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the common-prefix intervals of at least ``least``, by a stack scan.

    ``prefixes[i]`` is shared by entries i and i + 1. Children come before their parents.
    """
    stack: list[tuple[int, int]] = []  # (length, first entry)
    for entry in range(len(prefixes) + 1):
        now = prefixes[entry] if entry < len(prefixes) else -1
        first = entry
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            if length >= least:
                yield length, first, entry
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(
    lefts: list[bytes], rights: list[bytes], least: int,
) -> Iterator[tuple[int, int, list[int]]]:
    """(before, after, members): strings of ``before + after`` >= ``least`` bytes that all members share.

    ``lefts`` are reversed. Each string has at least two occurrences and neither end
    can grow without losing one, unless the contexts end there: an interval of the
    right texts that shares ``after`` bytes is divided by what stands to the left; a
    sub-group is left-diverse where its members' left texts part, and is reported
    unless all its members also agree on more to the right (a child has reported it).
    """
    longest = max(map(len, lefts))
    order, prefixes = suffix_array(rights, list(range(len(rights))))
    for after, low, high in intervals(prefixes, max(least - longest, 1)):
        inside = order[low:high + 1]
        rank = {member: low + k for k, member in enumerate(inside)}
        by_left, shared = suffix_array(lefts, inside)
        for before, first, last in intervals(shared, max(least - after, 0)):
            members = by_left[first:last + 1]
            ranks = [rank[m] for m in members]
            if min(prefixes[min(ranks):max(ranks)]) > after:
                continue  # not right-diverse at this length
            yield before, after, members
