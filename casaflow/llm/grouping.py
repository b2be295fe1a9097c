"""Suffix array of an integer sequence by linear suffix grouping.

Every suffix starts with a longest Lyndon word. Phase 1 groups the suffixes by
that word: groups are intervals of the suffix array, refined from the highest
down. When a group is processed, each of its suffixes points to the nearest
earlier suffix of a smaller group; the suffixes pointed to move, most pointers
first, into a new group right above their old one. Phase 2 walks the array from
the left and puts the pointer chain of each suffix into the first free places of
its groups. No names are assigned and nothing is sorted recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of ``symbols`` (any integers), the shorter of two suffixes
    first when one is a prefix of the other."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64)
    # a smallest end mark of its own closes the sequence
    _, ranks = np.unique(symbols, return_inverse=True)
    text = np.append(ranks.astype(np.int64) + 1, 0)
    n += 1
    order = np.argsort(text, kind="stable")
    first = np.concatenate([[0], np.flatnonzero(np.diff(text[order])) + 1])
    last = np.append(first[1:], n) - 1
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, last - first + 1)
    group, order = group.tolist(), order.tolist()
    members = {a: order[a:b + 1] for a, b in zip(first.tolist(), last.tolist())}
    end_of = dict(zip(first.tolist(), last.tolist()))
    start_at = dict(zip(last.tolist(), first.tolist()))
    previous = [-1] * n

    end = n - 1
    while end >= 0:
        start = start_at[end]
        pointed: dict[int, int] = {}
        for i in members.pop(start):
            if group[i] != start:
                continue
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            most = max(pointed.values())
            by_count: list[dict[int, list[int]]] = [{} for _ in range(most + 1)]
            for p, count in pointed.items():
                by_count[count].setdefault(group[p], []).append(p)
            for count in range(most, 0, -1):
                for old, moved in by_count[count].items():
                    high = end_of[old]
                    new = high - len(moved) + 1
                    if new == old:      # the whole group: its own place already
                        members[old] = moved
                        continue
                    for p in moved:
                        group[p] = new
                    members[new] = moved
                    end_of[new], start_at[high] = high, new
                    end_of[old], start_at[new - 1] = new - 1, old
        end = start - 1

    free = {a: a for a in end_of}
    array = [-1] * n
    placed = bytearray(n)
    array[0] = n - 1
    for i in range(n):
        s = array[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            array[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = previous[s]
    return np.array(array[1:], dtype=np.int64)


def common_prefixes(symbols: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the
    array (0 for the first), by the permuted order of text positions."""
    n = len(symbols)
    text, order = symbols.tolist(), array.tolist()
    before = [-1] * n
    for a, b in zip(order[:-1], order[1:]):
        before[b] = a
    by_position, h = [0] * n, 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        top = n - max(i, j)
        while h < top and text[i + h] == text[j + h]:
            h += 1
        by_position[i] = h
        if h:
            h -= 1
    return np.array(by_position, dtype=np.int64)[array] if n else np.empty(0, np.int64)
