"""Suffix arrays by linear grouping, for many small texts side by side.

Suffixes are grouped by their Lyndon prefixes, from the largest group down: the
previous smaller suffix of every member of a group is found by following pointers of
larger groups, and the suffixes pointed at move up within their own groups by how many
members point at them. The order inside the groups is then emitted in one pass from the
smallest suffix up. No names are ranked again and nothing recurses.

All texts take a step at the same time, so a step is a handful of array operations
whatever the number of texts.
"""

from __future__ import annotations

import numpy as np


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``start, start + 1, ... `` for each pair of start and count."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + counts, counts)


def suffix_arrays(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffix arrays of all texts ``text[bounds[k]:bounds[k + 1]]``, in the same places, as positions in ``text``.

    Each text ends with a value smaller than all before it.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64)
    begin, end = bounds[:-1], bounds[1:]
    owner = np.repeat(np.arange(len(begin)), end - begin)
    order = np.lexsort((text, owner))  # slot to position, by first letter
    slot = np.empty(size, np.int64)
    slot[order] = np.arange(size)
    new = np.ones(size, bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    heads = np.flatnonzero(new)
    members = np.zeros(size, np.int64)  # by a group's first slot
    members[heads] = np.diff(np.append(heads, size))
    group = np.empty(size, np.int64)  # position to its group's first slot
    group[order] = np.repeat(heads, members[heads])
    previous = np.full(size, -1, np.int64)
    first = begin[owner]  # position to its text's first position

    # phase 1: groups from the largest down
    top = end.copy()
    live = np.flatnonzero(end > begin)
    moved = np.zeros(size, bool)
    while len(live):
        head = group[order[top[live] - 1]]
        count = top[live] - head
        i = order[_spread(head, count)]
        own = np.repeat(head, count)
        j = i - 1
        j[i == first[i]] = -1
        climbing = np.flatnonzero(j >= 0)
        while len(climbing):
            at = j[climbing]
            climbing = climbing[group[at] > own[climbing]]
            j[climbing] = previous[j[climbing]]
            climbing = climbing[j[climbing] >= 0]
        # a pointer to the same group is followed on, twice as far each time
        previous[i] = j
        pending = np.flatnonzero((j >= 0) & (group[j] == own))
        while len(pending):
            j[pending] = previous[j[pending]]
            previous[i[pending]] = j[pending]
            pending = pending[j[pending] >= 0]
            pending = pending[group[j[pending]] == own[pending]]
        # those pointed at rise in their groups, by the number of pointers
        target = np.sort(j[j >= 0])
        if len(target):
            each = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
            pointers = np.diff(np.append(each, len(target)))
            target = target[each]
            g = group[target]
            both = g * (1 + pointers.max()) + pointers
            o = np.argsort(both)
            target, both, g = target[o], both[o], g[o]
            piece = np.append(True, both[1:] != both[:-1])
            at = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            leaving = np.diff(np.append(at, len(g)))
            low = g[at] + members[g[at]] - leaving  # slots from here on are for those that rise
            place = _spread(low, leaving)
            moved[target] = True
            holes = slot[target]
            holes = holes[holes < np.repeat(low, leaving)]
            aside = order[place]
            aside = aside[~moved[aside]]
            order[holes], slot[aside] = aside, holes
            order[place], slot[target] = target, place
            moved[target] = False
            members[g[at]] -= leaving
            cut = np.flatnonzero(piece)
            sizes = np.diff(np.append(cut, len(g)))
            members[place[cut]] = sizes
            group[target] = np.repeat(place[cut], sizes)
        top[live] = head
        live = live[head > begin[live]]

    # phase 2: emit, from the smallest suffix on
    out = np.full(size, -1, np.int64)
    fill = np.arange(size)  # next free slot by a group's first slot
    placed = np.zeros(size, bool)
    live = np.flatnonzero(end > begin)
    out[begin[live]] = end[live] - 1
    placed[end[live] - 1] = True
    at = begin.copy()
    j = end - 2
    while len(live):
        here = j[live]
        can = here >= begin[live]
        can[can] = ~placed[here[can]]
        go, here = live[can], here[can]
        g = group[here]
        out[fill[g]] = here
        fill[g] += 1
        placed[here] = True
        j[go] = previous[here]
        stay = live[~can]
        at[stay] += 1
        on = at[stay] < end[stay]
        stay = stay[on]
        j[stay] = out[at[stay]] - 1
        if not on.all():
            live = live[at[live] < end[live]]
    return out
