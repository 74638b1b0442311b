"""Suffix arrays of many short texts at once, by grouping suffixes and then emitting each group's order.

The first phase keeps the suffixes of a text in groups, at first by their first symbol. Groups are taken from the last to the
first. Each suffix of the group points to the nearest suffix before it that lies in a lower group; the suffixes that are pointed to
leave their groups for new ones right behind, those with more pointers behind those with fewer. In the end each group
holds the suffixes with one and the same Lyndon prefix. The second phase goes through the order from its start: the suffix before
each, and those that the pointers lead to from there, take the next free places of their groups. No symbols are renamed
and nothing recurses; each phase follows every pointer once. All texts take their steps together, as numpy arrays.
"""

from __future__ import annotations

import numpy as np


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers starts[i] .. starts[i] + sizes[i] - 1 one after the other, and i for each of them."""
    owner = np.repeat(np.arange(len(starts)), sizes)
    first = np.cumsum(sizes) - sizes
    return np.arange(len(owner)) - first[owner] + starts[owner], owner


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Text t is symbols[bounds[t]:bounds[t + 1]], and must end in a symbol 0 that it has nowhere else.

    The result has the places of the sorted suffixes of text t, counted from the start of `symbols`, at the same bounds.
    """
    n, texts = len(symbols), len(bounds) - 1
    if not n:
        return np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(texts), np.diff(bounds))
    begin = bounds[:-1][text]
    order = np.lexsort((symbols, text))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    start_at = np.flatnonzero(fresh)
    sizes = np.zeros(n + 1, dtype=np.int64)
    sizes[start_at] = np.diff(np.append(start_at, n))
    group = np.empty(n, dtype=np.int64)
    group[order] = np.repeat(start_at, sizes[start_at])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    pointer = np.arange(-1, n - 1)
    front = bounds[1:].astype(np.int64).copy()  # groups from here on are done
    active = np.flatnonzero(front > bounds[:-1])
    while len(active):
        heads = group[order[front[active] - 1]]
        members, owner = _ragged(heads, sizes[heads])
        members, own_group, low = order[members], heads[owner], bounds[:-1][active][owner]
        at = pointer[members]
        while True:  # all members jump at once, also over each other
            jump = (at >= low) & (group[np.maximum(at, 0)] >= own_group)
            if not jump.any():
                break
            at = np.where(jump, pointer[at], at)
            pointer[members] = at
        pointer[members] = np.where(at < low, -1, at)
        front[active] = heads
        _split(at[at >= low], order, place, group, sizes)
        active = active[heads > bounds[:-1][active]]
    return _emit(order, group, pointer, begin, bounds)


def _split(targets: np.ndarray, order: np.ndarray, place: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> None:
    """Moves the suffixes that are pointed to into groups of their own, by how often, behind the rest of their groups."""
    if not len(targets):
        return
    found, times = np.unique(targets, return_counts=True)
    by = np.lexsort((times, group[found]))
    found, times, old = found[by], times[by], group[found[by]]
    head = np.ones(len(found), dtype=bool)
    head[1:] = old[1:] != old[:-1]
    firsts = np.flatnonzero(head)
    counts = np.diff(np.append(firsts, len(found)))
    ends = old[firsts] + sizes[old[firsts]]
    new_places, owner = _ragged(ends - counts, counts)
    # Places that others hold among the new ones go to where the moved ones were.
    moved = np.zeros(0)
    holders = order[new_places]
    is_moved = np.isin(holders, found, assume_unique=True)
    leaving = holders[~is_moved]
    vacated = place[found] < (ends - counts)[owner]
    holes = place[found[vacated]]
    # Both lists are in the order of the groups, and have as many entries in each.
    order[holes], place[leaving] = leaving, holes
    order[new_places], place[found] = found, new_places
    sub = head.copy()
    sub[1:] |= times[1:] != times[:-1]
    starts = np.flatnonzero(sub)
    lengths = np.diff(np.append(starts, len(found)))
    sizes[old[firsts]] -= counts
    sizes[new_places[starts]] = lengths
    group[found] = np.repeat(new_places[starts], lengths)


def _emit(order: np.ndarray, group: np.ndarray, pointer: np.ndarray, begin: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(order)
    out = np.full(n, -1, dtype=np.int64)
    free = np.arange(n)  # the next place of each group, at the group's first place
    done = np.zeros(n, dtype=bool)
    last = bounds[1:] - 1
    some = np.flatnonzero(np.diff(bounds) > 0)
    out[bounds[some]] = last[some]
    done[last[some]] = True
    step = 0
    lengths = np.diff(bounds)
    active = some
    while len(active):
        here = out[bounds[active] + step]
        at = here - 1
        ok = at >= bounds[active]
        at = at[ok]
        while len(at):
            at = at[~done[at]]
            if not len(at):
                break
            spot = free[group[at]]
            out[spot] = at
            free[group[at]] = spot + 1
            done[at] = True
            at = pointer[at]
            at = at[at >= 0]
        step += 1
        active = active[lengths[active] > step]
    return out
