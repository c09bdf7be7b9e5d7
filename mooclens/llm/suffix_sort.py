"""Suffix arrays of many strings at once, by linear grouping.

Phase 1 sorts suffixes into groups that share their Lyndon prefix (the text up
to the next smaller suffix). Groups are taken from the highest down. For each
suffix of the group at hand the pointer to the nearest earlier suffix of a lower group
is found over the pointers known so far; those earlier suffixes are lengthened by the
group's prefix, so they leave their group for a new one right above it, higher
the more of the group's suffixes they precede. Phase 2 reads the array from the
smallest suffix up: the suffix one to the left of each, and those its pointers
lead to, take the next place of their groups. Nothing is renamed or sorted again.

The order of the steps is sequential in one string, so they are taken in all
strings of a batch side by side, each step a few numpy calls over the strings.
"""

from __future__ import annotations

import numpy as np


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0]+size[0]-1, first[1] .. and so on."""
    after = np.cumsum(size)
    return np.repeat(first - after + size, size) + np.arange(int(after[-1]) if len(after) else 0)


def lyndon_groups(text: np.ndarray, base: np.ndarray, size: np.ndarray):
    """Group start per suffix, pointer per suffix (-1: none). ``text`` holds the strings one
    after the other; the last letter of each is its smallest and occurs once."""
    total = len(text)
    string = np.repeat(np.arange(len(base), dtype=np.int32), size)
    array = np.lexsort((text, string))
    where = np.empty(total, np.int64)
    where[array] = np.arange(total)
    letter, owner = text[array], string[array]
    new = np.concatenate([[True], (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])])
    starts = np.flatnonzero(new)
    group = np.empty(total, np.int64)
    group[array] = starts[np.cumsum(new) - 1]
    end = np.zeros(total + 1, np.int64)
    end[starts] = np.append(starts[1:], total)
    del string, letter, owner, new  # the turns need none of them
    pointer = np.full(total, -1, np.int64)
    first_of = np.zeros(total, bool)
    first_of[base] = True
    moving = np.zeros(total, bool)
    upto, floor = base + size, base + 1  # the closing letter's own group needs no turn

    while len(upto):
        low = group[array[upto - 1]]
        n = upto - low
        own = array[_ragged(low, n)]
        mark = np.repeat(low, n)
        # nearest earlier suffix of this or a lower group
        to = np.where(first_of[own], -1, own - 1)
        go = np.flatnonzero(to >= 0)
        go = go[group[to[go]] > mark[go]]
        while len(go):
            to[go] = pointer[to[go]]
            go = go[to[go] >= 0]
            go = go[group[to[go]] > mark[go]]
        # of a lower group: jump over the group itself
        pointer[own] = to
        go = np.flatnonzero(to >= 0)
        go = go[group[to[go]] == mark[go]]
        while len(go):
            to[go] = pointer[to[go]]
            pointer[own[go]] = to[go]
            go = go[to[go] >= 0]
            go = go[group[to[go]] == mark[go]]
        parents, times = np.unique(to[to >= 0], return_counts=True)
        if len(parents):
            old = group[parents]
            order = np.lexsort((times, old))
            parents, times, old = parents[order], times[order], old[order]
            head = np.concatenate([[True], old[1:] != old[:-1]])
            run = np.cumsum(head) - 1
            at = np.flatnonzero(head)
            many = np.diff(np.append(at, len(old)))
            tail = end[old[at]] - many  # where the leaving suffixes of each old group will stand
            place = np.repeat(tail - at, many) + np.arange(len(old))
            moving[parents] = True
            there = array[place]
            stay = there[~moving[there]]
            gap = where[parents]
            gap = gap[gap < tail[run]]
            array[gap] = stay
            where[stay] = gap
            array[place] = parents
            where[parents] = place
            moving[parents] = False
            end[old[at]] = tail
            head[1:] |= times[1:] != times[:-1]
            at = np.flatnonzero(head)
            group[parents] = place[at][np.cumsum(head) - 1]
            end[place[at]] = place[at] + np.diff(np.append(at, len(old)))
        upto = low
        more = upto > floor
        if not more.all():
            upto, floor = upto[more], floor[more]
    return group, pointer


def suffix_arrays(text: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Suffixes of each string in ascending order, as places in ``text``."""
    group, pointer = lyndon_groups(text, base, size)
    total = len(text)
    free = np.arange(total)  # next place, by group start
    array = np.full(total, -1, np.int64)
    array[base] = base + size - 1
    done = np.zeros(total, bool)
    done[base + size - 1] = True
    first_of = np.zeros(total, bool)
    first_of[base] = True
    order = np.argsort(-size, kind="stable")
    base, size = base[order], size[order]
    live = len(base)
    for step in range(int(size[0]) if len(size) else 0):
        while size[live - 1] <= step:
            live -= 1
        s = array[base[:live] + step]
        s = s[~first_of[s]] - 1
        s = s[~done[s]]
        while len(s):
            g = group[s]
            at = free[g]
            free[g] = at + 1
            array[at] = s
            done[s] = True
            s = pointer[s]
            s = s[s >= 0]
            s = s[~done[s]]
    return array
