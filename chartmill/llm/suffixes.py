"""Suffix sorting by linear grouping, over integers.

Phase one groups suffixes by their Lyndon prefix.  Groups are taken in descending order.  For each
suffix of the group the previous position of a smaller group is found; these previous positions are the
suffixes whose Lyndon prefix the group's own prefix extends, once for each member that points to them.
They leave their group for new ones just above it, one for each number of extensions, so every suffix
moves once for each of its extensions and no group is ever renamed or sorted again.

Phase two emits the order within groups.  From every suffix already placed, the position before it and
the chain of its previous-smaller pointers are the next in their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` (integers) in the order of their suffixes; a prefix of another comes first."""
    n = len(text)
    _, first = np.unique(text, return_inverse=True)
    first = np.append(first + 1, 0)  # the end of the text is a symbol below all others
    size = int(first.max()) + 1
    group = first.tolist()  # the group each position is in now
    by_symbol = np.split(np.argsort(first, kind="stable"), np.cumsum(np.bincount(first))[:-1])
    members = [x.tolist() for x in by_symbol]
    live = [len(x) for x in members]  # positions still in each group
    below, above = list(range(-1, size - 1)), [*range(1, size), -1]
    left = list(range(-1, n))  # towards the nearest position not yet done, shortened as it is used
    previous = [-1] * (n + 1)
    done = bytearray(n + 1)
    order = []  # groups in descending order

    current = size - 1
    while current >= 0:
        if live[current] == 1:
            # A group of one: its previous position is extended once.
            own = members[current]
            i = own[0] if len(own) == 1 else next(i for i in own if group[i] == current)
            members[current] = [i]
            order.append(current)
            done[i] = 1
            j = left[i]
            if j >= 0 and done[j]:
                passed = [i]
                while j >= 0 and done[j]:
                    passed.append(j)
                    j = left[j]
                for p in passed:
                    left[p] = j
            previous[i] = j
            if j >= 0 and live[g := group[j]] > 1:
                live[g] -= 1
                new, over = len(members), above[g]
                members.append([j])
                live.append(1)
                below.append(g)
                above.append(over)
                above[g] = new
                if over >= 0:
                    below[over] = new
                group[j] = new
        elif live[current]:
            own = [i for i in members[current] if group[i] == current]
            own.sort()
            members[current] = own
            order.append(current)
            for i in own:
                done[i] = 1
            times: dict[int, int] = {}
            for i in own:
                j = left[i]
                if j >= 0 and done[j]:
                    passed = [i]
                    while j >= 0 and done[j]:
                        passed.append(j)
                        j = left[j]
                    for p in passed:
                        left[p] = j
                previous[i] = j
                if j >= 0:
                    times[j] = times.get(j, 0) + 1
            made: dict[tuple[int, int], list[int]] = {}
            for j, k in times.items():
                made.setdefault((k, group[j]), []).append(j)
            for k, g in sorted(made, reverse=True) if len(made) > 1 else made:
                moved = made[k, g]
                if len(moved) == live[g]:
                    continue  # all that is left of the group is extended alike
                live[g] -= len(moved)
                new, over = len(members), above[g]
                members.append(moved)
                live.append(len(moved))
                below.append(g)
                above.append(over)
                above[g] = new
                if over >= 0:
                    below[over] = new
                for j in moved:
                    group[j] = new
        current = below[current]

    start, at = [0] * len(members), 0
    for g in reversed(order):
        start[g] = at
        at += len(members[g])
    out = [n] + [-1] * n
    placed = bytearray(n + 1)
    placed[n] = 1
    for k in range(n + 1):
        s = out[k] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[start[g]] = s
            start[g] += 1
            placed[s] = 1
            s = previous[s]
    return np.array(out[1:], np.int64)
