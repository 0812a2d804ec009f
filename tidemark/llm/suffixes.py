"""Suffix array by linear grouping (after Baier), for the texts of one bucket."""

from __future__ import annotations


def suffix_array(text: bytes) -> list[int]:
    """Starts of the suffixes in lexicographic order.

    First phase: suffixes are grouped by their longest Lyndon prefix. Groups are taken from
    the greatest down. Each member of a group passes the group on to the nearest earlier
    suffix of a lower group (its previous-smaller pointer); the suffixes that receive it move
    to new groups just above their old ones, further up the more often they receive it.

    Second phase: suffixes are emitted in ascending order. What precedes an emitted suffix
    along the previous-smaller pointers comes next in its own group. Nothing is renamed or
    sorted again.
    """
    n = len(text)
    if n < 2:
        return list(range(n))
    group = [0] * n
    members: list[list[int]] = []
    below: list[int] = []  # next lower group, -1 at the lowest
    above: list[int] = []
    by_byte: dict[int, int] = {}
    for c in sorted(set(text)):
        by_byte[c] = len(members)
        below.append(len(members) - 1)
        above.append(len(members) + 1)
        members.append([])
    above[-1] = -1
    for i, c in enumerate(text):
        g = by_byte[c]
        group[i] = g
        members[g].append(i)
    done = [False] * n
    previous = [-1] * n
    current = len(members) - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        members[current] = own
        times: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and (done[j] or group[j] == current):
                j = previous[j]
            previous[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        for i in own:
            done[i] = True
        if times:
            least = min(times.values())
            most = max(times.values())
            counts = (least,) if least == most else sorted(set(times.values()), reverse=True)
            for k in counts:
                made: dict[int, int] = {}
                for j in (times if least == most else sorted(p for p, v in times.items() if v == k)):
                    g = group[j]
                    new = made.get(g)
                    if new is None:
                        new = made[g] = len(members)
                        members.append([])
                        below.append(g)
                        up = above[g]
                        above.append(up)
                        above[g] = new
                        if up >= 0:
                            below[up] = new
                    group[j] = new
                    members[new].append(j)
            if least == most:
                for new in made.values():
                    members[new].sort()
        current = below[current]
    place = [0] * len(members)
    lowest = next(g for g in range(len(members)) if below[g] == -1)
    at, g = 0, lowest
    while g >= 0:
        place[g] = at
        at += sum(1 for i in members[g] if group[i] == g)
        g = above[g]
    out = [0] * n
    placed = [False] * n

    def emit(j: int) -> None:
        while j >= 0 and not placed[j]:
            placed[j] = True
            g = group[j]
            out[place[g]] = j
            place[g] += 1
            j = previous[j]

    emit(n - 1)
    for i in range(n):
        emit(out[i] - 1)
    return out
