"""Suffix sorting by Lyndon grouping, in linear time and without recursion on a renamed text.

Suffixes are grouped by their longest Lyndon prefix. Groups are processed in descending order:
each suffix of a group finds, by following pointers, the last position before it that lies in a
lower group (its previous smaller suffix); that suffix's Lyndon prefix grows by the group's own,
so it moves to a new group right above its old one, the further up the more suffixes of this
group point to it. In the second phase groups are read in ascending order: each suffix that is
emitted puts the one before it, and what that one's pointers lead to, next in their groups.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Of integers above nought; a least symbol is put at the end, and its suffix is left out."""
    n = len(text) + 1
    symbols = sorted(set(text))
    number = {s: g + 1 for g, s in enumerate(symbols)}
    group = [number[s] for s in text]
    group.append(0)
    members: list[list[int]] = [[] for _ in range(len(symbols) + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    # Groups are a list from low to high, so new ones can be put between.
    higher: list[int] = [*range(1, len(members)), -1]
    lower: list[int] = [-1, *range(len(members) - 1)]
    previous = [-1] * n
    done = bytearray(n)

    now = len(members) - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        by_children: dict[int, list[int]] = {}
        parent, children = -1, 0
        for i in own:  # in text order, so those that point to one parent come together
            p = i - 1
            while p >= 0 and (done[p] or group[p] == now):
                p = previous[p]
            previous[i] = p
            if p == parent:
                children += 1
            else:
                if parent >= 0:
                    by_children.setdefault(children, []).append(parent)
                parent, children = p, 1
        if parent >= 0:
            by_children.setdefault(children, []).append(parent)
        for i in own:
            done[i] = 1
        for count in sorted(by_children, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in by_children[count]:
                moved.setdefault(group[p], []).append(p)
            for old, those in moved.items():
                if len(those) == size[old]:
                    continue  # nothing stays below: the group may keep its place
                new = len(members)
                members.append(those)
                size[old] -= len(those)
                size.append(len(those))
                above = higher[old]
                higher.append(above)
                lower.append(old)
                higher[old] = new
                lower[above] = new
                for p in those:
                    group[p] = new
        now = lower[now]

    front = [0] * len(members)
    at, now = 0, 0
    while now >= 0:
        front[now] = at
        at += size[now]
        now = higher[now]
    order = [0] * n
    order[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for k in range(n):
        s = order[k] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[front[g]] = s
            front[g] += 1
            placed[s] = 1
            s = previous[s]
    return order[1:]
