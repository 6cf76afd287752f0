"""Links between shingle sets by comparing all pairs, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def linked(rows, percent=90, width=3):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(low))
        sets.append(frozenset(zip(*[w[i:] for i in range(width)], strict=False)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, r in enumerate(rows):
        members[root(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(r[0], len(s), least[root(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]
