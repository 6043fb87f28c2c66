"""Plain single-machine versions the operators are held against."""

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < size else (tuple(w[i : i + size]) for i in range(len(w) - size + 1)))


def components(sets, percent):
    """Least key reachable from each key of ``sets``; all pairs that share an item are compared."""
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, items in sets.items():
        for item in items:
            holders[item].append(k)
    for k, items in sets.items():
        for other in {o for item in items for o in holders[item] if o < k}:
            common = len(items & sets[other])
            if 100 * common >= percent * (len(items) + len(sets[other]) - common):
                a, b = find(k), find(other)
                parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}
