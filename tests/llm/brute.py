"""Plain single-process versions of the operators, for small tables."""

import re
from collections import defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def shingle_set(text, width=5):
    w = WORDS(text or "")
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))) if w else frozenset()


def components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar_pairs(sets, threshold):
    """All pairs of keys whose sets have at least this Jaccard similarity, found through shared elements."""
    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    shared = defaultdict(int)
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                shared[a, b] += 1
    return {(a, b) for (a, b), n in shared.items() if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9}


def near_duplicates(rows, threshold=0.8):
    """{id: (class, links)} for (id, text) rows with unique ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    pairs = similar_pairs(sets, threshold)
    links = defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    root = components(sets, pairs)
    return {i: (root[i], links[i]) for i in sets}


def removed_lines(rows, threshold=0.8, least=1):
    """{id: numbers of lines that an earlier line matches} for (id, text) rows with unique ids."""
    first, sets, places = {}, {}, []
    for i, t in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(WORDS(line))
            if len(s) >= least:
                first.setdefault(s, (i, k))
                places.append(((i, k), s))
    sets = {p: s for s, p in first.items()}
    bound = dict.fromkeys(sets, None)
    for a, b in similar_pairs(sets, threshold):
        for x, y in ((a, b), (b, a)):
            bound[x] = min(filter(None, (bound[x], y)))
    out = defaultdict(list)
    for place, s in places:
        own = first[s]
        if place > min(filter(None, (own, bound[own]))):
            out[place[0]].append(place[1])
    return dict(out)
