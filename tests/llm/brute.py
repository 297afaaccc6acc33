"""Plain, slow versions that the operators are held against."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def shingles(text, size=5):
    w = words(text)
    if len(w) < size:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def jaccard(a, b):
    both = sum((a & b).values())
    either = sum((a | b).values())
    return both / either if either else 0.0


def components(nodes, links):
    head = {n: n for n in nodes}

    def find(n):
        while head[n] != n:
            n = head[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        head[b] = a
    return {n: find(n) for n in nodes}


def near_links(sets, threshold):
    """Pairs of keys whose multisets reach the threshold."""
    holders, out = defaultdict(list), set()
    for key, s in sets.items():
        for x in s:
            holders[x].append(key)
    for keys in holders.values():
        for i, a in enumerate(keys):
            out |= {(a, b) for b in keys[i + 1 :] if (a, b) not in out and jaccard(sets[a], sets[b]) >= threshold}
    return out
