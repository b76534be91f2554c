"""Plain Python versions of what the operators compute."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near_duplicates(docs, percent):
    """doc_id to (set size, smallest doc_id reached), every pair compared."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            small, large = sorted((len(x), len(y)))
            if not small or 100 * small < percent * large:
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {i: (len(s), find(i)) for i, s in sets.items()}


def statistics(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)
