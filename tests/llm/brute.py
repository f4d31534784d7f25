"""Plain re-statements of the operators' rules, for small inputs."""

import re
from collections import Counter, defaultdict

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=4):
    w = WHITE.findall(lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


class Groups:
    def __init__(self, ids):
        self.root = {i: i for i in ids}

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


def near_groups(rows):
    """rows of (doc_id, text) -> {doc_id: component}."""
    sets = [(i, shingles(t)) for i, t in rows]
    groups = Groups({i for i, _ in rows})
    index = defaultdict(list)
    for at, (i, s) in enumerate(sets):
        both = Counter(j for g in s for j in index[g])
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                groups.join(i, sets[j][0])
        for g in s:
            index[g].append(at)
    return {i: groups.find(i) for i, _ in rows}


def benchmark_hits(docs, items, n=10):
    """docs, items of (id, text) -> [(id, n_words, n_hit, sorted item ids)] per document row."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        k = min(n, len(w))
        for at in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[at : at + k])].add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[at : at + k]))):
                    hit.update(range(at, at + k))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found)))
    return out
