"""Plain restatements of the operators for small inputs."""

import hashlib
import re

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    data = (text or "").encode()
    return WORDS.findall(data.lower() if lower else data)


def shingles(text):
    w = words(text, lower=True)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_duplicates(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for j in holders.get(s, ()):
                common[j] = common.get(j, 0) + 1
            holders.setdefault(s, []).append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def remove_repeats(docs):
    text = [(i, words(t)) for i, t in docs]
    first = {}
    for i, w in sorted(text, key=lambda x: x[0]):
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), i)
    out = []
    for i, w in text:
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < i:
                gone[p:p + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def base_counts(text):
    text = text or ""
    w = words(text)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def targets(sizes):
    """Targets of sources (in code-point order, null last) by sharing out again and again."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    rest, open_, result = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s] + 1e-9}
        if not full:
            return result | {s: level * weight[s] for s in open_}
        for s in full:
            result[s] = 2.0 * sizes[s]
            rest -= result[s]
        open_ -= full
    return result
