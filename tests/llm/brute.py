"""Plain versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=4):
    w = words(fold(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def joined(docs, size=4, share=85):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    at = {}
    for i, s in sets.items():
        for g in s:
            at.setdefault(g, []).append(i)
    for i, s in sets.items():
        both = {}
        for g in s:
            for j in at[g]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= share * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def kept_words(docs, size=50):
    """{doc_id: (n_words, kept words)}: words under windows that start in a
    document with a smaller id go."""
    first = {}
    for i, t in sorted(docs):
        w = words(t)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(w), [x for k, x in enumerate(w) if k not in gone])
    return out
