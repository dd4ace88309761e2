"""Plain versions of what the operators compute."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def substring_dedup(rows, k=13):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, sha)."""
    first = {}
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - k + 1):
            g = tuple(w[a : a + k])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = {a + j for a in range(len(w) - k + 1) if first[tuple(w[a : a + k])] < i for j in range(k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def shingles(text, n=5):
    w = words(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n_shingles, component_id)."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def quality(rows, max_docs=10, max_lost=50):
    """rows: (doc_id, text, source) -> sorted base columns and verdicts."""
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[1-9]", "0", x.lower())).strip(" ")
    hosts, lines = defaultdict(set), {}
    for k, (i, t, s) in enumerate(rows):
        lines[k] = {norm(x) for x in (t or "").split("\n") if words(x)}
        for x in lines[k]:
            hosts[s, x].add(i)
    out = []
    for k, (i, t, s) in enumerate(rows):
        t = t or ""
        w, with_word = words(t), [x for x in t.split("\n") if words(x)]
        grams = Counter(tuple(w[a : a + 3]) for a in range(len(w) - 2))
        covered = {a + j for a in range(len(w) - 2) if grams[tuple(w[a : a + 3])] > 1 for j in range(3)}
        size = {x: len(x.split(" ")) for x in lines[k]}
        gone = sum(n for x, n in size.items() if len(hosts[s, x]) > max_docs)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(with_word) - len(set(with_word)), len(covered), failed, not failed and not gone * 100 > sum(size.values()) * max_lost))
    return sorted(out)
