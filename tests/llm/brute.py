"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return text.translate({i: i + 32 for i in range(65, 91)})


def connected(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(docs, percent=80, n=5):
    """{doc_id: (n_shingles, component)} for (doc_id, text) rows with distinct ids."""
    sets, where = {}, defaultdict(list)
    for d, t in docs:
        w = WORD.findall(ascii_lower(t or ""))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        for s in sets[d]:
            where[s].append(d)
    common = Counter()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                common[(b, a)] += 1
    edges = [(a, b) for (a, b), k in common.items() if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k)]
    label = connected(list(sets), edges)
    return {d: (len(sets[d]), label[d]) for d in sets}


def near(vectors, threshold=0.95):
    """{vec_id: (n_links, component)} for (vec_id, vector) rows with distinct ids."""
    good = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            good[i] = x / np.sqrt(x @ x)
    ids = list(good)
    count, edges = Counter(), []
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold:
                count[a] += 1
                count[b] += 1
                edges.append((a, b))
    label = connected([i for i, _ in vectors], edges)
    return {i: (count[i], label[i]) for i, _ in vectors}


def repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, kept_sha256, kept words, their places)}."""
    words = {d: WORD.findall(t or "") for d, t in docs}
    seen, gone = set(), {d: set() for d in words}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if k in seen:
                gone[d].update(range(i, i + window))
            seen.add(k)
    out = {}
    for d, w in words.items():
        kept = [x for i, x in enumerate(w) if i not in gone[d]]
        out[d] = (len(w), len(gone[d]), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept, set(range(len(w))) - gone[d])
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def base_secrets(text):
    """(start, kind index, end) of the three plain patterns."""
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)
