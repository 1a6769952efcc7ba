"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingle_sets(docs: dict, width: int, lower=True) -> dict:
    out = {}
    for i, t in docs.items():
        w = WORD.findall((t or "").translate(LOWER) if lower else t or "")
        out[i] = {tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    return out


def jaccard_components(docs: dict, width=4, percent=85) -> dict:
    sets = shingle_sets(docs, width)
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.append((i, j))
    found = roots(links, sets)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def base_counts(text) -> tuple:
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def crc(text) -> int:
    return zlib.crc32((text or "").encode())


PUNCT = str.maketrans("123456789", "000000000", ".,;:!?\"'()[]{}|*#-_")


def line_words(line) -> tuple:
    return tuple(WORD.findall(line.lower().translate(PUNCT)))


def simhash(words) -> int:
    import xxhash

    counts = [0] * 64
    for w in words:
        x = xxhash.xxh64_intdigest(w.encode(), seed=42)
        for i in range(64):
            counts[i] += x >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(words))


def edit(x: str, y: str) -> int:
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def clean_lines(docs: dict, percent=85, apart=3, least=5) -> dict:
    """{key: (n_lines, n_dropped, text)}"""
    import numpy as np

    places, spoken = defaultdict(list), {}
    for i, t in docs.items():
        for at, line in enumerate((t or "").split("\n")):
            if WORD.search(line):
                w = line_words(line)
                name = w or ("", line)
                places[name].append((i, at))
                spoken[name] = w
    names = sorted(n for n in places if len(spoken[n]) >= least)
    sims = np.array([simhash(n) for n in names], np.uint64)
    links = []
    for i, n in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(sims[i + 1:] ^ sims[i]) <= apart) + i + 1:
            x, y = (" ".join(names[k]) + " " for k in (i, j))
            if min(len(x), len(y)) * 100 - 100 >= (max(len(x), len(y)) - 1) * percent and edit(x, y) * 100 <= max(len(x), len(y)) * (100 - percent):
                links.append((i, int(j)))
    found = roots(links, range(len(names)))
    group = {n: ("group", found[i]) for i, n in enumerate(names)}
    best = {}
    for n, where in places.items():
        g = group.get(n, n)
        best[g] = min(best.get(g, min(where)), min(where))
    out = {}
    for i, t in docs.items():
        kept, dropped, total = [], 0, 0
        for at, line in enumerate((t or "").split("\n")):
            if WORD.search(line):
                total += 1
                n = line_words(line) or ("", line)
                if best[group.get(n, n)] != (i, at):
                    dropped += 1
                    continue
            kept.append(line)
        out[i] = (total, dropped, None if t is None else "\n".join(kept))
    return out


def repeated_words(docs: dict, least=50) -> dict:
    """{key: places of words inside a window of ``least`` words that the corpus holds twice or more}"""
    spoken = {i: WORD.findall(t or "") for i, t in docs.items()}
    seen = Counter(tuple(w[j:j + least]) for w in spoken.values() for j in range(len(w) - least + 1))
    out = {}
    for i, w in spoken.items():
        out[i] = {p for j in range(len(w) - least + 1) if seen[tuple(w[j:j + least])] > 1 for p in range(j, j + least)}
    return out
