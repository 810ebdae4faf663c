"""Plain versions of the operators, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {n: top(n) for n in nodes}


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def shingle_set(text, width=5):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def jaccard_components(rows):
    """{(id, size, component)} for (id, text) rows with unique ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        ids = sorted(ids)
        if len(ids) < 400:
            for k, a in enumerate(ids):
                for b in ids[k + 1:]:
                    common[a, b] += 1
        else:
            raise AssertionError("table too large for the plain version")
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(sets, links)
    return {(i, len(sets[i]), root[i]) for i in sets}


def repeated_passages(rows, length=35):
    """Sorted (id, words, removed, digest) for (id, text) rows."""
    import hashlib
    from collections import Counter

    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + length]) for _, w in texts for k in range(len(w) - length + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone.update(range(k, k + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


BLANKS = " \t\n\x0b\f\r"


def line_dedup(rows, min_chars=40, min_docs=5):
    """{id: (kept text, lines, dropped)} for (id, text) rows with unique ids."""
    lines = {i: (t or "").split("\n") for i, t in rows}
    key = lambda line: ascii_lower(line.strip(BLANKS))
    holders = defaultdict(set)
    for i, own in lines.items():
        for line in own:
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = {}
    for i, own in lines.items():
        kept = [x for x in own if gone.get(key(x), i) == i]
        out[i] = ("\n".join(kept), len(own), len(own) - len(kept))
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """Target per source of {source: words}, by sharing again until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in names}
        capped |= over


def mix(rows):
    """{id: (size, source size, target, taken)} for (id, source, text) rows with unique ids."""
    import hashlib
    import math

    size = {i: len(WORD.findall(t or "")) for i, _, t in rows}
    sizes = defaultdict(int)
    for i, s, _ in rows:
        sizes[s] += size[i]
    goal, out = targets(dict(sizes)), {}
    for source in sizes:
        keyed = []
        for i, s, t in rows:
            if s == source:
                u = (int(hashlib.md5(f"mix{'' if i is None else i}".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
                weight = 1.0 if t is None else 1 / (1 + abs(len(t) / max(1, size[i]) - 6) / 6)
                keyed.append((-math.log(u) / weight, i))
        epochs = int(goal[source] // sizes[source]) if sizes[source] else 0
        left = round(goal[source] - epochs * sizes[source])
        for _, i in sorted(keyed, key=lambda k: (k[0], k[1] is not None, k[1])):
            part = max(0, min(size[i], left))
            left -= size[i]
            out[i] = (size[i], sizes[source], goal[source], epochs * size[i] + part)
    return out


def embedding_components(rows, threshold=0.9):
    """Sorted (id, links, component, kept) for (id, vector) rows with unique ids."""
    import numpy as np

    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    links = []
    for k, (i, v) in enumerate(good):
        for j, w in good[k + 1:]:
            if len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= threshold:
                links.append((i, j))
    root, count = roots([i for i, _ in rows], links), defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((i, count[i], root[i], root[i] == i) for i, _ in rows)
