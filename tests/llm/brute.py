"""Plain versions of the operators, written without the library, for small inputs."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import xxhash


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def edit_distance(a, b, free_ends=False):
    """Distance of a and b; with free ends, of a and its nearest stretch of b."""
    row = [0] * (len(b) + 1) if free_ends else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return min(row) if free_ends else row[-1]


def near(a, b, threshold=0.8):
    """Whether the words of a and b differ by edits for at most 1 - threshold of the longer text."""
    x, y = words(a), words(b)
    most = (1 - threshold) * max(len(x), len(y)) + 1e-9
    if not x or not y or max(len(x), len(y)) - sum((Counter(x) & Counter(y)).values()) > most:
        return False  # words that the other text lacks take an edit each
    return edit_distance(x, y) <= most


def near_classes(docs):
    """{doc_id: least id of its class} for (id, text) rows."""
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, t in docs:
        for s in shingles(t) or [("text", t or "")]:
            holders.setdefault(s, []).append(i)
    texts = dict(docs)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in sorted(pairs):
        if find(a) != find(b) and ((texts[a] or "") == (texts[b] or "") or near(texts[a], texts[b])):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in root}


def holds(text, item, rate=0.06):
    a, b = " ".join(words(item)), " ".join(words(text))
    return bool(a) and bool(b) and edit_distance(a, b, free_ends=True) <= int(rate * len(a))


def fingerprint(text):
    """SimHash over runs of four words, bit by bit."""
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if w]
    if not ws:
        return 0
    runs = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def bit_components(prints, most=4):
    """{id: least id reachable} over all pairs of (id, fingerprint)."""
    left, out = sorted(prints), {}
    while left:
        group = [left.pop(0)]
        for _, x in group:  # grows while it is read
            near = [p for p in left if (p[1] ^ x).bit_count() <= most]
            left = [p for p in left if p not in near]
            group += near
        out |= {i: group[0][0] for i, _ in group}
    return out


def search(docs, items, top=50):
    """(item id, rank, doc id, score) by the formulas, over (id, text) rows."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))

    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for key, text in items:
        scores = []
        for i, c in counts:
            if not c:
                continue
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(key, r, s[-1], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1)]
    return out


def audit(docs, labels):
    """Rows (part, order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): every order is run."""
    first, marks = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, good, bad in labels:
        old = marks.get(i, (0, 0))
        marks[i] = (max(old[0], good == 1), max(old[1], bad == 1))
    parts = {}
    for i, t, part in docs:
        t, w = t or "", [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        fails = {l for l, bad in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
                                  ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)), ("D", re.search("[#$%&*|]", t)),
                                  ("E", i is not None and t in first and i > first[t])) if bad}
        parts.setdefault(part or "", []).append((fails, marks.get(i, (0, 0)) if i is not None else (0, 0)))
    out = []
    for part, rows in parts.items():
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[0]]
                left = [r for r in left if letter not in r[0]]
                steps.append((letter, "".join(order), step, len(left), len(gone), sum(letter in r[0] for r in rows) - len(gone),
                              sum(r[0] == {letter} for r in rows), sum(r[1][0] for r in gone), sum(r[1][1] for r in gone)))
        share = Counter()
        for s in steps:
            share[s[0]] += s[4]
        out += [(part, *s[1:], share[s[0]]) for s in steps]
    return out
