"""Plain versions of the operators, written without their code."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

BLANK = "[\x20\x09-\x0d]+"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(docs):
    """doc_id -> (keep_id, size, kept, sha) for (doc_id, text) rows."""
    groups = defaultdict(list)
    for doc, text in docs:
        groups[re.sub(BLANK, "", text or "")].append((-len(text or ""), doc))
    out = {}
    for plain, rows in groups.items():
        keep = min(rows)[1]
        for _, doc in rows:
            out[doc] = (keep, len(rows), doc == keep, sha(plain))
    return out


def units(text):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    n = min(5, len(words))
    return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else Counter()


def jaccard(a, b) -> float:
    return sum((a & b).values()) / sum((a | b).values())


def near_classes(docs, threshold=0.8):
    """doc_id -> smallest doc_id connected with it, over all pairs."""
    sets = {doc: units(text) for doc, text in docs}
    where = defaultdict(set)
    for doc, s in sets.items():
        for x in s:
            where[x].add(doc)
    root = {doc: doc for doc, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc, s in sets.items():
        for other in {o for x in s for o in where[x] if o < doc}:
            if jaccard(s, sets[other]) >= threshold:
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: find(doc) for doc in root}


def vector_links(rows, threshold=0.98):
    """vec_id -> (links, smallest id connected with it) for (vec_id, vector, label) rows."""
    good = []
    for vec_id, v, label in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            good.append((vec_id, np.array(v, np.float64), label))
    links, root = Counter(), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x, p) in enumerate(good):
        for b, y, q in good[:i]:
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {r[0]: (links[r[0]], find(r[0])) for r in rows}


def kept_lines(docs, least_chars=40, least_docs=5):
    """doc_id -> (lines, dropped, sha of the text that is left)."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(table)
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(doc)
    out = {}
    for doc, text in docs:
        parts = (text or "").split("\n")
        left = [p for p in parts if len(holders.get(key(p), ())) < least_docs or max(holders[key(p)]) == doc]
        out[doc] = (len(parts), len(parts) - len(left), sha("\n".join(left)))
    return out


def source_targets(sizes, most=3):
    """source -> target by sharing again and again, for {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        aim = {s: most * sizes[s] if s in capped else rest * weight[s] / share for s in order}
        over = {s for s in order if aim[s] > most * sizes[s] * (1 + 1e-12)} - capped
        if not over:
            return aim
        capped |= over


def alignment(docs, encode_a, encode_b, bytes_a, bytes_b):
    """Rows of the alignment of (doc, text), in order, by comparing every two neighbouring tokens.

    `encode_a` and `encode_b` give ids, `bytes_a` and `bytes_b` the bytes of an id.
    """
    found, holders = [], Counter()
    for _, text in docs:
        plain = (" " + text).encode() if text else b""
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        if b"".join(map(bytes_a, a)) != plain or b"".join(map(bytes_b, b)) != plain:
            a, b = [], []
        links, groups, i, j, end_a, end_b = [], [[[], []]], 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            stop_a, stop_b = end_a + len(bytes_a(a[i])), end_b + len(bytes_b(b[j]))
            if stop_a <= stop_b:
                groups[-1][0].append(a[i])
                i, end_a = i + 1, stop_a
            if stop_b <= stop_a:
                groups[-1][1].append(b[j])
                j, end_b = j + 1, stop_b
            if stop_a == stop_b and i < len(a):
                groups.append([[], []])
        holders.update(set(links))
        found.append((a, b, links, groups if a else []))
    highest = Counter()
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc, _), (a, b, links, groups) in zip(docs, found):
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(holders[p] == highest[p[0]] for p in links)
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(holders[p] for p in links), sha(line) if line else ""))
    return out


def ranked(docs, items, top=20):
    """(item, rank, doc, score) of the best documents, for (id, text) rows."""
    import math

    def terms(text):
        plain = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", plain)

    held = [(doc, Counter(terms(text))) for doc, text in docs]
    df = Counter(t for _, c in held for t in c)
    documents, words = sum(1 for _, c in held if c), sum(c.total() for _, c in held)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * c.total() * documents // words
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        out += [(item, k + 1, doc if known else None, -s) for k, (s, known, doc) in enumerate(sorted(scores)[:top])]
    return out
