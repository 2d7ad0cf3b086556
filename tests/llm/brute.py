"""Brute-force versions of the text operators, for small inputs."""

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, size=5):
    words = WORDS.findall(lower(text or ""))
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def jaccard_components(rows, percent=75):
    """{(doc_id, text): (n, component)}"""
    rows = sorted(rows, key=lambda r: r[0])
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {rows[i][0]: (len(sets[i]), rows[root(i)][0]) for i in range(len(rows))}


def suffix_dedup(rows, threshold=50):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)}"""
    first = {}
    data = {i: (t or "").encode() for i, t in rows}
    for i in sorted(data):
        d = data[i]
        for p in range(len(d) - threshold + 1):
            first.setdefault(d[p:p + threshold], i)
    out = {}
    for i, d in data.items():
        gone = [False] * len(d)
        for p in range(len(d) - threshold + 1):
            if first[d[p:p + threshold]] < i:
                gone[p:p + threshold] = [True] * threshold
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
