"""Plain versions of the operators, one row at a time, for comparison on small tables."""

import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def shingles(text, k):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return []
    return [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]


def simhash(text, k):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    """Smallest reachable id of each, where ``linked(i, j)`` tells for two positions."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(i)
    least = {}
    for members in groups.values():
        known = [ids[i] for i in members if ids[i] is not None]
        for i in members:
            least[i] = min(known) if known else None
    return [least[i] for i in range(len(ids))]


def kept_lines(rows):
    """{position: (lines, dropped, text)} of (id, text) rows."""
    holders = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)

    ids = [2**63 if i is None else i for i, _ in rows]  # none comes after all
    for i, (_, text) in zip(ids, rows, strict=True):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, (_, text) in zip(ids, rows, strict=True):
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in holders or min(holders[key(x)]) == i]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def cosines(vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def feistel(x, n, seed, keys, a, b):
    """The permuted position of ``x``, walking until it lies within 0..n-1."""
    prime = 2**31 - 1
    while True:
        left, right = divmod(x, b)
        for number, (times, plus, last) in enumerate(keys):
            half = left if number % 2 else right
            t = (half % prime * times + plus) % prime
            change = (t * t + last) % prime
            if number % 2:
                right = (right + change) % b
            else:
                left = (left + change) % a
        x = left * b + right
        if x < n:
            return x
