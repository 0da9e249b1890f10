"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints):
    """Index of the component's first member for each fingerprint."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def contamination(text, items, width=10):
    """(words, hit words, items) of a text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    mine, hit, found = word.findall(lower(text)), set(), set()
    for item, said in items:
        its = word.findall(lower(said))
        for i in range(max(len(its) - width, 0) + 1 if its else 0):
            window = its[i : i + width]
            for k in range(len(mine) - len(window) + 1):
                if mine[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found.add("" if item is None else str(item))
    return len(mine), len(hit), sorted(found)


def repeats(texts, length=400):
    """(bytes, removed, spans, kept) of each text."""
    whole = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in whole for i in range(len(b) - length + 1))
    out = []
    for b in whole:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
