"""Plain versions of the operators, one row at a time."""

from __future__ import annotations

import hashlib

import xxhash


def words(text):
    return (text or "").encode().split()


def fingerprint(text, size=3):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))]
    shingles = shingles if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict, bits=2):
    """Smallest id reachable, over {id: print}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def repeats(docs: list[tuple], window=20):
    """{id: (words, removed, kept)} for (id, text) with distinct ids."""
    seen, result = set(), {}
    for key, text in sorted(docs):
        tokens = words(text)
        gone = [False] * len(tokens)
        for i in range(len(tokens) - window + 1):
            piece = tuple(tokens[i : i + window])
            if piece in seen:
                gone[i : i + window] = [True] * window
            seen.add(piece)
        kept = b" ".join(t for t, g in zip(tokens, gone, strict=True) if not g)
        result[key] = (len(tokens), sum(gone), kept.decode())
    return result


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
