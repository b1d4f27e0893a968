"""Plain re-statements of the contracts, for small fixtures."""

import hashlib
import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, k):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def join(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeats(rows, width):
    """Per row: (bytes, removed, spans, sha256 of the rest)."""
    seen = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for n, (_, b) in enumerate(raw):
        for p in range(len(b) - width + 1):
            seen.setdefault(b[p : p + width], []).append((n, p))
    mask = [bytearray(len(b)) for _, b in raw]
    for where in seen.values():
        if len(where) > 1:
            for n, p in where:
                mask[n][p : p + width] = b"\1" * width
    return {i: (len(b), sum(m), len(re.findall(b"\1+", bytes(m))), hashlib.sha256(bytes(x for x, y in zip(b, m, strict=True) if not y)).hexdigest()) for (i, b), m in zip(raw, mask, strict=True)}
