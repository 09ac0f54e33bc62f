"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def groups(nodes, links):
    """node -> least node that links reach."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_components(rows, percent=85):
    """doc_id -> component of (doc_id, text, ...) rows."""
    sets = [(doc_id, shingles(text)) for doc_id, text, *_ in rows if doc_id is not None]
    links = [
        (a, b)
        for i, (a, x) in enumerate(sets)
        for b, y in sets[:i]
        if x and y and a != b and 100 * len(x & y) >= percent * len(x | y)
    ]
    return groups({a for a, _ in sets}, links)


def removals(texts, length):
    """(bytes, removed, spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
