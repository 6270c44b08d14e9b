"""Plain Python versions of the corpus operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> set[tuple]:
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def similar_groups(texts: list[str | None]) -> tuple[list[set], list[int]]:
    """(shingle sets, index of the first member of each row's component)."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            having[g].append(k)
    for b, s in enumerate(sets):
        for a, both in Counter(a for g in s for a in having[g] if a < b).items():
            if 100 * both >= 75 * (len(s) + len(sets[a]) - both) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sets, [find(k) for k in range(len(texts))]


def without_repeats(texts: list[str | None], length: int = 400) -> list[tuple[int, int, int, bytes]]:
    """(bytes, removed, runs, kept) per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def quality_measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
