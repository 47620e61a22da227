"""Plain one-process versions that the operators are held against."""

from __future__ import annotations

import re
from collections.abc import Iterable


def find(pairs: Iterable[tuple[int, int]], nodes: Iterable[int]) -> dict[int, int]:
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def up(n: int) -> int:
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in root}


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def near(sets: dict[int, set], percent: int) -> dict[int, int]:
    ids = [i for i in sets if sets[i]]
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return find(pairs, sets)


def edit_distance_within(pattern: str, text: str) -> int:
    """Fewest edits of the pattern to any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
