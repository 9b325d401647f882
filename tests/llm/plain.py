"""Plain versions of the operators, on Python lists."""

from __future__ import annotations

import re
import zlib


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text: str | None) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % folds


def near_classes(texts: dict) -> dict:
    """Smallest id of the texts linked to each text by a similarity of 0.8 or more."""
    sets = {k: shingles(t) for k, t in texts.items()}
    ids = sorted(sets)
    root = {k: k for k in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in ids}


def hits(text: str | None, items: list[str | None]) -> tuple[int, set[int]]:
    """Number of words inside occurrences of items' windows, and which items occur."""
    w, hit, found = words(text), set(), set()
    for k, item in enumerate(items):
        iw = words(item)
        n = min(10, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(k)
    return len(hit), found
