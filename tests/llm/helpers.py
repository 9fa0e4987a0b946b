"""Small tables with odd rows, and plain versions of the operators."""

from __future__ import annotations

import re

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string, n int, c string, key int, size int, items string, _keep string"


def docs_of(spark, texts, ids=None, langs=None):
    """Documents with columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = langs or [None] * len(texts)
    rows = [(i, t, g, None, len(t or ""), "w", 1, "c", 2, 3, "i", "k") for i, t, g in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(text: str | None, n: int) -> frozenset:
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_components(texts: dict[int, str | None], n: int, percent: int = 80) -> dict[int, int]:
    sets = {i: shingles(t, n) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def removed(texts: dict[int, str | None]) -> set[tuple[int, int]]:
    """(doc, line) of the lines that resemble an earlier one."""
    lines = [(i, k, frozenset(x for x in re.split(r"[ \t\r\f\v]+", line.lower()) if x)) for i in sorted(texts) for k, line in enumerate((texts[i] or "").split("\n"))]
    out = set()
    for at, (i, k, s) in enumerate(lines):
        if s and any(t and 5 * len(s & t) >= 4 * len(s | t) for _, _, t in lines[:at]):
            out.add((i, k))
    return out


def contamination(texts, items, window=10):
    """{doc: (words, hit words, items)}"""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows: dict[tuple, set] = {}
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).update(() if item is None else (item,))
    out = {}
    for i, t in texts.items():
        w, hit, found = words(t), set(), set()
        for key, own in windows.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k : k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    found |= own
        out[i] = (len(w), len(hit), found)
    return out


def simhash(text: str | None, words: int) -> int:
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    runs = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def linked(values: dict, alike) -> dict:
    """{key: least key that links reach}"""
    parent = {i: i for i in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(values)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if alike(values[a], values[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
