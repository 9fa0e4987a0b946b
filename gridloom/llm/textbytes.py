"""Byte-level access to Arrow text columns.

Texts stay in the UTF-8 buffers in which Arrow delivers them; numpy works on
the whole batch at once and no Python string is made for a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, int64 offsets); null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = column.cast(pa.large_string())
    n = len(wide)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = wide.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, wide.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(column: pa.Array, limit: int, rows: int | None = None):
    """Slices of a column, each of whole texts: up to `limit` bytes and `rows` rows, or one longer text."""
    _, off = text_buffer(column)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        to = min(to, at + rows) if rows else to
        yield at, to
        at = to


U = np.uint64
RADIX = 0x9E3779B97F4A7C15 | 1
STEP = 1 << 18
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; each bit of the result depends on all bits of x."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


VALUE = mix(np.arange(1, 257, dtype=U) * U(RADIX))
POWER = np.concatenate((np.ones(1, U), np.cumprod(np.full(2 * STEP, RADIX, U))))
INVERSE = np.concatenate((np.ones(1, U), np.cumprod(np.full(2 * STEP, pow(RADIX, -1, 1 << 64), U))))


def word_hashes(raw: np.ndarray, off: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(64-bit hash of each word, first word of each text; then, for each prefix length, the
    hash of each word's first bytes). A-Z count as a-z. `ends`: bytes that end a word."""
    (hashes, *more), begin, _ = word_spans(raw, off, ends, prefixes)
    return hashes, np.searchsorted(begin, off), *more


def word_spans(raw: np.ndarray, off: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """([hash of each word, then of its first bytes for each prefix length], where words begin, where they end).

    A word's hash is a polynomial over its bytes, from prefix sums over the buffer.
    """
    out: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
    places, stops = [], []
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    at = 0
    while at < len(raw):
        to = min(at + STEP, len(raw))
        while to < len(raw) and not ends[raw[to]] and not edge[to]:
            more = np.flatnonzero(ends[raw[to : to + 4096]] | edge[to : to + len(raw[to : to + 4096])])
            to = to + int(more[0]) if len(more) else min(to + 4096, len(raw))
        block = raw[at:to]
        inside = ~ends[block]
        begin = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1] | edge[at + 1 : to])))
        stop = np.flatnonzero(inside & np.concatenate((~inside[1:] | edge[at + 1 : to], [True]))) + 1
        value = VALUE[LOWER[block]]
        if len(block) < len(POWER):
            total = np.concatenate((np.zeros(1, U), np.cumsum(value * POWER[: len(block)], dtype=U)))
            for k, size in enumerate((None, *prefixes)):
                end = stop if size is None else np.minimum(stop, begin + size)
                out[k].append(mix((total[end] - total[begin]) * INVERSE[begin]))
        else:  # one word of more than 2 * STEP bytes
            for k, size in enumerate((None, *prefixes)):
                out[k].append(np.array([long_hash(value[a : b if size is None else min(b, a + size)]) for a, b in zip(begin, stop, strict=True)], U))
        places.append(begin + at)
        stops.append(stop + at)
        at = to
    joined = [np.concatenate(x) if x else np.zeros(0, U) for x in out]
    return joined, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, stops))


def long_hash(value: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    for a in range(0, len(value), STEP):
        part = value[a : a + STEP]
        total += scale * int(np.sum(part * POWER[: len(part)], dtype=U))
        scale = scale * pow(RADIX, len(part), 1 << 64) % (1 << 64)
    return mix(np.array([total % (1 << 64)], U))[0]


def ngram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of n words within a text, first run of each text).

    A text with fewer words, but some, has one run of all of them.
    """
    counts = np.diff(first)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    start = np.concatenate(([0], np.cumsum(runs)))
    owner = np.repeat(np.arange(len(counts)), runs)
    at = first[:-1][owner] + np.arange(start[-1]) - start[owner]
    have = np.minimum(counts[owner], n)
    total = mix(have.astype(U))
    for k in range(n):
        total = np.where(k < have, mix(total * U(RADIX) + words[np.minimum(at + k, max(0, len(words) - 1))]) if len(words) else total, total)
    return total, start
