"""Collocations against a plain count, with odd rows and repeated passages."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from tests.llm import helpers as h

from gridloom.llm import collocations


def plain(rows, longest=4, least=30, cover=80, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(h.LOW)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f.setdefault(lang or "und", Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        some = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer: dict = {}
        for p, a in some.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(a, longer.get(p[i : i + size], 0))
        found = []
        for p, a in some.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer.get(p, 0) < cover * a:
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    passage = " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(60))
    ends = [" ", "  ", "\t", ", ", ". ", "\n", ": ", "! ", "?\r\n"]
    rows = []
    for k in range(400):
        words = [f"{rng.choice('Ww')}{min(rng.randrange(1, 40), rng.randrange(1, 40))}" for _ in range(rng.randrange(120))]
        text = "".join(w + rng.choices(ends, (9, 1, 1, 1, 1, 1, 1, 1, 1))[0] for w in words)
        rows.append((rng.choice(["en", "de", None]), text + (passage if k % 2 else "") + rng.choice(ends)))
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("und", "one two"), ("fr", "x " * 40_000), ("fr", "ÉCLAIR éclair \x1c  don't ½" * 31), ("es", "y" * 1_500_000)]
    return rows + [rows[3], rows[3]]


@pytest.mark.parametrize(("trigger", "least", "top"), [(16, 30, 2000), (3, 4, 2000), (1, 2, 7), (10**9, 4, 2000)])
def test_equals_a_plain_count(spark, monkeypatch, trigger, least, top):
    rows = corpus(trigger)
    docs = h.docs_of(spark, [t for _, t in rows], ids=[None, *range(1, len(rows))], langs=[g for g, _ in rows])
    got = collocations.collocations(docs, least=least, top=top, trigger=trigger)
    want = plain(rows, least=least, top=top)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20
    if trigger == 16:
        assert collocations.collocations(docs.limit(0)).count() == 0


def test_few_cells_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CELLS", 64)
    rows = corpus(5)
    docs = h.docs_of(spark, [t for _, t in rows], langs=[g for g, _ in rows])
    assert sorted(map(tuple, collocations.collocations(docs, least=5).collect())) == plain(rows, least=5)


def test_chunks_hold_each_phrase_once():
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(1000)}" for _ in range(400))
    texts = [f"{rng.random()} {passage} {rng.random()}" for _ in range(6)] + ["a b. c", None, "..", "x"]
    found: Counter = Counter()
    cut: Counter = Counter()
    for _, own, text in collocations.chunks(pa.array(texts), 4, 16):
        for n, t in zip(own.tolist(), text.to_pylist(), strict=True):
            w = t.split(" ")
            cut[t] += 1
            found.update(tuple(w[i : i + k]) for i in range(n) for k in range(1, 5) if i + k <= len(w))
    want: Counter = Counter()
    for t in texts:
        for piece in re.split("[.]", t or ""):
            w = piece.split()
            want.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert found == want
    # the passage is cut alike in all texts that hold it
    assert sum(1 for n in cut.values() if n == 6) > 10
