"""Top-k search and hard negatives on odd vectors, against plain versions."""

import random

import numpy as np
import pytest

from gridloom.llm import hard_negatives, topk_search, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, score int, q string, own int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "q", 2) for r in rows], SCHEMA).repartition(3)


def whole(v):
    return None if v is None or any(x is None or not np.isfinite(x) for x in v) else [max(-(1 << 63), min((1 << 63) - 1, int(np.floor(256 * x)))) for x in v]


def product(a, b):
    return max(-vectors.MOST, min(vectors.MOST, sum(x * y for x, y in zip(a, b, strict=True))))


def order(row):
    return (-row[1], row[0] is None, row[0] or 0)


def mined(rows, is_anchor, positives=5, negatives=5, least=80, most=100):
    usable = [(i, whole(v), g) for i, v, g in rows if g is not None and whole(v) is not None]
    out = []
    for at, (i, v, g) in enumerate(usable):
        if not is_anchor(i):
            continue
        others = [(j, product(v, w), h) for k, (j, w, h) in enumerate(usable) if k != at and len(w) == len(v)]
        for j, s, _ in sorted((o for o in others if o[2] == g), key=order)[:positives]:
            band = [o for o in others if o[2] != g and least * s <= 100 * o[1] <= most * s]
            out += [(i, j, r, n[0], s, n[1]) for r, n in enumerate(sorted(band, key=order)[:negatives], 1)]
    return sorted(out, key=repr)


def odd_rows(seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.25, 0.5, 0.75]) for _ in range(11)], rng.randrange(3)) for i in range(240)]
    rows += [(20, rows[20][1], rows[20][2]), (20, rows[20][1], rows[20][2]), (30, rows[31][1], 1)]  # repeated ids
    rows += [(None, rows[40][1], 0), (None, rows[50][1], 1), ((1 << 53) + 1, rows[10][1], 1), ((1 << 53) + 3, rows[10][1], 2)]
    rows += [(1000 + k, rows[10][1], k % 3) for k in range(60)]  # one common vector
    rows += [(2000, None, 1), (2010, [1.0] * 11, None), (2020, [1.0, None], 1), (2030, [float("nan")] * 11, 2), (2040, [float("inf")] * 11, 2)]
    rows += [(2050, [2.0, 1.0], 1), (2051, [2.0, 1.0], 1), (2052, [1.9, 1.0], 2), (2060, [], 1), (2061, [], 1), (2062, [], 2)]
    return rows


@pytest.mark.parametrize("block_rows", [20_000, 9])
def test_hard_negatives(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "CHUNK", 16)
    rows = odd_rows(5)
    t = table(spark, rows)
    got = hard_negatives.hard_negatives(t, t.where("vec_id % 10 = 0"), block_rows=block_rows)
    want = mined(rows, lambda i: i is not None and i % 10 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 100
    assert hard_negatives.hard_negatives(t.limit(0), t.limit(0)).count() == 0



def test_scores_beyond_64_bits(spark):
    rows = [(10, [-1.0, 3e18], 1), (1, [-1e30, 0.0], 1), (2, [-2.0, 3e18], 1), (3, [5.0, 2.9e18], 2), (4, [0.0, 1.0], 2)]
    t = table(spark, rows)
    got = hard_negatives.hard_negatives(t, t.where("vec_id = 10"))
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows, lambda i: i == 10)
    top = topk_search.top_k(t, t.where("vec_id = 10"))
    q = {i: whole(v) for i, v, _ in rows}
    best = sorted(((i, product(q[10], v)) for i, v in q.items() if i != 10), key=order)
    assert [(r.vec_id, r.score) for r in top.orderBy("rank").collect()] == best


@pytest.mark.parametrize("kind", [np.int64, object])
def test_lookups_are_products(kind):
    rng = np.random.default_rng(3)
    for d in (0, 1, 8, 19):
        rows, anchors = rng.integers(-300, 200, (70, d)), rng.integers(-90, 90, (13, d))
        found = hard_negatives.looked_up(hard_negatives.planes(rows), hard_negatives.subset_sums(anchors, kind))
        assert (found.astype(np.int64) == rows @ anchors.T).all()
    assert hard_negatives.planes(np.array([[-(1 << 63), (1 << 63) - 1]])).shape == (64, 1, 1)


@pytest.mark.parametrize("block_rows", [20_000, 9])
def test_top_k_of_odd_vectors(spark, monkeypatch, block_rows):
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    rows = odd_rows(6)
    t = table(spark, rows)
    got = topk_search.top_k(t, t.where("vec_id % 10 = 0"), 5, 256, block_rows)
    usable, want = [(i, whole(v)) for i, v, _ in rows if whole(v) is not None], []
    for at, (i, v) in enumerate(usable):
        if i is not None and i % 10 == 0:
            others = [(j, product(v, w)) for k, (j, w) in enumerate(usable) if k != at and len(w) == len(v)]
            want += [(i, r, j, s) for r, (j, s) in enumerate(sorted(others, key=order)[:5], 1)]
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()), key=repr) == sorted(want, key=repr)
    null = table(spark, [(None, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (3, [0.5, 0.5], 1)])
    assert [tuple(r) for r in topk_search.top_k(null, null.where("vec_id = 50")).collect()] == [(50, 1, None, 65536), (50, 2, 3, 32768)]
    nothing = table(spark, [(50, [], 1), (51, [], 1), (52, [1.0], 1)])
    assert [tuple(r) for r in topk_search.top_k(nothing, nothing.where("vec_id = 50")).collect()] == [(50, 1, 51, 0)]


def test_equal_vectors_are_thinned():
    rows = np.array([[1, 2]] * 50 + [[3, 4]] * 2)
    ids, none = np.arange(52)[::-1].copy(), np.zeros(52, bool)
    assert sorted(ids[vectors.thin(rows, ids, none, 3)].tolist()) == [0, 1, 2, 3, 4]
