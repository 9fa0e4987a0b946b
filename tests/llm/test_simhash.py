"""SimHash links against all pairs, with crowds and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import helpers as h

from gridloom.llm import simhash
from gridloom.llm.common import Scratch

LONG = "long word " * 100_000


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def families(rng, groups=12, size=25):
    """Fingerprints around centres, some of them close, some of correlated bits."""
    out = {0}
    for _ in range(groups):
        centre = rng.getrandbits(64) & (rng.getrandbits(64) | 0xFFFF0000)
        for _ in range(rng.randint(1, size)):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            out.add(x)
    return {i: signed(x) for i, x in enumerate(sorted(out))}


@pytest.mark.parametrize("crowd", [1 << 16, 20, 0])
@pytest.mark.parametrize(("distance", "schemes"), [(4, simhash.SCHEMES), (3, simhash.SCHEMES[:1]), (4, simhash.SCHEMES[1:])])
def test_links_equal_all_pairs(spark, crowd, distance, schemes):
    fps = families(random.Random(distance + crowd))
    want = h.linked(fps, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    scratch = Scratch(spark, "test")
    table = scratch.write(spark.createDataFrame([(f,) for f in fps.values()], "fp long"), "fps")
    label = {r.fp: r.comp for r in simhash.grouped(table, scratch, distance, crowd, schemes).collect()}
    got: dict = {}
    for i, f in fps.items():
        got.setdefault(label[f], []).append(i)
    groups: dict = {}
    for i, g in want.items():
        groups.setdefault(g, []).append(i)
    assert sorted(got.values()) == sorted(groups.values()) and len(groups) < len(fps)


def test_thresholds():
    rng = np.random.default_rng(2)
    fps = rng.integers(-(1 << 63), 1 << 63, 500)
    pairs = simhash.both_set(fps)
    order = simhash.bit_order(pairs[:-1].reshape(64, 64), pairs[-1])
    assert sorted(order) == list(range(64))
    counts = simhash.value_counts(fps, order)
    near = simhash.at_distance(counts, 4)
    values = simhash.block_values(fps, order)
    for e in range(5):
        assert near[1, e, values[0, 1]] == sum(bin(int(v)).count("1") == e for v in values[:, 1] ^ values[0, 1])
    plan = simhash.Plan(simhash.SCHEMES[0], order, near, 500.0, 4, 10)
    t, cost, found = plan.allocate(values)
    assert (t.sum(1) == 5).all() and (t >= 0).all()
    ways = [(a, b, c, 5 - a - b - c) for a in range(6) for b in range(6 - a) for c in range(6 - a - b)]
    each = [c + simhash.PROBE * np.array([0, *map(len, m)])[:, None] for c, m in zip(plan.candidates(values), plan.masks, strict=True)]
    assert np.allclose(cost, np.min([sum(each[i][w[i]] for i in range(4)) for w in ways], axis=0))


def test_odd_texts(spark):
    base = " ".join(f"w{i % 97}x{i}" for i in range(300))
    texts = [None, "", " \t\n", LONG, base, base, base.upper(), base + " more", "one", "One", "two words", "é É ½ \x1c don't", "x" * 1_500_000, base]
    docs = h.docs_of(spark, texts, ids=[*range(20, 33), None])
    got = simhash.near_fingerprints(docs).collect()
    prints = {i: h.simhash(t, 4) for i, t in zip(range(20, 33), texts[:13], strict=True)}
    want = h.linked(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got if r.doc_id is not None} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
    assert [(r.fingerprint, r.component_id) for r in got if r.doc_id is None] == [(f"{prints[24]:016x}", want[24])]
    assert prints[20] == 0 and want[22] == 20
    assert simhash.near_fingerprints(docs.limit(0)).count() == 0
    alone = simhash.near_fingerprints(docs.where("doc_id is null")).collect()
    assert [r.component_id for r in alone] == [None]
    again = simhash.near_fingerprints(docs.where("doc_id = 24").union(docs.where("doc_id = 24")).withColumn("doc_id", F.lit(7)))
    assert [r.component_id for r in again.collect()] == [7, 7]
