"""SimHash near-duplicates by the generalised pigeonhole principle.

Each text has a 64-bit fingerprint; fingerprints that differ in at most `distance` bits are
linked. Correlated bits are put into the same of four blocks of 16 bits. A block is a partition, or
two blocks are one. If partitions have thresholds t with the sum distance + 1 less their number,
two linked fingerprints differ in at most t bits of one of them (-1: it need not be probed). Each
fingerprint gets the thresholds of its own least cost by dynamic programming: what a probe costs
and how many candidates it brings, which is counted over all fingerprints for each block's values.
It probes the values within its thresholds, and candidates are verified on all 64 bits. Before that, each is
compared with the least fingerprint of its value in each partition; those that this joins are not paired again.

A fingerprint that would bring too many candidates even so stands in a crowd. Those of crowds meet each
other at the points halfway between them instead: all who share such a point are
linked with one of them, so no pairs are made within a crowd and no link that joins components is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, ship
from .graph import components
from .textbytes import pieces

SEED = 42
BITS, BLOCKS, WIDTH = 64, 4, 16
#: The partitions between which the costs decide, as blocks.
SCHEMES = (((0,), (1,), (2,), (3,)), ((0, 1), (2, 3)))
#: A probe is a row that travels; it costs as much as so many candidates that are compared where they are.
PROBE = 20.0
#: More candidates than these cost more than the points halfway do.
CROWD = 1 << 16
STEP = 1 << 15
U = np.uint64


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of `words` words; of all words, if there are fewer; empty without words."""
    parts = text.lower().split()
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1) if parts else 0
    begins = np.concatenate(([0], ends + 1))[:n].tolist()
    ends = ends[words - 1 :].tolist() if len(parts) >= words else ends[-1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, ends, strict=True)), U, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[at : at + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(U)[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number, of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                texts = batch.column(1).slice(a, b - a).cast(pa.large_binary())
                found = np.array([fingerprint(shingle_hashes(t.as_py() or b"", words)) for t in texts], U)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def bits_of(fps: np.ndarray) -> np.ndarray:
    """(fingerprints, 64) zeros and ones, the lowest bit first."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def block_values(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    """(fingerprints, blocks) values of 16 bits, taken in this order."""
    return np.ascontiguousarray(np.packbits(bits_of(fps)[:, order], axis=1, bitorder="little")).view("<u2").astype(np.int64)


def tallied(classes: DataFrame, cells: int, count) -> np.ndarray:
    """Sums over all fingerprints of `count(fps)`, an array of so many numbers whatever the data."""

    def run(batches):
        total = np.zeros(cells)
        for batch in batches:
            total += count(batch.column(0).to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    found = classes.select("fp").mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def both_set(fps: np.ndarray) -> np.ndarray:
    """How many fingerprints have each two bits set, and their number."""
    bits = bits_of(fps).astype(np.float64)
    return np.concatenate(((bits.T @ bits).ravel(), [len(fps)]))


def bit_order(pairs: np.ndarray, n: float) -> np.ndarray:
    """All bits, those of a block side by side: each block takes the bits that correlate most with what it holds."""
    share = np.diag(pairs) / n
    spread = np.sqrt(share * (1 - share))
    scale = np.outer(spread, spread)
    like = np.abs(np.divide(pairs / n - np.outer(share, share), scale, out=np.zeros_like(scale), where=scale > 0))
    np.fill_diagonal(like, 0)
    left, order = list(range(BITS)), []
    for _ in range(BLOCKS):
        block = [max(left, key=lambda b: (like[b, left].sum(), -b))]
        left.remove(block[0])
        while len(block) < WIDTH:
            block.append(max(left, key=lambda b: (like[b, block].sum(), -b)))
            left.remove(block[-1])
        order += sorted(block)
    return np.array(order)


def value_counts(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    values = block_values(fps, order)
    return np.concatenate([np.bincount(values[:, b], minlength=1 << WIDTH) for b in range(BLOCKS)])


def at_distance(counts: np.ndarray, most: int) -> np.ndarray:
    """(blocks, most + 1, values): how many fingerprints differ from a value in exactly so many bits of the block."""
    found = np.zeros((BLOCKS, most + 1, 1 << WIDTH))
    found[:, 0] = counts.reshape(BLOCKS, -1)
    values = np.arange(1 << WIDTH)
    for bit in range(WIDTH):
        found[:, 1:] += found[:, :-1, values ^ (1 << bit)]
    return found.astype(np.float32)


def masks(width: int, most: int) -> list[np.ndarray]:
    """[all numbers of `width` bits with at most e bits set, for e up to `most`], each the beginning of the next."""
    out, found = [], []
    for e in range(min(width, most) + 1):
        found += [sum(1 << b for b in c) for c in combinations(range(width), e)]
        out.append(np.array([m - (1 << 64) if m >> 63 else m for m in found], np.int64))
    return out


class Plan:
    """Thresholds and probes for a way to cut fingerprints into partitions."""

    def __init__(self, scheme, order: np.ndarray, near: np.ndarray, n: float, distance: int, crowd: int):
        self.scheme, self.order, self.near, self.n, self.distance, self.crowd = scheme, order, near, n, distance, crowd
        self.masks = [masks(WIDTH * len(p), distance) for p in scheme]

    def keys(self, values: np.ndarray) -> list[np.ndarray]:
        """Each partition's value; blocks stand one above the other."""
        return [sum(values[:, b] << (WIDTH * k) for k, b in enumerate(p)) for p in self.scheme]

    def candidates(self, values: np.ndarray) -> list[np.ndarray]:
        """Per partition (distance + 2, fingerprints): the candidates within each threshold, from -1 on. Counts of
        single blocks are exact, those of two blocks are as if the blocks were independent."""
        out = []
        for part in self.scheme:
            exact = self.near[part[0]][:, values[:, part[0]]].astype(np.float64)
            for b in part[1:]:
                other = self.near[b][:, values[:, b]] / self.n
                exact = np.stack([sum(exact[j] * other[e - j] for j in range(e + 1)) for e in range(self.distance + 1)])
            out.append(np.concatenate((np.zeros((1, len(values))), np.cumsum(exact, axis=0))))
        return out

    def allocate(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprints, partitions) thresholds plus 1 of the least cost, that cost, and their candidates.

        Thresholds plus 1 add up to distance + 1: a dynamic programme over the partitions."""
        units, found = self.distance + 1, self.candidates(values)
        costs = [c + PROBE * np.array([0, *map(len, m)])[:, None] for c, m in zip(found, self.masks, strict=True)]
        best, chosen = costs[0], []
        for cost in costs[1:]:
            ways = [np.stack([best[total - s] + cost[s] for s in range(total + 1)]) for total in range(units + 1)]
            chosen.append(np.stack([w.argmin(0) for w in ways]))
            best = np.stack([w.min(0) for w in ways])
        rows, left, out = np.arange(len(values)), np.full(len(values), units), []
        for pick in reversed(chosen):
            out.append(pick[left, rows])
            left = left - out[-1]
        t = np.stack([left, *reversed(out)], axis=1)
        return t, best[units], sum(c[t[:, i], rows] for i, c in enumerate(found))

    def cost(self, fps: np.ndarray) -> np.ndarray:
        _, cost, candidates = self.allocate(block_values(fps, self.order))
        half = PROBE * len(masks(BITS, -(-self.distance // 2))[-1])
        return np.array([np.where(candidates > self.crowd, half, cost).sum()])


def posted(classes: DataFrame, plan, probing: bool) -> DataFrame:
    """key, fp, comp: every fingerprint under each partition's value, or, `probing`, under all values within its thresholds, where
    one of a crowd probes nothing."""

    def run(batches):
        p = plan.value
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                fps, comps = (batch.column(i).slice(at, STEP).to_numpy() for i in range(2))
                values = block_values(fps, p.order)
                if probing:
                    t, _, candidates = p.allocate(values)
                    open_ = candidates <= p.crowd
                for i, key in enumerate(p.keys(values)):
                    tag = i << (WIDTH * BLOCKS // len(p.scheme))
                    for s, mask in enumerate(p.masks[i], 1) if probing else ((0, np.zeros(1, np.int64)),):
                        of = np.flatnonzero(open_ & (t[:, i] == s)) if probing else np.arange(len(fps))
                        rows = max(1, (1 << 18) // len(mask))
                        for a in range(0, len(of), rows):
                            some = of[a : a + rows]
                            keys = (key[some][:, None] ^ mask[None, :]).ravel() + tag
                            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.repeat(x[some], len(mask))) for x in (fps, comps))], names=["key", "fp", "comp"])

    return classes.select("fp", "comp").mapInArrow(run, "key long, fp long, comp long")


def halfway(classes: DataFrame, plan) -> DataFrame:
    """Of each fingerprint of a crowd the points at most half the distance off: point, comp, near (at most the lower half)."""

    def run(batches):
        p = plan.value
        ball = masks(BITS, p.distance - p.distance // 2)
        near = np.arange(len(ball[-1])) < len(ball[p.distance // 2])
        for batch in batches:
            fps, comps = (batch.column(i).to_numpy() for i in range(2))
            crowded = np.flatnonzero(p.allocate(block_values(fps, p.order))[2] > p.crowd) if len(fps) else fps
            for at in range(0, len(crowded), 256):
                some = crowded[at : at + 256]
                points = (fps[some][:, None] ^ ball[-1][None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(np.repeat(comps[some], len(ball[-1]))), pa.array(np.tile(near, len(some)))], names=["point", "comp", "near"])

    return classes.select("fp", "comp").mapInArrow(run, "point long, comp long, near boolean")


def differing(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def best_plan(classes: DataFrame, distance: int, crowd: int, schemes):
    """The way to cut fingerprints that costs least over all of them, for the tasks."""
    tally = tallied(classes, BITS * BITS + 1, both_set)
    n = tally[-1]
    order = bit_order(tally[:-1].reshape(BITS, BITS), n)
    near = at_distance(tallied(classes, BLOCKS << WIDTH, lambda fps: value_counts(fps, order)), distance)
    plans = [classes.sparkSession.sparkContext.broadcast(Plan(s, order, near, n, distance, crowd)) for s in schemes]
    costs = [tallied(classes, 1, lambda fps, p=p: p.value.cost(fps))[0] for p in plans]
    return plans[int(np.argmin(costs))]


def grouped(classes: DataFrame, scratch: Scratch, distance: int, crowd: int = CROWD, schemes=SCHEMES) -> DataFrame:
    """fp, comp: the least fingerprint that links reach, of every one of `classes`, which are different."""
    plan = best_plan(classes, distance, crowd, schemes)
    alone = classes.select("fp", F.col("fp").alias("comp"))
    index = scratch.write(posted(alone, plan, False).select("key", "fp"), "index")
    pivots = index.groupBy("key").agg(F.min("fp").alias("a"))
    stars = index.join(pivots, "key").where("a <> fp").where(differing("a", "fp") <= distance).select("a", F.col("fp").alias("b")).distinct()
    first = components(stars, scratch, "first")
    named = scratch.write(classes.select("fp").join(first.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp")), "named")
    scratch.drop("index")
    # what stands in one component already is not paired again
    probes = posted(named, plan, True).select("key", F.col("fp").alias("q"), F.col("comp").alias("other"))
    met = posted(named, plan, False).join(probes, "key").where(F.col("comp") != F.col("other")).where(differing("fp", "q") <= distance)
    links = scratch.write(met.select(F.least("comp", "other").alias("a"), F.greatest("comp", "other").alias("b")).distinct(), "links")
    points = scratch.write(halfway(named, plan), "halfway")
    if not points.isEmpty():
        # all others of a point are linked with one that is near
        pivots = points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("comp"))).alias("a")).where("a is not null")
        links = scratch.write(points.join(pivots, "point").where("a <> comp").select("a", F.col("comp").alias("b")).distinct(), "links", "append")
    scratch.drop("halfway")
    second = components(links, scratch, "second").select(F.col("node").alias("comp"), F.col("comp").alias("lower"))
    return scratch.write(named.join(second, "comp", "left").select("fp", F.coalesce("lower", "comp").alias("comp")), "grouped")


def near_fingerprints(docs: DataFrame, words: int = 4, distance: int = 4, crowd: int = CROWD) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Words stand between ASCII white space, A-Z counts as a-z. The shingles of a text, repeats
    included, are its runs of `words` words, or all its words if they are fewer; their XXH64 hashes vote for
    each bit. Null, empty and blank texts have the fingerprint 0, which links like any other.
    component_id is the least doc_id that links of at most `distance` different bits reach, the
    row's own included; rows that share an id each have their fingerprint and may join components; rows without an
    id join what they link and get the component's id, null where it has none. An empty table gives an
    empty result; other columns don't matter.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    signed = scratch.write(fingerprints(docs, words), "signed")
    classes = scratch.write(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    if classes.isEmpty():
        return signed.select("doc_id", digits, F.col("doc_id").alias("component_id"))
    named = classes.join(grouped(classes, scratch, distance, crowd), "fp")
    lowest = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_class = scratch.write(named.join(lowest, "comp").select("fp", "component_id"), "of-class")
    return signed.join(of_class, "fp").select("doc_id", digits, "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document, by shingles of 4 words and at most 4 different bits; see near_fingerprints."""
    return near_fingerprints(documents(spark, sf_dir))
