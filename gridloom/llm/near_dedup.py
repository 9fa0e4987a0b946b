"""Near-duplicates by min-max hashing, confirmed on full shingle sets.

Every text becomes its set of word shingles. Equal sets form a class at once. Under
each permutation both the least and the greatest hash are kept, so one evaluation
gives two signature values; bands of four values put classes into buckets. Of a
bucket not all pairs are made: members are first compared with the bucket's pivot,
then, where a bucket still spans several components, with members of many links,
and last all pairs that stand in different components and were not compared yet. Those of buckets that are
still large are found by an exact prefix filter on their rarest shingles instead, which
also heeds where in both sets the first common shingle stands.
So no link that could join components is passed over. Before sets are fetched, the parities
of a set's hashes in 1024 cells bound from below in how many shingles two sets differ.
Every link is confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, lean, ship
from .graph import components
from .textbytes import SPACE, U, mix, ngram_hashes, pieces, text_buffer, word_hashes

HASHES = 64
BAND = 4
HUBS = 8
HOT = 512
LIMIT = 2 << 20
ROWS = 2048
CELLS = 1024
FACTORS = mix(np.arange(1, HASHES + 1, dtype=U)) | U(1)
ADDENDS = mix(np.arange(1001, HASHES + 1001, dtype=U))


def shingle_sets(column: pa.Array, words: int):
    """(a, b, [sorted distinct shingle hashes of each text]) of slices of the column."""
    for a, b in pieces(column, LIMIT, ROWS):
        hashes, first, *_ = word_hashes(*text_buffer(column.slice(a, b - a)), SPACE)
        grams, start = ngram_hashes(hashes, first, words)
        yield a, b, [np.unique(grams[x:y]) for x, y in zip(start[:-1], start[1:], strict=True)]


def digests(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes that are equal for equal sets; None for an empty one."""
    return [np.array([mix(s ^ U(1)).sum(dtype=U) + U(len(s)), mix(s ^ U(2)).sum(dtype=U)], ">u8").tobytes() if len(s) else None for s in sets]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One key for each band of each (not empty) set; equal keys only within a band."""
    flat = np.concatenate(sets)
    start = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = []
    for k in range(0, HASHES, BAND // 2):
        key = np.full(len(sets), U(k + 1))
        for j in range(k, k + BAND // 2):
            y = flat * FACTORS[j] + ADDENDS[j]
            key = mix(key * U(3) + np.minimum.reduceat(y, start))
            key = mix(key * U(5) + np.maximum.reduceat(y, start))
        keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """CELLS bits of each set: whether an odd number of its hashes falls into the cell."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cell = (np.concatenate(sets) >> U(54)).astype(np.int64) + owner * CELLS
    odd = (np.bincount(cell, minlength=len(sets) * CELLS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, CELLS), axis=1).view(np.int64)


def flat_lists(rows: np.ndarray, some: np.ndarray) -> pa.Array:
    """An array column: a row of `rows` where `some`, else an empty list."""
    ends = np.concatenate(([0], np.cumsum(np.where(some, rows.shape[1], 0))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.ravel()))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, n (size of its set), c (its class; null for an empty set), bands, odd."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b, sets in shingle_sets(batch.column(1), words):
                full = [s for s in sets if len(s)]
                some = np.array([len(s) > 0 for s in sets])
                keys = band_keys(full) if full else np.zeros((0, HASHES * 2 // BAND), np.int64)
                odd = parities(full) if full else np.zeros((0, CELLS // 64), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests(sets), pa.binary()), flat_lists(keys, some), flat_lists(odd, some)],
                    names=["doc_id", "n", "c", "bands", "odd"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n long, c binary, bands array<long>, odd array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """c and its sorted shingle hashes, of each row with words."""

    def run(batches):
        for batch in batches:
            for _, _, sets in shingle_sets(batch.column(0), words):
                full = [s for s in sets if len(s)]
                if full:
                    ends = np.cumsum([0] + [len(s) for s in full])
                    values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(full).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(digests(full), pa.binary()), values], names=["c", "shingles"])

    return docs.select("text").mapInArrow(lean(run), "c binary, shingles array<long>")


def may_link(n_a, n_b, odd_a, odd_b, percent: int):
    """No two sets of the needed similarity fail this: their sizes are like, and the
    difference that parities show is no greater than such sets can have."""
    differ = sum((F.bit_count(odd_a[i].bitwiseXOR(odd_b[i])) for i in range(CELLS // 64)), F.lit(0))
    return size_fits(n_a, n_b, percent) & ((100 + percent) * differ <= (100 - percent) * (n_a + n_b))


def size_fits(n_a, n_b, percent: int):
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with `ok`: 100 * intersection >= percent * union."""
    one = pairs.join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("of_b")), "b")
    two = one.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return two.select("a", "b", (100 * common >= percent * union).alias("ok"))


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    component_id is the least doc_id that links of similarity percent/100 or more reach,
    the row's own included; kept: the row has it. Words stand between ASCII white
    space, A-Z counts as a-z. A text of fewer than `words` words, but some, is one
    shingle; null, empty and blank texts have none and are linked with nothing. Rows
    with the same doc_id and class are alike; ids must not be null to be linked. An
    empty table gives an empty result; other columns don't matter.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    docs = docs.select("doc_id", "text")
    signed = scratch.write(signatures(docs, words), "signed")
    classes = scratch.write(
        signed.where("c is not null").groupBy("c", "n").agg(F.min("doc_id").alias("least"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd")), "classes"
    )
    rows = classes.select("c", "n", F.explode("bands").alias("key"))
    buckets = scratch.write(
        rows.groupBy("key").agg(F.min(F.struct("c", "n")).alias("pivot"), F.count("*").alias("size")).where("size > 1").select("key", "pivot"), "buckets"
    )
    members = scratch.write(rows.join(buckets, "key").select("key", "c", "n", F.col("pivot.c").alias("p"), F.col("pivot.n").alias("pn")), "members")
    scratch.drop("buckets")
    wanted = scratch.write(members.select("c").distinct().join(classes.select("c", "least"), "c").select(F.col("least").alias("doc_id")).distinct(), "wanted")
    sets = scratch.write(full_sets(docs.join(wanted, "doc_id", "left_semi"), words), "all-sets")
    scratch.drop("wanted")

    pairs = members.where("c <> p").where(size_fits(F.col("n"), F.col("pn"), percent)).select(F.col("p").alias("a"), F.col("c").alias("b"))
    # each with the least of its pivots first, then with those that this has not joined it to: most of a large group needs no second one
    seen = scratch.write(confirm(pairs.groupBy("b").agg(F.min("a").alias("a")), sets, percent), "seen-0")
    labels = components(seen.where("ok"), scratch, "labels-0")
    more = scratch.write(apart(pairs.distinct(), labels), "apart")
    if not more.isEmpty():
        found = scratch.write(confirm(more.join(seen.select("a", "b"), ["a", "b"], "left_anti"), sets, percent), "seen-1")
        labels, seen = merged(labels, found.where("ok"), scratch, "labels-1"), seen.union(found)
    for turn, make in enumerate((lambda spread, seen: hub_pairs(spread, seen, percent), lambda spread, seen: open_pairs(spread, sets, percent)), 1):
        spread = scratch.write(spanning(members, labels).join(classes.select("c", "odd"), "c"), f"spread-{turn}")
        if spread.isEmpty():
            break
        more = make(spread, seen).join(seen.select("a", "b"), ["a", "b"], "left_anti")
        found = scratch.write(confirm(more, sets, percent), f"found-{turn}")
        scratch.drop(f"spread-{turn}")
        if found.where("ok").isEmpty():
            seen = seen.union(found)
            continue
        seen = seen.union(found)
        labels = merged(labels, found.where("ok"), scratch, f"labels-{turn + 1}")
    scratch.drop("members", "all-sets")

    named = scratch.write(classes.select("c", "least").join(labels.withColumnRenamed("node", "c"), "c", "left").select("c", "least", F.coalesce("comp", "c").alias("comp")), "named")
    lowest = scratch.write(named.groupBy("comp").agg(F.min("least").alias("component_id")), "lowest")
    of_class = scratch.write(named.join(lowest, "comp").select("c", "component_id"), "of-class")
    result = signed.select("doc_id", "n", "c").join(of_class, "c", "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, comp_a, comp_b); a class without a label is a component of its own."""
    for end in "ab":
        own = labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    return pairs


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends stand in different components."""
    return labelled(pairs, labels).where("comp_a <> comp_b").select("a", "b")


def merged(labels: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The labels after more links; only components are joined, not all that stand in them."""
    ends = scratch.write(labelled(links.select("a", "b"), labels), f"{name}-ends")
    lower = components(ends.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), scratch, f"{name}-comps")
    lower = lower.select(F.col("node").alias("comp"), F.col("comp").alias("lower"))
    both = labels.union(ends.select("a", "comp_a")).union(ends.select("b", "comp_b")).distinct()
    return scratch.write(both.join(lower, "comp", "left").select("node", F.coalesce("lower", "comp").alias("comp")), name)


def spanning(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, c, n, comp) of the buckets whose members are in more than one component."""
    own = members.select("key", "c", "n").join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    wide = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return own.join(wide, "key")


def ordered(left, right):
    return F.least(left, right).alias("a"), F.greatest(left, right).alias("b")


def hub_pairs(spread: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """Members outside a bucket's main component with the main component's members of most links."""
    links = seen.where("ok").select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("links"))
    sizes = spread.groupBy("key", "comp").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("m")).where("m.size > 1").select("key", F.col("m.comp").alias("main"))
    best = (
        spread.join(main, "key")
        .where("comp = main")
        .join(links, "c")
        .groupBy("key", "main", F.pmod(F.xxhash64("c"), F.lit(HUBS)).alias("salt"))
        .agg(F.max(F.struct("links", "c", "n", "odd")).alias("hub"))
    )
    out = spread.join(best, "key").where("comp <> main").where(may_link(F.col("n"), F.col("hub.n"), F.col("odd"), F.col("hub.odd"), percent))
    return out.select(*ordered(F.col("c"), F.col("hub.c"))).distinct()


def open_pairs(spread: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that are in different components and may be linked."""
    sizes = spread.groupBy("key").agg(F.count("*").alias("size"))
    some = spread.join(sizes.where(F.col("size") <= HOT), "key").drop("size")
    other = some.select("key", F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("odd").alias("odd2"))
    near = some.join(other, "key").where("c < c2 and comp <> comp2").where(may_link(F.col("n"), F.col("n2"), F.col("odd"), F.col("odd2"), percent))
    out = near.select(*ordered(F.col("c"), F.col("c2")))
    large = sizes.where(F.col("size") > HOT)
    return (out if large.isEmpty() else out.union(prefix_pairs(spread.join(large, "key").select("c", "n", "comp", "odd").dropDuplicates(["c"]), sets, percent))).distinct()


def room(n: str, place: str):
    """How many shingles two sets can share at most, as far as this one tells, if their first common one stands there."""
    return F.col(n) - F.col(place) + 1


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of members in different components that share one of the shingles, rarest first, among which
    sets of the needed similarity must share one, if what stands behind it leaves room for enough other common ones and their
    parities are like. The smaller set of a pair has its first common shingle earlier than the larger one may have it."""
    shingles = members.select("c", "n", "comp").join(sets.dropDuplicates(["c"]), "c").select("c", "n", "comp", F.explode("shingles").alias("s"))
    counts = shingles.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # those that no other member holds are the rarest and meet nothing
    met = shingles.join(counts, "s")
    place = F.row_number().over(W.partitionBy("c").orderBy("df", "s")) + F.col("n") - F.count("*").over(W.partitionBy("c"))
    prefix = met.withColumn("place", place).where(100 * room("n", "place") >= percent * F.col("n")).select("s", "c", "n", "comp", "place")
    # of two sets of these sizes at least percent / (100 + percent) of both together must be common
    index = prefix.where((100 + percent) * room("n", "place") >= 2 * percent * F.col("n"))
    other = prefix.select("s", *(F.col(x).alias(f"{x}2") for x in ("c", "n", "comp", "place")))
    fits = size_fits(F.col("n"), F.col("n2"), percent) & ((100 + percent) * F.least(room("n", "place"), room("n2", "place2")) >= percent * (F.col("n") + F.col("n2")))
    near = index.join(other, "s").where("comp <> comp2 and (n < n2 or n = n2 and c < c2)").where(fits).select("c", "n", "c2", "n2").distinct()
    odd = members.select("c", "odd")
    both = near.join(odd, "c").join(odd.select(F.col("c").alias("c2"), F.col("odd").alias("odd2")), "c2")
    return both.where(may_link(F.col("n"), F.col("n2"), F.col("odd"), F.col("odd2"), percent)).select(*ordered(F.col("c"), F.col("c2")))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document, by shingles of 2 words; see near_duplicates."""
    return near_duplicates(documents(spark, sf_dir))
