"""Hard negatives by exact scores that are looked up and added (four Russians).

Eight dimensions of an anchor have 256 subset sums. A candidate's components are cut into
bit planes; the bits of one plane and eight dimensions are a byte, and that byte looks up
what the plane adds to the score. From the highest plane down, sums are doubled and the next
plane's lookups added, so a full exact score takes no multiplication. Every anchor is scored
against every row, a block of anchors at a time: first for its positives, then for the rows of
another label whose score lies in the band of a positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, ship
from .vectors import BLOCK_BYTES, BLOCK_ROWS, WIDE, Best, blocks, clipped, matrix, numbers, optional, quantised, reach, slices, thin

TABLE_BYTES = 16 << 20
CHUNK = 256


def planes(rows: np.ndarray) -> np.ndarray:
    """(planes, rows, groups) bytes: the bits of eight dimensions each, in two's complement, lowest plane first."""
    n, d = rows.shape
    high, low = int(rows.max(initial=0)), int(rows.min(initial=0))
    count = max(high.bit_length(), (-low - 1).bit_length() if low else 0) + 1
    return np.stack([np.packbits(((rows >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(count)]) if d else np.zeros((count, n, 0), np.uint8)


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): the sum of those of a group's eight dimensions that a byte names."""
    n, d = anchors.shape
    groups = -(-d // 8)
    wide = np.zeros((n, groups * 8), kind)
    wide[:, :d] = anchors
    tables = np.zeros((groups, 256, n), kind)
    for j in range(8):
        tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + wide[:, j::8].T[:, None, :]
    return tables


def looked_up(codes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(rows, anchors): the scores of the rows with these planes."""
    total = np.zeros((codes.shape[1], tables.shape[2]), tables.dtype)
    for g, table in enumerate(tables):
        part = -table[codes[-1, :, g]]  # the sign's plane
        for code in codes[-2::-1, :, g]:
            part += part
            part += table[code]
        total += part
    return total


def scored(rows: np.ndarray, anchors: np.ndarray):
    """(slice of rows, slice of anchors, their 64-bit scores), piece by piece; scores beyond 64 bits saturate."""
    most = 2 * reach(rows, anchors)
    kind = np.int32 if most < float(1 << 31) else np.int64 if most < WIDE else object
    step = max(1, TABLE_BYTES // (max(1, -(-rows.shape[1] // 8)) * 256 * 8))
    codes = planes(rows)
    for a in range(0, len(anchors), step):
        tables = subset_sums(anchors[a : a + step], kind)
        for r in range(0, len(rows), CHUNK):
            found = looked_up(codes[:, r : r + CHUNK], tables)
            yield slice(r, r + CHUNK), slice(a, a + step), clipped(found) if kind is object else found


class Block:
    """Anchors of one block: ids, labels, components, and after the first pass the positives' scores."""

    def __init__(self, table: pa.Table, size: int):
        self.ids, self.no_id = numbers(table.column("vec_id"))
        self.labels, _ = numbers(table.column("label"))
        self.rows = matrix(table.column("q"), size)


def read(table: pa.Table, size: int, k: int):
    """ids, whether there is none, labels and components of a slice; of equal vectors of a label those of the k least ids."""
    (ids, none), (labels, _) = numbers(table.column("vec_id")), numbers(table.column("label"))
    rows = matrix(table.column("q"), size)
    some = thin(np.column_stack((labels, rows)), ids, none, k)
    return ids[some], none[some], labels[some], rows[some]


def find_positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """Of each partition the k best rows of each anchor's label: anchor, vec_id, score, own (the anchor's id and score)."""

    def run(batches):
        block, best = shared.value, Best(len(shared.value.ids), k)
        own = np.array([next(scored(a[None], a[None]))[2][0, 0] for a in block.rows], np.int64)
        for table in slices(batches, block.rows.shape[1]):
            ids, none, labels, vectors = read(table, block.rows.shape[1], k)
            for label in np.intersect1d(labels, block.labels):
                at, of = np.flatnonzero(labels == label), np.flatnonzero(block.labels == label)
                for r, a, scores in scored(vectors[at], block.rows[of]):
                    best.add(of[a], scores.T.astype(np.int64), ids[at[r]], none[at[r]])
        best.merge()
        same = ~best.none & ~block.no_id[best.row] & (best.vec == block.ids[best.row]) | best.none & block.no_id[best.row]
        same &= best.score == own[best.row]
        yield pa.RecordBatch.from_arrays([pa.array(best.row), optional(best.vec, best.none), pa.array(best.score), pa.array(same)], names=["anchor", "vec_id", "score", "own"])

    return rows.mapInArrow(run, "anchor long, vec_id long, score long, own boolean")


def find_negatives(rows: DataFrame, shared, k: int) -> DataFrame:
    """Of each partition the k best rows of another label in the band of each positive: positive, vec_id, score."""

    def run(batches):
        block, (anchor, least, most) = shared.value
        best = Best(len(anchor), k)
        # the n-th positive of each anchor that has one
        nth = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        for table in slices(batches, block.rows.shape[1]):
            ids, none, labels, vectors = read(table, block.rows.shape[1], k)
            for r, a, scores in scored(vectors, block.rows):
                other = labels[r][:, None] != block.labels[a][None, :]
                for n in range(int(nth.max(initial=-1)) + 1):
                    row = np.flatnonzero((nth == n) & (anchor >= a.start) & (anchor < a.stop))
                    if len(row):
                        of = anchor[row] - a.start
                        low, high = (x.astype(scores.dtype) for x in fitted(np.maximum(least[row], best.kth[row]), most[row], scores.dtype))
                        part, mask = (scores, other) if len(of) == scores.shape[1] else (scores[:, of], other[:, of])
                        c, p = np.nonzero((part >= low) & (part <= high) & mask)
                        best.put(row[p], part[c, p].astype(np.int64), ids[r][c], none[r][c])
        best.merge()
        yield pa.RecordBatch.from_arrays([pa.array(best.row), optional(best.vec, best.none), pa.array(best.score)], names=["positive", "vec_id", "score"])

    return rows.mapInArrow(run, "positive long, vec_id long, score long")


def fitted(low: np.ndarray, high: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The same bands for scores of this type; none of its scores is its greatest or least number."""
    top = np.iinfo(kind).max
    return np.clip(low, -top, top), np.clip(high, -top, top)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale * component). An anchor's positives are the
    first rows of its label but itself, by score downward, then by vec_id. For each of them come
    the first rows of other labels with least * positive_score <= 100 * negative_score <=
    most * positive_score. Rows of `vectors` or `anchors` with a null label, a null vector, or null, NaN or infinite
    components take no part, nor do rows of another dimension than the anchor. Rows without vec_id stand
    last among equal scores. An id that occurs more than once stands for so many rows, each an anchor if it is among
    the anchors, of which only the anchor's own row is left out of its positives. A positive without
    rows in its band gives none. Empty tables give an empty result; other columns don't matter. Scores are
    exact; those beyond 64 bits saturate. Anchors come to the driver a block at a time, bounded in rows and bytes,
    with as many positives; a block's result is written before the next one comes.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch, found = Scratch(spark, "hard-negatives"), None
    usable = [quantised(t.where("label is not null").withColumn("label", F.col("label").cast("long")), scale, "label") for t in (vectors, anchors)]
    for turn, (size, table) in enumerate(blocks(usable[1], scratch, "anchors", block_bytes, block_rows)):
        block, rows = Block(table, size), usable[0].where(F.size("q") == size)
        shared = spark.sparkContext.broadcast(block)
        partial = scratch.write(find_positives(rows, shared, positives + 1), "positives")
        shared.destroy()
        chosen = first_positives(partial, positives).orderBy("anchor", "nth").toArrow()
        scratch.drop("positives")
        if not chosen.num_rows:
            continue
        (anchor, _), (score, _), (ids, no_id) = (numbers(chosen.column(c)) for c in ("anchor", "score", "vec_id"))
        bands = [[-(-p * s // 100) for s in score.tolist()] for p in (least, -most)]
        low, high = clipped(np.array(bands[0], object)), clipped(-np.array(bands[1], object))
        shared = spark.sparkContext.broadcast((block, (anchor, low, high)))
        best = find_negatives(rows, shared, negatives)
        first = W.partitionBy("positive").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        ranked = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
        pairs = pa.table({"positive": pa.array(np.arange(len(anchor))), "anchor_id": optional(block.ids[anchor], block.no_id[anchor]), "positive_id": optional(ids, no_id), "positive_score": pa.array(score)})
        named = ranked.join(F.broadcast(spark.createDataFrame(pairs)), "positive")  # as many rows as a block's anchors have positives
        columns = ("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found = scratch.write(named.select(*columns), "found", "append")
        shared.destroy()
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long") if found is None else found


def first_positives(partial: DataFrame, k: int) -> DataFrame:
    """anchor, nth, vec_id, score: the best of all partitions without the anchor's own row."""
    ranked = partial.withColumn("at", F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("own"))))
    top = ranked.where(F.col("at") <= k + 1).withColumn("self", F.min(F.when(F.col("own"), F.col("at"))).over(W.partitionBy("anchor")))
    place = F.col("at") - F.when(F.col("at") > F.col("self"), 1).otherwise(0)
    return top.where(F.col("self").isNull() | (F.col("at") != F.col("self"))).where(place <= k).select("anchor", place.alias("nth"), "vec_id", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows whose vec_id is divisible by 100.

    Labels of rows whose vec_id is divisible by 7 are moved on by one of ten first; see hard_negatives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
    FROM s WHERE alike
  ) WHERE nth <= 5
), n AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
  WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
