"""Exact top-k search by inner product, a block of documents at a time.

Vectors are quantised; a component's positive and negative part are the terms of an
impact index. In each partition, some tens of thousands of rows at a time are ordered into small
document ranges, each with every term's largest impact (its maximum and minimum per
component) and a forward index (its rows). A query visits the blocks in descending order of its
summed bounds and stops when a bound falls below the k-th score, which is carried on
through the partition. Partial results of the partitions are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, ship
from .vectors import BLOCK_BYTES, BLOCK_ROWS, Best, blocks, matrix, numbers, optional, product, quantised, slices, thin, upper

BLOCK = 256


def search(ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, best: Best, none: np.ndarray | None = None) -> None:
    """Block-at-a-time search of all queries over one set of rows, beyond what `best` holds already."""
    if not len(ids) or not len(queries):
        return
    none = np.zeros(len(ids), bool) if none is None else none
    # like rows side by side: by the component of the largest size and its sign
    lead = np.abs(rows).argmax(1) if rows.shape[1] else np.zeros(len(rows), np.int64)
    sign = np.sign(rows[np.arange(len(rows)), lead]) if rows.shape[1] else lead
    order = np.lexsort((ids, sign, lead))
    ids, none, rows = ids[order], none[order], rows[order]
    cut = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(rows, cut), np.minimum.reduceat(rows, cut)
    bound = upper(queries, high, low)
    visit = np.argsort(-bound, axis=1, kind="stable")
    live = np.arange(len(queries))
    for turn in range(len(cut)):
        block = visit[live, turn]
        # a bound equal to the k-th score may still bring a tie with a smaller id
        going = bound[live, block] >= best.kth[live]
        live, block = live[going], block[going]
        if not len(live):
            break
        for b in np.unique(block):
            at = live[block == b]
            part = slice(cut[b], cut[b] + BLOCK)
            best.add(at, product(queries[at], rows[part]), ids[part], none[part])
        best.merge()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of `queries`, the k best rows of `vectors` other than itself: query_id,
    rank, vec_id, score (integer inner product of floor(scale * component)).

    Ties go to the smaller vec_id, and last to rows without one, which are candidates like others;
    fewer rows give fewer results. Null vectors, vectors
    with null, NaN or infinite components, and candidates of another dimension than the
    query take no part; vectors of no component score 0 with each other. An id that occurs more than once stands for so many candidates,
    of which only the query row itself is left out. Empty tables give an empty result;
    other columns don't matter. Scores are exact; those beyond 64 bits saturate. The queries come to the driver
    a block at a time, bounded in rows and bytes; a block's result is written before the next one comes.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, scratch, start, merged = quantised(vectors, scale), Scratch(spark, "top-k"), 0, None
    for size, table in blocks(quantised(queries, scale), scratch, "queries", block_bytes, block_rows):
        shared = spark.sparkContext.broadcast((numbers(table.column("vec_id")), matrix(table.column("q"), size)))
        merged = scratch.write(search_block(rows.where(F.size("q") == size), shared, k, start), "found", "append")
        shared.destroy()
        start += table.num_rows
    if merged is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ranked = merged.withColumn("_at", F.row_number().over(W.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("own"))))
    # a query's own row counts as one candidate too many: one of its id and score goes
    own = F.min(F.when(F.col("own") & (F.col("score") == F.col("self")), F.col("_at"))).over(W.partitionBy("_row"))
    ranked = ranked.where(F.col("_at") <= k + 1).withColumn("_own", own)
    place = F.col("_at") - F.when(F.col("_at") > F.col("_own"), 1).otherwise(0)
    return ranked.where(F.col("_own").isNull() | (F.col("_at") != F.col("_own"))).where(place <= k).select("query_id", place.cast("int").alias("rank"), "vec_id", "score")


def own_scores(queries: np.ndarray) -> np.ndarray:
    """Each row's inner product with itself."""
    return np.array([product(q[None], q[None])[0, 0] for q in queries], np.int64)


def search_block(rows: DataFrame, block, k: int, start: int) -> DataFrame:
    def run(batches):
        (query_ids, no_id), queries = block.value
        own, best = own_scores(queries), Best(len(queries), k + 1)
        for table in slices(batches, queries.shape[1]):
            (ids, none), vectors = numbers(table.column(0)), matrix(table.column(1), queries.shape[1])
            some = thin(vectors, ids, none, k + 1)
            search(ids[some], vectors[some], queries, best, none[some])
        best.merge()
        q = best.row
        same = ~best.none & ~no_id[q] & (best.vec == query_ids[q]) | best.none & no_id[q]
        yield pa.RecordBatch.from_arrays(
            [pa.array(q + start), optional(query_ids[q], no_id[q]), pa.array(own[q]), optional(best.vec, best.none), pa.array(best.score), pa.array(same)],
            names=["_row", "query_id", "self", "vec_id", "score", "own"],
        )

    return rows.mapInArrow(run, "_row long, query_id long, self long, vec_id long, score long, own boolean")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 best of all vectors for each whose vec_id is divisible by 50.

    Rows without an id are candidates only; see top_k."""
    vectors = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
