"""Integer vectors, blocks of them for the tasks, and the best candidates of each row of a block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 20_000
SLICE_BYTES = 32 << 20
SLICE_ROWS = 1 << 16
MOST = np.iinfo(np.int64).max
WIDE = float(1 << 62)
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, scale: int, *more: str) -> DataFrame:
    """vec_id, the columns `more` and q, floor(scale * x) of every usable vector."""
    x = F.col("embedding")
    ok = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    q = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), *more, q.alias("q"))


def blocks(rows: DataFrame, scratch: Scratch, name: str, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> Iterator[tuple[int, pa.Table]]:
    """(number of components, rows) of blocks bounded in rows and bytes, each of one dimension.

    The rows are written once, in a folder for each block, so that a block is read without the others."""
    spark = rows.sparkSession
    counts = {r.n: r["count"] for r in rows.groupBy(F.size("q").alias("n")).count().collect()}
    if not counts:
        return
    parts = {n: max(1, -(-c // block_rows), -(-c * n * 8 // block_bytes)) for n, c in counts.items()}
    number = F.element_at(F.create_map(*(F.lit(v) for kv in parts.items() for v in kv)), F.size("q"))
    # equal rows must not all fall into one block
    dealt = rows.withColumns({"_n": F.size("q"), "_block": F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), number).cast("int")})
    dealt.write.partitionBy("_n", "_block").mode("overwrite").parquet(scratch.path(name))
    found = spark.read.schema(dealt.schema).parquet(scratch.path(name))
    for n, count in sorted(parts.items()):
        for b in range(count):
            table = found.where((F.col("_n") == n) & (F.col("_block") == b)).drop("_n", "_block").toArrow()
            if table.num_rows:
                yield n, table


def matrix(column, size: int) -> np.ndarray:
    """The lists of `size` integers each as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def numbers(column) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit values, with the greatest where there is none; whether there is none)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    none = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(MOST).cast(pa.int64()).to_numpy(zero_copy_only=False), none


def optional(values: np.ndarray, none: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=none)


def largest(a: np.ndarray) -> float:
    return float(np.abs(a.astype(np.float64)).max(initial=0))


def reach(a: np.ndarray, b: np.ndarray) -> float:
    """What no inner product of a row of a and one of b exceeds, nor any part of it."""
    return largest(a) * largest(b) * max(1, a.shape[1])


def clipped(scores: np.ndarray) -> np.ndarray:
    """Python integers as 64-bit ones; what is beyond them saturates."""
    return np.clip(scores, -MOST, MOST).astype(np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b, exact; beyond 64 bits they saturate."""
    most = reach(a, b)
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < WIDE:
        return a @ b.T
    return clipped(a.astype(object) @ b.astype(object).T)


def upper(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What no inner product of a query and a row between `low` and `high` exceeds."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    if max(reach(queries, high), reach(queries, low)) < WIDE / 2:
        return product(plus, high) + product(minus, low)
    return clipped(plus.astype(object) @ high.astype(object).T + minus.astype(object) @ low.astype(object).T)


def slices(batches, size: int):
    """Arrow tables of some tens of megabytes of vectors, of the rows of a partition."""
    limit = max(1, min(SLICE_ROWS, SLICE_BYTES // (8 * max(1, size))))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            held.append(batch.slice(at, limit))
            if sum(b.num_rows for b in held) >= limit:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def thin(keys: np.ndarray, ids: np.ndarray, none: np.ndarray, k: int) -> np.ndarray:
    """Which rows to keep so that of equal ones (rows of `keys`) the k of least ids stay: no other can be among k best."""
    factors = np.random.default_rng(1).integers(1, MOST, keys.shape[1], dtype=np.int64) | 1
    order = np.lexsort((ids, none, (keys * factors).sum(1)))
    if len(order) <= k:
        return np.sort(order)
    # a row goes if the k before it are all equal to it
    same = (keys[order[1:]] == keys[order[:-1]]).all(1)
    total = np.concatenate(([0], np.cumsum(same)))
    stay = np.ones(len(order), bool)
    stay[k:] = total[k:] - total[:-k] < k
    return np.sort(order[stay])


class Best:
    """The k best candidates of each of n rows: higher scores first, then smaller ids, missing ids last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.row, self.score, self.vec, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        #: what a score must reach to be among the best; rises when candidates are merged
        self.kth = np.full(n, -MOST)
        self.waiting: list[tuple] = []
        self.size = 0

    def put(self, row: np.ndarray, score: np.ndarray, vec: np.ndarray, none: np.ndarray) -> None:
        """Candidates of rows; they are merged at once where they are many."""
        if len(row):
            self.waiting.append((row, score, vec, none))
            self.size += len(row)
            if self.size > max(1 << 14, 2 * len(self.row)):
                self.merge()

    def add(self, rows: np.ndarray, scores: np.ndarray, vec: np.ndarray, none: np.ndarray) -> None:
        """All candidates (columns of scores) for some rows."""
        least = self.kth[rows]
        if scores.shape[1] > 4 * self.k:  # ties with the k-th stay
            least = np.maximum(least, np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k])
        q, c = np.nonzero(scores >= least[:, None])
        self.put(rows[q], scores[q, c], vec[c], none[c])

    def merge(self) -> None:
        row, score, vec, none = (np.concatenate(x) for x in zip((self.row, self.score, self.vec, self.none), *self.waiting, strict=True))
        self.waiting, self.size = [], 0
        order = np.lexsort((vec, none, -score, row))
        row = row[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.concatenate((first, [len(row)]))))
        stay = place < self.k
        order = order[stay]
        self.row, self.score, self.vec, self.none = row[stay], score[order], vec[order], none[order]
        last = place[stay] == self.k - 1
        self.kth[self.row[last]] = self.score[last]
