"""Best-fit packing by length patterns and non-negative least squares.

Only the histogram of lengths, which has as many entries as a sequence has tokens
at most, reaches the driver. Patterns of up to three lengths that fill a sequence
exactly are enumerated, their repeat counts are fitted to the histogram by
non-negative least squares, rounded down, and what remains is packed best-fit
decreasing, again on counts. The plan says which numbers of each length go where;
each piece finds its number by prefix sums over the partitions.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, lean, ship
from .textbytes import pieces
from .tokens import encoder, id_type, vocabulary

CHUNK = 4 << 20
KEY = 40  # bits for a piece's number among those of its length


def patterns(size: int) -> np.ndarray:
    """All a >= b >= c >= 0 with a + b + c = size; 0 stands for no document."""
    a = np.arange(1, size + 1)
    b = np.arange(0, size + 1)
    a, b = (x.ravel() for x in np.meshgrid(a, b, indexing="ij"))
    c = size - a - b
    ok = (a >= b) & (b >= c) & (c >= 0)
    return np.stack((a[ok], b[ok], c[ok]), axis=1)


def fit(count: np.ndarray, found: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """x >= 0 that makes the patterns' summed lengths come near to `count`.

    Block coordinate descent: each sweep takes the patterns that lower the squared
    residual most and share no length, so that their exact steps don't interfere.
    """
    size = len(count) - 1
    used = (found > 0).astype(np.float64)
    # squared norm of a column: equal lengths in a pattern add up before squaring
    same = (found[:, 0] == found[:, 1]) * 2.0 + ((found[:, 1] == found[:, 2]) & (found[:, 2] > 0)) * 2.0 + ((found[:, 0] == found[:, 2]) & (found[:, 2] > 0)) * 2.0
    norm = used.sum(1) + same
    x = np.zeros(len(found))
    rest = count.astype(np.float64)
    rest[0] = 0
    for _ in range(sweeps):
        slope = rest[found].sum(1)
        step = np.maximum(slope / norm, -x)
        gain = step * slope - 0.5 * step * step * norm
        best = np.argsort(-gain, kind="stable")[: 4 * size]
        taken = np.zeros(size + 1, bool)
        moved = 0.0
        for k in best[gain[best] > 1e-6]:
            lengths = found[k]
            if taken[lengths].any():
                continue
            taken[lengths[lengths > 0]] = True
            x[k] += step[k]
            np.subtract.at(rest, lengths[lengths > 0], step[k])
            moved += gain[k]
        if moved <= 1e-6 * max(1.0, float((count**2).sum())):
            break
    return x


def best_fit(count: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: (lengths, repeats) of like sequences."""
    size = len(count) - 1
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    room = np.zeros(size + 1, bool)
    for length in range(size, 0, -1):
        left = int(count[length])
        while left:
            fits = np.flatnonzero(room[length:])
            if not len(fits):
                each = size // length
                for k, n in ((each, left // each), (left % each, 1)):
                    if k and n:
                        open_[size - k * length].append(((length,) * k, n))
                        room[size - k * length] = size > k * length
                break
            space = length + int(fits[0])
            lengths, n = open_[space].pop()
            take = min(n, left)
            if n > take:
                open_[space].append((lengths, n - take))
            open_[space - length].append(((*lengths, length), take))
            room[space - length] = space > length
            room[space] = bool(open_[space])
            left -= take
    return [g for groups in open_.values() for g in groups]


class Plan:
    """Where the i-th piece of each length goes."""

    def __init__(self, count: np.ndarray):
        size = len(count) - 1
        left = count.copy()
        groups: list[tuple[tuple[int, ...], int]] = []
        found = patterns(size)
        repeats = np.floor(fit(count, found) + 1e-9).astype(np.int64)
        for k in np.flatnonzero(repeats):
            lengths = tuple(int(v) for v in found[k] if v)
            n = min([int(repeats[k]), *(int(left[v]) // lengths.count(v) for v in lengths)])
            if n > 0:
                groups.append((lengths, n))
                for v in lengths:
                    left[v] -= n
        self.by_patterns = sum(n for _, n in groups)
        groups += best_fit(left)
        used = np.zeros(size + 1, np.int64)
        rows, sequence = [], 0
        for lengths, n in groups:
            at = 0
            for v in lengths:
                rows.append(((v << KEY) + int(used[v]), sequence, at))
                used[v] += n
                at += v
            sequence += n
        rows.sort()
        self.first, self.sequence, self.offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
        self.sequences = sequence

    def place(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << KEY) + nth
        at = np.searchsorted(self.first, key, "right") - 1
        return self.sequence[at] + key - self.first[at], self.offset[at]


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, memo_words: int) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and the partition that made it
    with the piece's number among those of its length there."""
    ship(docs.sparkSession)
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype).tobytes()
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer, dtype, memo_words).encode
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            for a, b in pieces(batch.column(1), CHUNK):
                row, piece, start, length, crc, nth = [], [], [], [], [], []
                for i, text in enumerate(batch.column(1).slice(a, b - a).to_pylist(), a):
                    ids = np.frombuffer(encode(text or "") + end, dtype).astype("<u4")
                    cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                    cuts = cuts if cuts[-1] == len(ids) else [*cuts, len(ids)]
                    for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        row.append(i)
                        piece.append(k)
                        start.append(x)
                        length.append(y - x)
                        crc.append(zlib.crc32(ids[x:y]))
                        nth.append(seen[y - x])
                        seen[y - x] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc)), pa.array([shard] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "nth"],
                )

    return docs.select("doc_id", "text").mapInArrow(lean(run, encoders=True), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, shard int, nth long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024, memo_words: int = 400_000) -> DataFrame:
    """Packs all rows into sequences of at most `size` tokens: per piece doc_id, piece,
    start, length, ids_crc32, sequence_id, offset.

    A row is its text's ids and `end_id`; null text is empty and gives the end id
    alone. Only longer rows are cut, into pieces of `size`, of which the first may be
    shorter. A worker remembers the ids of some `memo_words` words, which bounds its memory. Repeated rows and null ids are packed like any; an empty table gives an
    empty result; other columns don't matter.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.write(cut_pieces(docs, tokenizer, end_id, size, memo_words), "pieces")
    count = np.zeros(size + 1, np.int64)
    each = scratch.write(cut.groupBy("length", "shard").count(), "counts")
    for r in each.groupBy("length").agg(F.sum("count").alias("n")).collect():
        count[r.length] = r.n
    plan = spark.sparkContext.broadcast(Plan(count))
    before = W.partitionBy("length").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = each.select("length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    kind = dict(cut.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            sequence, offset = plan.value.place(length, batch.column(5).to_numpy()) if len(length) else (length, length)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (
        cut.join(bases, ["length", "shard"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("nth"))
        .mapInArrow(lean(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document; see pack."""
    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
