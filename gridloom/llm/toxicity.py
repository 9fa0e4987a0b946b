"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presences: single words, beginnings of words (so that an inflected form
counts with its kin), neighbours, and words with one between them. Every coordinate
has its own learning rate and an L1 term, so the weights that remain are few and are
broadcast as (index, weight). FTRL learns example by example, in one task, from a
bounded sample of labelled rows (`max_rows`); all rows are scored in parallel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, documents, hash_limit, ship
from .textbytes import NO_LETTER, U, mix, pieces, text_buffer, word_hashes

BITS = 18
BIAS = 1 << BITS
STEMS = (4, 5, 6)
MODEL = "index long, weight double"


def features(column: pa.Array) -> list[np.ndarray]:
    """The distinct hashed features of each text."""
    words, first, *stems = word_hashes(*text_buffer(column), NO_LETTER, STEMS)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        w = words[a:b]
        parts = [mix(w ^ U(1)), *(mix(s[a:b] ^ U(10 + k)) for k, s in enumerate(stems))]
        if len(w) > 1:
            parts.append(mix(w[:-1] * U(3) + w[1:] ^ U(4)))
        if len(w) > 2:
            parts.append(mix(w[:-2] * U(5) + w[2:] ^ U(6)))
        out.append(np.unique(np.concatenate(parts) >> U(64 - BITS)).astype(np.int64))
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class FTRL:
    def __init__(self, alpha: float = 0.1, beta: float = 1.0, l1: float = 12.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), self.l1)
        l1[-1] = 0.0  # the bias comes last
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, BIAS)
        w = self.weights(at)
        g = float(sigmoid(w.sum())) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, epochs: int = 3) -> DataFrame:
    """(index, weight) of the non-zero weights, from at most about `max_rows` labelled rows.

    `labels` holds doc_id and toxic (0 or 1; other values and nulls are passed over; an
    id with both counts as 1). Where more rows are labelled, a fixed hash of doc_id
    chooses among them. Of texts that share an id the least in order is learned from.
    Empty tables give no weights.
    """
    ship(docs.sparkSession)
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, max_rows / max(1, n))
    chosen = known.where(F.xxhash64("doc_id", F.lit("toxicity")) <= F.lit(hash_limit(share)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").cast("long").alias("toxic"))

    def run(batches):
        found: list[np.ndarray] = []
        label: list[int] = []
        for batch in batches:
            for a, b in pieces(batch.column(0), 2 << 20):
                found += [f.astype(np.int32) for f in features(batch.column(0).slice(a, b - a))]
            label += batch.column(1).to_pylist()
        model = FTRL()
        toxic = sum(label)
        # the rarer class is shown more often, up to ten times
        times = [min(10, max(1, round((len(label) - n) / max(1, n)))) for n in (len(label) - toxic, toxic)]
        for _ in range(epochs):
            for f, y in zip(found, label, strict=True):
                for _ in range(times[y]):
                    model.learn(f, y)
        w = model.weights()
        some = np.flatnonzero(w) if label else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"index": some, "weight": w[some]})

    order = F.xxhash64("doc_id", F.lit("order"))
    return rows.repartition(1).sortWithinPartitions(order, "doc_id").select("text", "toxic").mapInArrow(run, MODEL)


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Per row doc_id and score, 0 to 1. Null and empty texts have the bias's score; without
    any weights all scores are 0. Repeated rows are each scored; other columns don't matter."""
    spark = docs.sparkSession
    ship(spark)
    table = model.toArrow()  # at most 2 ** BITS + 1 rows
    weights = spark.sparkContext.broadcast((table.column("index").to_numpy(), table.column("weight").to_numpy()))

    def run(batches):
        index, weight = weights.value
        dense = np.zeros(BIAS + 1)
        dense[index] = weight
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                found = features(batch.column(1).slice(a, b - a))
                total = np.array([dense[f].sum() for f in found]) + dense[BIAS]
                out = sigmoid(total) if len(index) else np.zeros(len(found))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(out)], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; rows that share an id are each scored. See train and score."""
    docs = documents(spark, sf_dir)
    labels = documents(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    found = score(docs, train(docs, labels))
    return found.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
