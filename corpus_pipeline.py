"""A corpus pipeline of five stages, each one operator over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from gridloom.llm.common import Scratch, documents, small_batches, with_keys
from gridloom.llm.tokens import vocabulary

WORDS, PERCENT = 5, 80


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language; null texts and texts without letters are rejected.
    A missing lang is filled in. Repeated rows are judged alike, an empty table stays empty; columns of the
    documents that bear names of the model's results keep their values."""
    small_batches(spark)
    own = {c: hidden(c, docs.columns) for c in docs.columns if c in ("lang_pred", "score")}
    judged = language_id.predict(docs.withColumnsRenamed(own), language_id.train(docs)).where(F.col("lang_pred") != language_id.UNKNOWN)
    named = judged.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return named.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def hidden(name: str, taken: list[str]) -> str:
    """A name that no column has."""
    while name in taken:
        name = f"_{name}"
    return name


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that resemble earlier ones, and documents of which no word is left.
    Null texts and rows without an id stay; see line_dedup.judge_documents on repeated ids."""
    return with_length(docs, line_dedup.dedup_lines(docs))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near-duplicates; among rows that share
    an id, that of the least digest of the text, and one of equal rows. Rows without an id and
    texts without words stay."""
    small_batches(spark)
    rows, repeated = with_keys(docs.select("doc_id", "text", F.struct("*").alias("_row")))
    judged = near_dedup.near_duplicates(rows.select(F.col("_at").alias("doc_id"), "text"), words=WORDS, percent=PERCENT)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_at")).distinct()
    left = rows.join(gone, "_at", "left_anti")
    if repeated:
        left = left.where("_at is not null").dropDuplicates(["_at"]).union(left.where("_at is null"))
    return left.select("_row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; documents of which no word is left go, null texts stay."""
    small_batches(spark)
    return with_length(docs, decontaminate.remove_contamination(docs, documents(spark, sf_dir, "benchmark"), shard_bytes=8 << 20))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences; a null text is an empty one."""
    small_batches(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), memo_words=100_000)


def with_length(docs: DataFrame, changed: DataFrame) -> DataFrame:
    return changed.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else changed


STAGES = [
    ("language ID", identify),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near),
    ("decontamination", decontaminated),
    ("packing", packed),
]
#: Trained models, tokenizers and hashed sets are no SQL; a test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k > 1:
            scratch.drop(f"stage-{k - 2}")
    return docs
