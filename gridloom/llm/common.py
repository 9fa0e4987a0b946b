"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import sys
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_SHARED = "spark.gridloom.local.shared"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Set while a table is written: its shuffle files go when it is done, and the driver keeps plans' texts short.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxPlanStringLength": "100000"}


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = f"{root}:{env['PYTHONPATH']}" if env.get("PYTHONPATH") else root


def small_batches(spark: SparkSession, limit: int = 2 << 20) -> None:
    """Batches of rows between Spark and Python are cut at `limit` bytes, unless the session has a limit of its own."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(limit))


def give_back() -> None:
    """Returns the memory that this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run, encoders: bool = False):
    """`run`, a function over batches, in a worker that Spark keeps for tasks of other steps: it begins without the `encoders` of
    steps before, unless it uses them itself, and gives back at its end what it has freed."""

    def made(batches):
        tokens = sys.modules.get("gridloom.llm.tokens")
        if tokens and not encoders:
            tokens.encoder.cache_clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return made


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where it is unset a folder of this machine is made, if the master is local (tests);
    a cluster without a shared folder is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_SHARED, None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = Path(tempfile.mkdtemp(prefix="gridloom-")).as_uri()
        spark.conf.set(LOCAL_SHARED, found)
    return found.rstrip("/")


def put(uri: str, parts) -> None:
    """Writes a file in a shared folder under a name of its task attempt and then renames it, so
    that a task that runs again after a lost executor leaves whole files only."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    task = TaskContext.get()
    own = f"{path}.{task.taskAttemptId() if task else 'driver'}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    fs.move(own, path)


def fetch(uri: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return f.read()


class Scratch:
    """Tables and folders of one run, in the shared folder.

    A written table cuts lineage and outlives lost executors. `drop` removes one
    that no later step reads; whatever is left goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        """Writes a table and reads it; the shuffle files that led to it go at once."""
        before = {k: self.spark.conf.get(k, None) for k in WRITING}
        for k, v in WRITING.items():
            self.spark.conf.set(k, v)
        try:
            df.write.mode(mode).parquet(self.path(name))
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)

    def close(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session has ended already
            pass


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_keys(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(the rows and `_at`, their key: doc_id, and where ids repeat, the text's digest beside
    it; whether ids repeat). `_at` is null where doc_id is."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select("doc_id", F.lit(True).alias("_more"))
    if ids.isEmpty():
        return docs.withColumn("_at", F.col("doc_id")), False
    digest = F.coalesce(F.when(F.col("_more"), F.sha2("text", 256)), F.lit(""))
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", digest.alias("digest")))
    return docs.join(ids, "doc_id", "left").withColumn("_at", key).drop("_more"), True


def hash_limit(share: float) -> int:
    """What at most `share` of all 64-bit hashes don't exceed; even the least share is above none."""
    return min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))
